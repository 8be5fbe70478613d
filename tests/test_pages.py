import pytest
from pyspark.sql import functions as F

from talkmill.operators import pages as pg

SITES = {
    "dantri": """<html><body><time class="author-time"> 22/05/2024 10:00 </time>
        <div class="singular-content"><p>One <a href="/x">link</a>.</p><img src="i"><p>Two.</p></div></body></html>""",
    "nd": """<body><h1 class="article__title">Title</h1><div class="main-content"><div class="article__sapo">Lead</div>
        <time class="time">25/04/2025</time><div class="article__body"><p>Body</p><figure>no</figure>
        <table class="picture"><tr><td>no</td></tr></table><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table></div></div></body>""",
    "tg": """<body><h1 class="story-headline">T</h1><div class="flex-fill"><div class="story-teaser">L</div>
        <div class="ml-lg-auto">1/2/2024</div><div class="story-body"><p>B</p></div></div></body>""",
    "vnet": """<body><div class="main-v1 bg-white"><div class="bread-crumb-detail__time">1/2/2024</div><div class="content-detail">
        <div class="article-detail-author-wrapper">author</div><p>Text</p><article>more</article></div></div></body>""",
    "vnex": """<section class="section page-detail top-detail"><span class="date">1/2/2024</span><p class="description">D</p>
        <p class="Normal">N1</p><p class="Normal" style="text-align:right;">sign</p><p class="Normal">N2</p></section>""",
    "vtc": """<span class="x time-update">1/2/2024</span>
        <div class="content-wrapper pt5 mt5 font18 gray-31 bor-4top-e5 lh-1-5"><p>V</p></div>""",
}
EXPECTED = {
    "dantri": ("2024-05-22T10:00:00", "One link.\n\nTwo."),
    "nd": ("25/04/2025", "# Title\n\nLead\n\nBody\n\n| a | b|\n| ---|---|\n| 1 | 2|"),
    "tg": ("1/2/2024", "# T\n\nL\n\nB"),
    "vnet": ("1/2/2024", "Text"),
    "vnex": ("1/2/2024", "D\n\nN1 N2"),
    "vtc": ("1/2/2024", "V"),
}


def frame(spark, pages):
    return spark.createDataFrame([(s, h) for s, h in pages], "source string, html string")


def test_site_profiles(spark):
    got = {r["source"]: r for r in pg.articles(frame(spark, SITES.items())).collect()}
    assert {s: (r["time"], r["content"]) for s, r in got.items()} == EXPECTED
    assert not any(r["is_err_link"] for r in got.values())


def test_bad_pages_become_rows(spark):
    pages = [("nd", "<body>other layout</body>"), ("none", "x"), ("plain", None), ("dantri", SITES["dantri"].replace("<time", "<b"))]
    got = [(r["source"], r["failure"], r["is_err_link"]) for r in pg.articles(frame(spark, pages)).orderBy("source").collect()]
    assert got == [("dantri", None, True), ("nd", "layout", True), ("none", "no parser", True), ("plain", "no page", True)]


def test_failing_parser_is_isolated(spark):
    def broken(html):
        raise KeyError("x")

    got = pg.articles(frame(spark, [("a", "1"), ("plain", "<article><time>1/1/2024</time>ok</article>")]), {**pg.PARSERS, "a": broken})
    assert sorted((r["failure"] or "", r["content"]) for r in got.collect()) == [("", "ok"), ("KeyError: 'x'", None)]


def test_fallback_layout(spark):
    html = '<time class="author-time">22/05/2024 10:00</time><div class="e-magazine__body"><p>E</p></div>'
    row = pg.articles(frame(spark, [("dantri", html)])).first()
    assert (row["content"], row["is_err_link"]) == ("E", False)


def test_split(spark):
    rows = spark.createDataFrame([("a", "1/1/2024", "x"), ("b", "", "x"), ("c", "t", None)], "k string, time string, content string")
    good, bad = pg.split_articles(rows)
    assert [r["k"] for r in good.collect()] == ["a"] and sorted(r["k"] for r in bad.collect()) == ["b", "c"]


def test_deep_page(spark):
    html = "<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>"
    assert pg.articles(frame(spark, [("plain", html)])).first()["content"] == "deep"


HTML = """<!-- <a href="/comment">no</a> --><script>"<a href='/s'>no</a>"</script>
<a class=x href="/a.htm"> One <b>two</b> three </a><a href='http://o.com/b.htm?x=1&amp;y=2'>B</a>
<a href=plain.htm>P &amp; Q</a><a name="n">none</a><A HREF="#f">F</A>"""


def test_links(spark):
    rows = spark.createDataFrame([("http://s.com/d/p.htm", HTML)], "url string, html string")
    got = [(r["link"], r["title"]) for r in pg.links(rows).orderBy("pos").collect()]
    assert got == [
        ("http://s.com/a.htm", "Onetwothree"),
        ("http://o.com/b.htm?x=1&y=2", "B"),
        ("http://s.com/d/plain.htm", "P & Q"),
        ("http://s.com/d/p.htm#f", "F"),
    ]


@pytest.mark.parametrize(
    "source, link, title, ok",
    [
        ("dantri", "https://dantri.com.vn/x.htm", "a b c d e f", True),
        ("dantri", "https://dantri.com.vn/x.htm", "a b c d e", False),
        ("dantri", "https://other.vn/x.htm", "a b c d e f", False),
        ("vnet", "https://q/x.htm", "a b c d e f", False),
        ("tg", "https://q/x", "a b c d", True),
        ("nd", "https://q/x", "a b c", False),
    ],
)
def test_admission(spark, source, link, title, ok):
    rows = spark.createDataFrame([(source, link, title)], "source string, link string, title string")
    assert pg.admitted_by_source(rows, pg.rules_frame(spark)).count() == int(ok)
    assert pg.admitted(rows, pg.LINK_RULES[source]).count() == int(ok)


def test_frontier(spark):
    rows = spark.createDataFrame(
        [("dantri", "https://d.vn/kinh-doanh.htm", 9), ("vnet", "https://v.vn/t", 2), ("vtc", "https://c.vn/k-29.html", 9), ("tg", "https://t.vn/a", 9)],
        "source string, section string, cap int",
    )
    got = [r["page_url"] for r in pg.frontier(rows, 1, 3, cap="cap").orderBy("source", "page").collect()]
    assert got == [
        "https://d.vn/kinh-doanh/trang-1.htm",
        "https://d.vn/kinh-doanh/trang-2.htm",
        "https://t.vn/a?page=1",
        "https://t.vn/a?page=2",
        "https://v.vn/t-page1",
        "https://c.vn/k-29/trang-1.html",
        "https://c.vn/k-29/trang-2.html",
    ]


def test_feeds(spark):
    body = '{"error_code":0,"data":{"contents":[{"title":"T","url":"/a"},{"title":"U","url":""}]}}'
    rows = spark.createDataFrame([(1, body), (2, body.replace(":0", ":1"))], "k int, body string")
    got = pg.feed_links(rows, "https://en.f/", "en").collect()
    assert [(r["k"], r["link"], r["title"], r["lang"]) for r in got] == [(1, "https://en.f/a", "T", "en")]


def test_time_format(spark):
    rows = pg.article_columns(spark.createDataFrame([("ngày 25/04/2025 - 11:39", "a b")], "time string, content string"))
    assert rows.select(F.date_format("published", "yyyy-MM-dd"), "word_count").first() == ("2025-04-25", 2)


def test_pages_are_parsed_once_and_out_of_data_frames(spark):
    """Null pages and columns of any name pass; a filter on what was parsed
    does not parse again; no batch is a data frame."""
    pages = spark.createDataFrame([(1, "plain", "<article><time>1/2/2024 8:00</time>a b</article>"), (None, "plain", None)], "id bigint, source string, html string")
    rows = pg.articles(pages)
    assert {(r["id"], r["content"], r["failure"]) for r in rows.collect()} == {(1, "a b", None), (None, None, "no page")}
    good, _ = pg.split_articles(rows)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and plan.count("ArrowEvalPython") == 1
