"""Links, frontier and articles of the stored pages."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from talkmill.functions import text as tx
from talkmill.operators import pages as pg
from talkmill.plans.registry import query, sql_strip, sql_word_count

_UNESCAPE = "{0}"
for _name, _char in pg.ENTITIES.items():
    _UNESCAPE = f"replace({_UNESCAPE}, '{_name}', '{_char if _char != chr(39) else chr(39) * 2}')"

SQL_LINKS = rf"""WITH clean AS (
      SELECT page_id, url, regexp_extract_all(
          regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
          '(?is)<a\s[^>]*?\bhref\s*=[^>]*>.*?</a\s*>') AS found FROM pages),
    a AS (SELECT page_id, url, generate_subscripts(found, 1) - 1 AS pos, unnest(found) AS a FROM clean),
    b AS (SELECT page_id, url, pos,
                 {sql_strip(_UNESCAPE.format('''regexp_extract(a, '(?is)^<a\\s[^>]*?\\bhref\\s*=\\s*"([^"]*)"', 1)'''))} AS href,
                 {sql_strip(_UNESCAPE.format(r"""regexp_replace(regexp_replace(a, '(?is)^<a\s[^>]*>|</a\s*>$', '', 'g'), '\s*<[^>]*>\s*', '', 'g')"""))} AS title FROM a),
    l AS (SELECT *, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
                         ELSE regexp_extract(url, '^(\w+://[^/?#]+)', 1) || href END AS link FROM b)"""


@query("page_links", SQL_LINKS + " SELECT page_id, CAST(pos AS INT) AS pos, href, title, link FROM l")
def page_links(t):
    return pg.links(t("pages").select("page_id", "url", "html")).drop("url")


def page_source():
    """Top-level domain of the page: com, net or org."""
    return F.regexp_extract("url", r"example\.(\w+)", 1)


# Titles in the tables have one word, so the word limits are 0 here.
RULES = {"com": pg.LinkRule(0), "net": pg.LinkRule(0, ending="e"), "org": pg.LinkRule(0, contains="th")}


@query(
    "link_admission",
    SQL_LINKS
    + rf""" SELECT page_id, CAST(pos AS INT) AS pos, link, title FROM l
            WHERE {sql_word_count('title')} > 0 AND CASE regexp_extract(url, 'example\.(\w+)', 1)
                WHEN 'com' THEN true WHEN 'net' THEN ends_with(link, 'e') WHEN 'org' THEN contains(link, 'th') END""",
)
def link_admission(t):
    rows = pg.links(t("pages").select("page_id", "url", page_source().alias("source"), "html"))
    kept = pg.admitted_by_source(rows, pg.rules_frame(rows.sparkSession, RULES))
    return kept.select("page_id", "pos", "link", "title")


@query(
    "page_frontier",
    r"""WITH s AS (SELECT page_id, page_id % 6 AS k, regexp_replace(url, '[?#].*$', '') AS section FROM pages),
        p AS (SELECT s.*, unnest(range(1, 5)) AS page FROM s)
        SELECT page_id, CAST(page AS INT) AS page, CASE k
            WHEN 0 THEN regexp_replace(section, '\.htm$', '') || '/trang-' || page || '.htm'
            WHEN 1 THEN section || '-page' || page WHEN 2 THEN section || '-p' || page
            WHEN 3 THEN regexp_replace(section, '\.html$', '') || '/trang-' || page || '.html'
            WHEN 4 THEN section || '?page=' || page ELSE section || '-' || page || '.html?phrase=' END AS page_url
        FROM p""",
)
def page_frontier(t):
    names = F.array(*[F.lit(n) for n in pg.FRONTIER_TEMPLATES])
    sections = t("pages").select(
        "page_id",
        F.get(names, (F.col("page_id") % 6).cast("int")).alias("source"),
        F.regexp_replace("url", "[?#].*$", "").alias("section"),
    )
    return pg.frontier(sections, 1, 5).select("page_id", "page", "page_url")


@query(
    "url_join",
    r"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://site.example/' || page_id END AS absolute,
               CASE page_id % 3 WHEN 0 THEN regexp_extract(url, '^(\w+://[^/?#]+)', 1) || '/x'
                    WHEN 1 THEN 'http://other.example/y' ELSE regexp_replace(url, '#.*$', '') || '#top' END AS resolved FROM pages""",
)
def url_join(t):
    href = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/"), F.col("page_id")))
    third = F.col("page_id") % 3
    relative = F.when(third == 0, "/x").when(third == 1, "http://other.example/y").otherwise("#top")
    return t("pages").select(
        "page_id",
        tx.absolute_url(href, F.lit("https://site.example//")).alias("absolute"),
        tx.resolve_url(relative, F.col("url")).alias("resolved"),
    )


@query(
    "feed_links",
    r"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://en.feed.example/a/' || page_id END AS link,
               regexp_extract(html, '<title>(.*?)</title>', 1) AS title, 'https://en.feed.example/' AS base_url, 'en' AS lang
        FROM pages WHERE page_id % 5 <> 0""",
)
def feed_links(t):
    link = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/a/"), F.col("page_id")))
    content = F.struct(F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), link.alias("url"))
    code = F.when(F.col("page_id") % 5 == 0, 1).otherwise(0)
    body = F.to_json(F.struct(code.alias("error_code"), F.struct(F.array(content).alias("contents")).alias("data")))
    return pg.feed_links(t("pages").select("page_id", body.alias("body")), "https://en.feed.example/", "en")


def timed_pages(t):
    """Pages of which two in three carry a publication time."""
    stamped = F.replace(F.col("html"), F.lit("<article>"), F.lit("<article><time>Thứ hai, ngày 17/03/2025 - 08:20</time>"))
    html = F.when(F.col("page_id") % 3 != 0, stamped).otherwise(F.col("html"))
    return t("pages").select("page_id", "url", F.lit("plain").alias("source"), html.alias("html"))


_UNWRAP = r"""regexp_replace({0}, '([^\n])\n([^\n\-*|])', '\1 \2', 'g')"""

# The articles hold headings, paragraphs, bold text and breaks; paragraphs and
# bold text may be left open, and then close at the end of the article.
SQL_ARTICLES = rf"""WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS t FROM pages),
    b AS (SELECT page_id, url, regexp_replace(t, '\s+', ' ', 'g') AS t, len(string_split(t, '<b>')) - len(string_split(t, '</b>')) AS open,
      CASE WHEN contains(string_split(t, '<b>')[-1], '<p>') THEN E'\n\n' ELSE '' END AS edge FROM a),
    c AS (SELECT page_id, url, E'\n\n' || replace(replace(replace(replace(replace(t, '<h1>', E'\n\n# '), '</h1>', E'\n\n'), '<br>', E'  \n'), '<b>', '**'), '</b>', '**') AS t, open, edge FROM b),
    d AS (SELECT page_id, url, replace(replace(t, '<p>', E'\n\n'), '</p>', E'\n\n') 
      || CASE WHEN open > 0 THEN edge || '**' || repeat(E'\n\n**', open::INT - 1) ELSE '' END || E'\n\n' AS t FROM c),
    e AS (SELECT page_id, url, replace(replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '&copy;', '©'), '&middot;', '·') AS t FROM d),
    f AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(t, '[ \t]+\n', E'\n', 'g'), '\n[ \t]+([^ \t*])', E'\n\\1', 'g'), '\n{{3,}}', E'\n\n', 'g') AS t FROM e),
    g AS (SELECT page_id, url, chr(1) || regexp_replace(regexp_replace(t, '^\n+|\n+$', '', 'g') || E'\n', ' +', ' ', 'g') || chr(1) AS t FROM f),
    h AS (SELECT page_id, url, replace(replace(replace({_UNWRAP.format(_UNWRAP.format('t'))}, chr(1), ''), '** _', '**_'), '_ **', '_**') AS t FROM g),
    i AS (SELECT page_id, url, {sql_strip('t')} AS content FROM h)"""


@query(
    "page_articles",
    SQL_ARTICLES
    + f""" SELECT page_id, url, content, {sql_word_count('content')} AS word_count, page_id % 3 = 0 AS is_err_link, NULL::VARCHAR AS failure,
           CASE WHEN page_id % 3 <> 0 THEN TIMESTAMP '2025-03-17' END AS published FROM i""",
)
def page_articles(t):
    return pg.article_columns(pg.articles(timed_pages(t))).select(
        "page_id", "url", "content", "word_count", "is_err_link", "failure", F.col("published").cast("timestamp_ntz").alias("published")
    )


@query(
    "page_split",
    """SELECT page_id, CASE WHEN page_id % 3 <> 0 AND contains(html, '<article>') THEN 'good' ELSE 'bad' END AS outcome,
              CASE WHEN page_id % 3 <> 0 AND contains(html, '<article>') THEN TIMESTAMP '2025-03-17' END AS published FROM pages""",
)
def page_split(t):
    good, bad = pg.split_articles(pg.articles(timed_pages(t)))
    rows = good.withColumn("outcome", F.lit("good")).unionByName(bad.withColumn("outcome", F.lit("bad")))
    return pg.article_columns(rows).select("page_id", "outcome", F.col("published").cast("timestamp_ntz").alias("published"))


# Documents as pages of six sites: words, seven of them as a title, then a lead
# of nine, and the rest as two paragraphs.
SQL_SITE_WORDS = r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[^A-Za-z]+'), lambda x: x <> '') AS w FROM documents),
    d AS (SELECT doc_id, array_to_string(w[1:7], ' ') AS t, array_to_string(w[8:16], ' ') AS l, array_to_string(w[17:40], ' ') AS a, array_to_string(w[41:], ' ') AS b
          FROM w WHERE len(w) > 40)"""


def site_pages(t):
    """Each site's own layout, with pictures, signatures and teasers in it."""
    words = F.filter(F.split("text", "[^A-Za-z]+"), lambda x: x != "")
    docs = t("documents").select("doc_id", words.alias("w")).filter(F.size("w") > 40)

    def span(first, last=None):
        return F.array_join(F.slice("w", first, F.size("w") if last is None else last - first + 1), " ")

    docs = docs.select("doc_id", span(1, 7).alias("t"), span(8, 16).alias("l"), span(17, 40).alias("a"), span(41).alias("b"))

    def page(form: str):
        """``{t}``, ``{l}``, ``{a}``, ``{b}`` stand for the columns."""
        pieces = re.split(r"\{([tlab])\}", form)
        return F.concat(*[F.col(p) if i % 2 else F.lit(p) for i, p in enumerate(pieces)])

    forms = [
        ("www.dantri.example", "<time class='author-time'> 22/05/2024 10:00 </time><div class='singular-content x'><p>{a} <a href='/x'>{l}</a></p><p>{b}</p></div><p>{t}</p>"),
        ("nd.example", "<h1 class='article__title'>{t}</h1><div class='main-content'><div class='article__sapo'>{l}</div><time class='time'>25/04/2025 07:05</time>"
         "<div class='article__body'><p>{a}</p><figure>no</figure><table class='picture'><tr><td>no</td></tr></table><p>{b}</p></div></div>"),
        ("m.tg.example", "<h1 class='story-headline'>{t}</h1><div class='flex-fill'><div class='story-teaser'>{l}</div><div class='ml-lg-auto'>1/2/2024 8:00</div>"
         "<div class='story-body'><p>{a}</p><img src='i'><p>{b}</p></div></div>"),
        ("vnet.example", "<div class='main-v1 bg-white'><div class='bread-crumb-detail__time'>1/2/2024 8:00</div><div class='content-detail'>"
         "<div class='article-detail-author-wrapper'>{t}</div><p>{a}</p><div class='vnn-share-social share-social'>no</div><p>{b}</p><article>{l}</article></div></div>"),
        ("vnex.example", "<section class='section page-detail top-detail'><span class='date'>1/2/2024 8:00</span><p class='description'>{l}</p>"
         "<p class='Normal'>{a}</p><p class='Normal' style='text-align:right;'>{t}</p><p class='Normal'>{b}</p></section>"),
        ("a.b.vtc.example", "<span class='x time-update'>1/2/2024 8:00</span><div class='content-wrapper pt5 mt5 font18 gray-31 bor-4top-e5 lh-1-5'><p>{a}</p><p>{b}</p></div>{l}"),
        ("other.example", "<article>{a}</article>"),
    ]
    kind = F.col("doc_id") % len(forms)
    url = F.concat(F.lit("https://"), F.get(F.array(*[F.lit(h) for h, _ in forms]), kind.cast("int")), F.lit("/"), F.col("doc_id"))
    html = F.get(F.array(*[page(f) for _, f in forms]), kind.cast("int"))
    return docs.select("doc_id", url.alias("url"), F.concat(F.lit("<html><body>"), html, F.lit("</body></html>")).alias("html"))


@query(
    "site_articles",
    SQL_SITE_WORDS
    + r""" SELECT doc_id, CASE WHEN k < 6 THEN ['dantri', 'nd', 'tg', 'vnet', 'vnex', 'vtc'][k + 1] END AS source,
           CASE k WHEN 0 THEN '2024-05-22T10:00:00' WHEN 1 THEN '2025-04-25T07:05:00' WHEN 6 THEN NULL ELSE '2024-02-01T08:00:00' END AS time,
           CASE k WHEN 0 THEN a || ' ' || l || E'\n\n' || b WHEN 1 THEN '# ' || t || E'\n\n' || l || E'\n\n' || a || E'\n\n' || b
             WHEN 2 THEN '# ' || t || E'\n\n' || l || E'\n\n' || a || E'\n\n' || b WHEN 3 THEN a || E'\n\n' || b
             WHEN 4 THEN l || E'\n\n' || a || ' ' || b WHEN 5 THEN a || E'\n\n' || b END AS content,
           k = 6 AS is_err_link, CASE WHEN k = 6 THEN 'no parser' END AS failure
         FROM (SELECT *, doc_id % 7 AS k FROM d)""",
)
def site_articles(t):
    """The six site profiles and a site without one, by their hosts."""
    pages = site_pages(t)
    hosts = [(f"{name}.example", name) for name in ("dantri", "nd", "tg", "vnet", "vnex", "vtc")]
    found = pg.site_articles(pages, pages.sparkSession.createDataFrame(hosts, "host string, source string"))
    return found.select("doc_id", "source", "time", "content", "is_err_link", "failure")


# Blanks and the signs that markdown adds; both sides are compared without them.
MARKS = r"[\s#*_|`-]"


@query(
    "page_article_text",
    rf"""WITH a AS (SELECT page_id, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', '', 'g') AS t FROM pages),
         u AS (SELECT page_id, replace(replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '&copy;', '©'), '&middot;', '·') AS t FROM a)
         SELECT page_id, regexp_replace(t, '{MARKS}', '', 'g') AS letters, page_id % 3 = 0 AS is_err_link FROM u""",
)
def page_article_text(t):
    rows = pg.articles(timed_pages(t))
    return rows.select("page_id", F.regexp_replace("content", MARKS, "").alias("letters"), "is_err_link")


@query(
    "crawl_new_links",
    SQL_LINKS
    + f""", good AS (SELECT page_id, pos, link, title FROM l WHERE {sql_word_count('title')} > 0 AND contains(link, 'e')),
        first AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1),
        fresh AS (SELECT * FROM first WHERE link NOT IN (SELECT link FROM l WHERE length(title) = 3))
        SELECT page_id, CAST(pos AS INT) AS pos, link, title, 500 + row_number() OVER (ORDER BY page_id, pos) AS idx FROM fresh""",
)
def crawl_new_links(t):
    pages = t("pages").select("page_id", "url", "html")
    stored = pg.links(pages).filter(F.length("title") == 3).select("link")
    return pg.new_links(pages, stored, pg.LinkRule(0, contains="e"), "page_id", 500)
