"""Web pages: the crawl frontier, link extraction and admission, articles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions import batches as bt
from talkmill.functions import pages as pg
from talkmill.functions import text as tx
from talkmill.functions.markdown import clean_markdown
from talkmill.operators import dedup
from talkmill.operators.ordered import index_rows
from talkmill.session import join_facts, ship_package, stage

# Page address templates of the site sections, by site.
# {section} is the section address, {stem} the address without its ending.
FRONTIER_TEMPLATES = {
    "dantri": ("{stem}/trang-{n}.htm", ".htm"),
    "vnet": ("{section}-page{n}", ""),
    "vnex": ("{section}-p{n}", ""),
    "vtc": ("{stem}/trang-{n}.html", ".html"),
    "tg": ("{section}?page={n}", ""),
    "nd": ("{section}-{n}.html?phrase=", ""),
}


@dataclass(frozen=True)
class LinkRule:
    """Which links of a source count: more than ``min_words`` title words, an
    ending, and a part of the address; NULL means no test."""

    min_words: int
    ending: str | None = None
    contains: str | None = None
    base: str | None = None


# Link rules by source.
LINK_RULES = {
    "dantri": LinkRule(5, ".htm", "https://dantri.com.vn/"),
    "vnet": LinkRule(5, ".html", None, "https://vietnamnet.vn/"),
    "vnex": LinkRule(5, ".html"),
    "vtc": LinkRule(5, ".html", None, "https://vtcnews.vn/"),
    "nd": LinkRule(3, None, None, "https://en.nhandan.vn/"),
    "tg": LinkRule(3, None, None, "https://tuyengiao.vn/"),
}


def page_address(section: Column, template: str, ending: str, n: Column) -> Column:
    """Address of page ``n`` of a section; sections without the ending stay as
    they are where the template replaces an ending."""
    stem = F.regexp_replace(section, ending.replace(".", r"\.") + "$", "") if ending else section
    pieces: list[Column] = []
    rest = template
    for name, value in (("{section}", section), ("{stem}", stem), ("{n}", n.cast("string"))):
        if name in rest:
            before, rest = rest.split(name, 1)
            pieces += [F.lit(before), value]
    return F.concat(*pieces, F.lit(rest))


def frontier(
    sections: DataFrame,
    start: int,
    end: int,
    source: str = "source",
    section: str = "section",
    cap: str | None = None,
) -> DataFrame:
    """Addresses of pages ``start`` .. ``end - 1`` of every section; ``cap``
    names a column with a section's own end."""
    stop = F.lit(end) if cap is None else F.least(F.col(cap), F.lit(end))
    pages = sections.filter(stop > start).withColumn("page", F.explode(F.sequence(F.lit(start), stop - 1)))
    address = F.lit(None).cast("string")
    for name, (template, ending) in FRONTIER_TEMPLATES.items():
        address = F.when(
            F.col(source) == name, page_address(F.col(section), template, ending, F.col("page"))
        ).otherwise(address)
    return pages.withColumn("page_url", address)


SCRIPTED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR = r"(?is)<a\s[^>]*?\bhref\s*=[^>]*>.*?</a\s*>"
HREF = r"""(?is)^<a\s[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""
# The named references that occur in addresses and titles.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def unescape(text: Column) -> Column:
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def anchors(html: Column) -> Column:
    """``array<struct<href, title>>`` of the anchors of a page; the title is the
    stripped text of the anchor, its pieces joined as they stand."""
    found = F.regexp_extract_all(F.regexp_replace(html, SCRIPTED, ""), F.lit(ANCHOR), F.lit(0))

    def parts(a: Column) -> Column:
        href = F.concat(*[F.regexp_extract(a, HREF, g) for g in (1, 2, 3)])
        inner = F.regexp_replace(F.regexp_replace(a, r"(?is)^<a\s[^>]*>|</a\s*>$", ""), r"\s*<[^>]*>\s*", "")
        return F.struct(tx.strip(unescape(href)).alias("href"), tx.strip(unescape(inner)).alias("title"))

    return F.transform(found, parts)


def links(pages: DataFrame, url: str = "url", html: str = "html", resolve: str = "page") -> DataFrame:
    """One row per anchor: the page columns but its HTML, ``pos, href, title, link``.

    ``resolve="page"`` resolves against the page, ``"base"`` joins to the
    ``base`` column, ``"none"`` keeps the address as it stands.
    """
    kept = [c for c in pages.columns if c != html]
    rows = pages.select(*kept, F.posexplode(anchors(F.col(html))).alias("pos", "a")).select(
        *kept, "pos", "a.href", "a.title"
    )
    link = {
        "page": lambda: tx.resolve_url(F.col("href"), F.col(url)),
        "base": lambda: tx.absolute_url(F.col("href"), F.col("base")),
        "none": lambda: F.col("href"),
    }[resolve]()
    return rows.withColumn("link", link)


def admitted(rows: DataFrame, rule: LinkRule, link: str = "link", title: str = "title") -> DataFrame:
    """Links that meet the rule of their source."""
    test = tx.word_count(F.col(title)) > rule.min_words
    if rule.ending is not None:
        test = test & F.endswith(F.col(link), F.lit(rule.ending))
    if rule.contains is not None:
        test = test & F.contains(F.col(link), F.lit(rule.contains))
    return rows.filter(test)


def feed_links(feeds: DataFrame, base: str, lang: str, body: str = "body") -> DataFrame:
    """Links of JSON article feeds: ``{data: {contents: [{title, url}]}}``; feeds
    with an error code other than 0 give nothing."""
    schema = "struct<error_code:int,data:struct<contents:array<struct<title:string,url:string>>>>"
    parsed = feeds.withColumn("_f", F.from_json(body, schema)).filter(F.col("_f.error_code") == 0)
    rows = parsed.select(
        *[c for c in feeds.columns if c != body], F.explode("_f.data.contents").alias("c")
    ).filter(F.coalesce("c.url", F.lit("")) != "")
    return rows.select(
        *[c for c in feeds.columns if c != body],
        tx.absolute_url(F.col("c.url"), F.lit(base)).alias("link"),
        F.col("c.title").alias("title"),
        F.lit(base).alias("base_url"),
        F.lit(lang).alias("lang"),
    )


@dataclass(frozen=True)
class Profile:
    """How the article of a site is found.

    Selectors are ``tag``, ``tag.class`` or ``tag[all these classes]``; the first
    that matches counts.  ``outer`` narrows the page first; title, teaser and
    body are joined; ``fallback`` bodies serve pages of another layout.
    """

    time: tuple[str, ...] = ()
    outer: tuple[str, ...] = ()
    title: tuple[str, ...] = ()
    teaser: tuple[str, ...] = ()
    body: tuple[str, ...] = ()
    paragraphs: str | None = None
    drops: tuple[str, ...] = field(default=("img", "figure", "table.picture"))
    fallback: tuple[str, ...] = ()


# Article profiles by source.
PROFILES = {
    "dantri": Profile(
        time=("time.author-time",), body=("div.singular-content",), drops=(), fallback=("div.e-magazine__body",)
    ),
    "nd": Profile(
        time=("time.time",),
        outer=("div.main-content",),
        title=("h1.article__title",),
        teaser=("div.article__sapo",),
        body=("div.article__body",),
    ),
    "tg": Profile(
        time=("div.ml-lg-auto",),
        outer=("div.flex-fill",),
        title=("h1.story-headline",),
        teaser=("div.story-teaser",),
        body=("div.story-body",),
    ),
    "vnet": Profile(
        time=("div.bread-crumb-detail__time",),
        outer=("div[main-v1 bg-white]",),
        body=("div.content-detail",),
        drops=(
            "div.article-detail-author-wrapper",
            "div[vnn-share-social share-social]",
            "img",
            "figure",
            "article",
        ),
    ),
    "vnex": Profile(
        time=("span.date",),
        outer=("section[section page-detail top-detail]", "section[section page-detail detail-photo]"),
        teaser=("p.description",),
        paragraphs="p.Normal",
        drops=(),
    ),
    "vtc": Profile(
        time=("span.time-update",),
        body=("div[content-wrapper pt5 mt5 font18 gray-31 bor-4top-e5 lh-1-5]",),
        drops=(),
    ),
    # Plain pages: an article with its heading inside.
    "plain": Profile(time=("time",), body=("article", "main", "body"), drops=("img", "figure", "nav", "script")),
}


def profile_parser(profile: Profile) -> Callable[[str], dict | None]:
    """Function from HTML to raw ``time, content``, or None when the layout is
    another one."""

    def run(html: str) -> dict | None:
        root = pg.parse(html)
        time_node = pg.select(root, profile.time)
        outer = pg.select(root, profile.outer) if profile.outer else root
        if outer is None:
            return None
        time = pg.inner_text(time_node)
        title, teaser = pg.select(root, profile.title), pg.select(outer, profile.teaser)
        if profile.paragraphs:
            lines = [
                pg.inner_text(p)
                for p in pg.select_all(outer, profile.paragraphs)
                if "text-align:right" not in p.attrs.get("style", "")
            ]
            lead = pg.inner_text(teaser)
            return {"time": time, "content": "\n\n".join(x for x in (lead, "\n".join(lines)) if x)}
        body = pg.select(outer, profile.body) or pg.select(root, profile.fallback)
        if body is None:
            return None
        if time_node is not None and time_node.parent is not None and time_node in time_node.parent.children:
            time_node.parent.children.remove(time_node)
        pg.drop(body, profile.drops)
        pieces = [pg.to_markdown(n) for n in (title, teaser, body) if n is not None]
        return {"time": time, "content": "\n\n".join(p.strip("\n") for p in pieces)}

    return run


# Parsers by source; add to it to support another site.
PARSERS: dict[str, Callable[[str], dict | None]] = {name: profile_parser(p) for name, p in PROFILES.items()}


def articles(
    pages: DataFrame,
    parsers: dict[str, Callable[[str], dict | None]] | None = None,
    source: str = "source",
    html: str = "html",
) -> DataFrame:
    """Pages as articles: the page columns but the HTML, ``time, content,
    is_err_link, failure``.

    The parser of a page is the one of its ``source``.  A page that has none or
    fails gives a row with a ``failure`` and no content; no page can fail a task.
    Only tag handling runs in Python, over a bounded stretch of pages at a
    time; markdown clean-up is expressions.
    """
    chosen = dict(PARSERS if parsers is None else parsers)
    kept = [c for c in pages.columns if c != html]

    def one(name: str, page: str | None) -> tuple[str | None, str | None, str | None]:
        if page is None:
            return None, None, "no page"
        if name not in chosen:
            return None, None, "no parser"
        try:
            found = chosen[name](page)
        except Exception as error:  # a bad page becomes an error row
            return None, None, f"{type(error).__name__}: {error}"
        if found is None:
            return None, None, "layout"
        return found.get("time"), found.get("content"), None

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, texts in batches:
            for low, n in bt.by_size(texts):
                rows = [one(s.as_py(), p.as_py()) for s, p in zip(names.slice(low, n), texts.slice(low, n))]
                parts = [pa.array([r[k] for r in rows], pa.string()) for k in range(3)]
                del rows
                yield pa.StructArray.from_arrays(parts, names=["time", "raw", "failure"])

    ship_package(pages.sparkSession)
    # Not deterministic: pages must not be parsed again for a filter.
    found = F.arrow_udf(run, "time string, raw string, failure string").asNondeterministic()
    raw = pages.withColumn("_found", found(F.col(source), F.col(html))).select(*kept, "_found.*")
    content = tx.strip(clean_markdown(F.col("raw")))
    parsed = raw.withColumn("content", content)
    missing = (F.coalesce("content", F.lit("")) == "") | (F.coalesce("time", F.lit("")) == "")
    return parsed.select(
        *kept,
        tx.iso_time(F.col("time")).alias("time"),
        "content",
        missing.alias("is_err_link"),
        "failure",
    )


def host_of(url: Column) -> Column:
    """Host of a URL, without user and port, in lower case."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1))


def site_articles(pages: DataFrame, hosts: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pages of several sites as articles, in one pass: ``hosts`` (``host,
    source``; a host also stands for its subdomains) says which profile reads
    a page; the longest host that fits counts.  Pages of other hosts come out
    with a failure, as in ``articles``.

    Each page carries the few names its host may be listed under, so the join
    is on equal hosts; the host table has one row per site.
    """
    parts = F.split(host_of(F.col(url)), r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    asked = pages.select(url).distinct().select(F.col(url).alias("_url"), F.posexplode(names).alias("_depth", "host"))
    found = asked.join(hosts.select(F.lower("host").alias("host"), "source"), "host")
    chosen = found.groupBy("_url").agg(F.min_by("source", "_depth").alias("source"))
    known = join_facts(pages.withColumn("_url", F.col(url)), chosen, "_url", "left").drop("_url")
    return articles(known, source="source", html=html)


def split_articles(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a time and content, or not."""
    good = (F.coalesce("time", F.lit("")) != "") & (F.coalesce("content", F.lit("")) != "")
    return rows.filter(good), rows.filter(~good)


def article_columns(rows: DataFrame) -> DataFrame:
    """Parsed articles with ``published`` and ``word_count``."""
    return rows.withColumns(
        {"published": tx.first_date(F.col("time")), "word_count": tx.word_count(F.col("content"))}
    )


def rules_frame(spark, rules: dict[str, LinkRule] | None = None) -> DataFrame:
    """Link rules as a table: one row per source."""
    chosen = LINK_RULES if rules is None else rules
    rows = [(n, r.min_words, r.ending, r.contains, r.base) for n, r in chosen.items()]
    return spark.createDataFrame(
        rows, "source string, min_words int, ending string, contains string, base string"
    )


def admitted_by_source(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Links that meet the rule of their own ``source``; the rule table has one
    row per site, and is broadcast where its size allows."""
    wanted = rows.join(rules, "source")
    return wanted.filter(
        (tx.word_count(F.col("title")) > F.col("min_words"))
        & (F.col("ending").isNull() | F.endswith("link", "ending"))
        & (F.col("contains").isNull() | F.contains("link", "contains"))
    ).select(*rows.columns)


def new_links(
    pages: DataFrame, stored: DataFrame, rule: LinkRule, page_key: str, existing_max: int | None
) -> DataFrame:
    """Admitted links that are not stored yet, each once (where it is met
    first), with the next indexes: ``page_key, pos, link, title, idx``.

    The narrow links are staged: they are read more than once, their pages
    should not be.
    """
    found = admitted(links(pages), rule).select(page_key, "pos", "link", "title")
    placed = stage(found.withColumn("place", F.struct(page_key, "pos")), "links")
    fresh = dedup.insert_new(stored, placed, "link", "place")
    return index_rows(fresh, existing_max, [F.col("place")]).drop("place")
