"""Main text of web pages: site templates and page furniture are removed.

Every page is parsed once, into text segments.  A segment carries the hashes
of the element subtrees it stands in.  Spark counts for each host on how many
different pages a subtree occurs, copies and versions of a page as one; one that
recurs across many pages of its host is part of the site's template and its
segments go.  Furniture that differs from page to page (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) goes by
its element, role or class.  A class counts where its name consists of
furniture words and neutral ones; where a furniture word only begins or ends
the name, the box must also be small, or of a kind that never is a page's own
text, and hold no article.  No class counts on what holds the page's own text:
that is known at the end of the page.  Within articles only boxes count as
template, never a paragraph, since sites quote themselves.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import ship_package, stage, text_of
from talkmill.session import join_facts

LEAST_PAGES = 5  # different pages of a host that a template is on
LEAST_SHARE = 0.3  # of the host's different pages

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript noembed noframes iframe template".split())
SHOWN_RAW = frozenset("xmp plaintext".split())  # their content is text, whatever it looks like
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"td", "th", "tr"}, "tbody": {"td", "th", "tr", "thead"}, "tfoot": {"td", "th", "tr", "tbody"}}
SCOPES = frozenset("ul ol dl table select article section div body html".split())

FURNITURE = frozenset(
    "script style noscript noembed noframes template head title nav aside footer form iframe button select option textarea input svg canvas "
    "object embed dialog menu audio video map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLASSES = frozenset(
    "ad ads adsbygoogle adsense adslot adunit advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside footer cookie cookies consent notice gdpr popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended widget comment comments disqus respond pagination pager toolbar "
    "masthead topbar skip".split()
)
# Words that may stand beside those in one name, as in "site-footer" or "ad-slot".
NEUTRAL = frozenset(
    "area bar block body bottom box button buttons cell container content div entry form google gpt group header heading icons inner "
    "item items left link links list main page post posts primary right row secondary section site slot text title top unit "
    "wrap wrapper".split()
)
# Words of text as well as of furniture: outside boxes, inside an article, no mark.
AMBIGUOUS = frozenset("aside banner comment comments notice overlay promo promotion recommended related respond share sharing skip social subscribe widget".split())
# Lists of others' articles, and what is never the page's own text.
LISTS = frozenset("comment comments disqus respond related recommended".split())
NEVER = LISTS | frozenset(
    "ad ads adsbygoogle adsense adslot adunit advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr".split()
)
# Words that say what a box is when they begin its name, whatever follows; and
# those that do not when they end one, being words for text or for one comment.
HEADS = NEVER - LISTS | frozenset("comments disqus nav navbar breadcrumb breadcrumbs sidebar popup newsletter masthead topbar".split())
NO_ENDS = frozenset("aside comment footer notice related respond skip social widget".split())
# Names that tell what a page has beside the element, or how it looks.
FLAGS = frozenset("has no with without hide show is not".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dt dd".split())
SMALL = 200  # characters; a box is small also with a third of the page's text
BOXES = frozenset("div section ul ol table aside details figure".split())
COUNTED = BOXES | frozenset("nav header footer form p h1 h2 h3 h4 blockquote pre dl".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_NAME = re.compile(r"[\s/]*(=?[^\s/>=]*)\s*(=?)\s*")
_PLAIN = re.compile(r"[^\s>]*")
_TRACKING = re.compile(r"(?:utm_\w+|fbclid|gclid|dclid|msclkid|yclid|igshid|mc_cid|mc_eid)(?:=|\Z)", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SIZE = re.compile(r"\d+(?:x\d+)?")


class Mark:
    """An element that looks like furniture by its class or id, in ``above``;
    ``weak`` if only the head or end of a name says so."""

    __slots__ = ("words", "weak", "above", "main", "articles", "size", "drop", "gone")

    def __init__(self, words: frozenset[str], weak: bool, above: Mark | None):
        self.words, self.weak, self.above = words, weak, above
        self.main, self.articles, self.size, self.drop, self.gone = False, 0, 0, True, True


class Element:
    __slots__ = ("tag", "gone", "mark", "article", "hash", "link", "own")

    def __init__(self, tag: str, gone: bool, mark: Mark | None, article: bool, link: int, own: bool):
        self.tag, self.gone, self.mark, self.article, self.link, self.own = tag, gone, mark, article, link, own
        self.hash = hashlib.blake2b(tag.encode(), digest_size=8)


NONE: frozenset[str] = frozenset()


def read_attributes(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes of a tag from behind its name, whether it ends itself, and
    the place behind it.  The first of two equal names counts.  A quote opens
    a value only at its beginning; one that is never closed ends at the tag's
    end."""
    found: dict[str, str] = {}
    size, slash = len(page), False
    while at < size:
        m = _NAME.match(page, at)
        if not m[1]:
            # Blanks and slashes up to the end of the tag.
            slash = "/" in m[0]
            at = m.end()
            return found, slash, at + 1 if at < size else size
        name, value = m[1].lower(), ""
        at = m.end() if m[2] else m.end(1)
        if m[2]:
            quote = page[at : at + 1]
            end = page.find(quote, at + 1) if quote in ("'", '"') and quote else -1
            if end >= 0:
                value, at = page[at + 1 : end], end + 1
            elif quote in ("'", '"') and quote:
                end = page.find(">", at)
                end = size if end < 0 else end
                value, at = page[at + 1 : end], end
            else:
                plain = _PLAIN.match(page, at)
                value, at = plain[0], plain.end()
        found.setdefault(name, entities.unescape(value))
    return found, slash, size


@functools.lru_cache(1 << 16)
def _marks_of(name: str) -> tuple[frozenset[str], bool]:
    """Furniture words of a class or id, and whether they only begin or end
    it: all its words are such or neutral, or the first or the last that is
    not neutral is one."""
    words = [w.lower() for w in _WORDS.findall(_SIZE.sub(" ", name))]
    found = frozenset(words) & CLASSES
    if words and frozenset(words) - found <= NEUTRAL:
        return found | (frozenset(words) & {"header"}), False
    told = [w for w in words if w not in NEUTRAL]
    if not told or words[0] in FLAGS:
        return NONE, False
    ends = frozenset(told[-1:]) & (CLASSES - NO_ENDS)
    return ends | (frozenset(told[:1]) & HEADS), True


def _furniture(tag: str, found: dict[str, str], article: bool) -> tuple[bool, frozenset[str], bool]:
    """Whether an element is furniture by itself, and else by which words, and
    whether these are weak."""
    if tag in FURNITURE or (tag == "header" and not article):
        return True, NONE, False
    if not found:
        return False, NONE, False
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _role(found) in ROLES:
        return True, NONE, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, NONE, False
    if tag in ("html", "body", "article", "main") or _role(found) == "main":
        return False, NONE, False
    marks = [_marks_of(name) for key in ("class", "id") for name in found.get(key, "").split()]
    strong = NONE.union(*(w for w, weak in marks if not weak))
    weak = NONE.union(*(w for w, weak in marks if weak)) if tag not in TEXT_TAGS else NONE
    # A section of comments is a box of comments; one comment may be the author's.
    if tag not in BOXES or tag in ("section", "table", "figure"):
        text_words = AMBIGUOUS - ({"comments"} if tag == "section" else NONE)
        weak -= text_words
        strong -= text_words if article else NONE
    if article:
        strong -= {"header"}
    return (False, strong, False) if strong else (False, weak, True)


def _role(found: dict[str, str]) -> str:
    return found.get("role", "").strip().lower()


def _judge(marks: list[Mark], out: list[tuple[list, bool, int]]) -> None:
    """Which marked elements go: not those that hold the page's own text.

    ``marks`` has outer elements before the ones in them."""

    def own_article() -> bool:
        for m in marks:
            m.gone = m.drop or (m.above is not None and m.above.gone)
        return any(article and not (mark and mark.gone) for parts, article, _ in out for _, mark in parts)

    total = 0
    for parts, _, _ in out:
        for raw, mark in parts:
            length = len("".join(raw.split()))
            total += length
            if mark:
                mark.size += length
    for m in reversed(marks):
        if m.above is not None:
            m.above.size, m.above.articles, m.above.main = m.above.size + m.size, m.above.articles + m.articles, m.above.main or m.main
    for m in marks:
        small = m.size <= SMALL or 3 * m.size <= total
        m.drop = not m.main and (not m.weak or (not m.articles and bool(m.words & NEVER or small)))
    if own_article():
        return
    for m in marks:
        if m.articles and (m.articles == 1 or not m.words & LISTS):
            m.drop = False
    if own_article():
        return
    for m in marks:
        if 2 * m.size > total and not m.words & NEVER:
            m.drop = False
    own_article()


class Page:
    """What is read of a page.  ``texts`` in order: text, whether it is in an
    article, and its innermost link.  A link is an element that counts as a
    possible template of what it holds: ``above`` is the next one around it
    (-1: none) and ``numbers`` its subtree's hash, so nesting, however deep,
    costs no more than the page is long.  ``subtrees``: the hashes of all
    counted elements."""

    def __init__(self) -> None:
        self.texts: list[tuple[str, bool, int]] = []
        self.above: list[int] = []
        self.numbers: list[int] = []
        self.subtrees: set[int] = set()


def segments(page: str) -> Page:
    """Texts of a page with the subtrees they stand in.

    A text is what stands between two block borders.  Furniture has no text
    but is hashed.  Broken markup is read leniently: what is open at the end
    is closed there.
    """
    read = Page()
    stack: list[Element] = [Element("", False, None, False, -1, False)]
    out: list[tuple[list, bool, int]] = []
    pieces: list[tuple[str, Mark | None]] = []
    marked: list[Mark] = []
    open_tags = {"": 1}

    def flush() -> None:
        if pieces:
            if not stack[-1].gone and any(raw.strip() for raw, _ in pieces):
                out.append((pieces[:], stack[-1].article, stack[-1].link))
            pieces.clear()

    def close() -> None:
        element = stack[-1]
        if element.tag not in INLINE:
            flush()
        stack.pop()
        open_tags[element.tag] -= 1
        digest = element.hash.digest()
        stack[-1].hash.update(digest)
        if element.tag in COUNTED:
            number = int.from_bytes(digest, "big", signed=True)
            read.subtrees.add(number)
            if element.own:
                read.numbers[element.link] = number

    def text(raw: str, plain: bool = False) -> None:
        if raw:
            stack[-1].hash.update(raw.encode("utf-8", "replace"))
            if not stack[-1].gone:
                pieces.append((raw if plain else entities.unescape(raw), stack[-1].mark))

    def close_siblings(tags, scopes) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in tags:
                while len(stack) > depth:
                    close()
                return
            if tag in scopes:
                return

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[1] is not None:
            text(m[1], True)
        if m[3] is None:
            continue
        tag = m[3].lower()
        found, slash, at = read_attributes(page, at)
        if m[2]:
            if tag == "p" and not open_tags.get("p") or tag == "br":
                flush()
            elif open_tags.get(tag):
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in VOID:
            if tag not in INLINE:
                # A break is white space in its block.
                if tag == "br":
                    text("\n")
                else:
                    flush()
            continue
        if tag in ENDS_P and open_tags.get("p"):
            close_siblings(("p",), SCOPES)
        if tag in SIBLINGS:
            while any(open_tags.get(t) for t in SIBLINGS[tag]):
                before = len(stack)
                close_siblings(SIBLINGS[tag], SCOPES - {"div"})
                if len(stack) == before:
                    break
        if tag not in INLINE:
            flush()
        outer = stack[-1]
        main = tag == "main" or _role(found) == "main"
        inside = outer.article or main or tag == "article"
        gone, words, weak = _furniture(tag, found, outer.article)
        gone, mark = gone or outer.gone, outer.mark
        if mark and not gone:
            mark.main |= main
            mark.articles += tag == "article"
        if words and not gone:
            mark = Mark(words, weak, mark)
            marked.append(mark)
        own = tag in COUNTED and (tag in BOXES or not inside)
        link = outer.link
        if own:
            read.above.append(link)
            read.numbers.append(0)
            link = len(read.above) - 1
        stack.append(Element(tag, gone, mark, inside, link, own))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if slash and tag in ("svg", "path"):
            close()
        elif tag in RAW or tag in SHOWN_RAW:
            end = None if tag == "plaintext" else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            stop = end.start() if end else size
            if tag in RAW:
                stack[-1].hash.update(page[at:stop].encode("utf-8", "replace"))
            else:
                text(page[at:stop], True)
            at = end.end() if end else size
            close()
    while len(stack) > 1:
        close()
    flush()
    if marked:
        _judge(marked, out)
    for parts, article, link in out:
        joined = " ".join("".join(raw for raw, mark in parts if not (mark and mark.gone)).split())
        if joined:
            read.texts.append((joined, article, link))
    return read


def left_texts(texts: list[str], inside: list[int], above: list[int], numbers: list[int], templates: set[int]) -> list[str]:
    """The texts that no template holds.  An element stands behind those around
    it, so one pass tells which links are in a template."""
    gone: list[bool] = []
    for around, number in zip(above, numbers):
        gone.append(number in templates or (around >= 0 and gone[around]))
    return [t for t, link in zip(texts, inside) if link < 0 or not gone[link]]


PARSED = (
    "row long, page_id long, url string, host string, address string, content long, markup long, texts array<string>, inside array<int>, "
    "above array<int>, numbers array<long>, subtrees array<long>"
)


def host_of(url: str | None) -> str:
    m = re.match(r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/@]*@)?([^/:?#]*)", url or "")
    return m[1].lower() if m else ""


def address_of(url: str | None) -> str | None:
    """The page a url names: without scheme, tracking parameters and anchor."""
    if url is None:
        return None
    left, _, anchor = url.partition("#")
    path, _, query = re.sub(r"^(?:[a-zA-Z][\w+.-]*:)?//", "", left).partition("?")
    kept = [q for q in query.split("&") if q and not _TRACKING.match(q)]
    # Such anchors are routes, not places in a page.
    return "?".join([path, *(["&".join(kept)] if kept else [])]) + (f"#{anchor}" if anchor[:1] in ("!", "/") else "")


def _number(parts: Iterable[str]) -> int:
    return int.from_bytes(hashlib.blake2b("\n".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _holders(inside: list[int], read: Page) -> tuple[list[int], list[int], list[int]]:
    """Links, numbers and the texts' links, of links around kept texts only."""
    used = sorted(set(inside) - {-1})
    wanted = set(used)
    for link in reversed(range(len(read.above))):
        if link in wanted and read.above[link] >= 0:
            wanted.add(read.above[link])
    place = {link: k for k, link in enumerate(sorted(wanted))} | {-1: -1}
    kept = sorted(wanted)
    return [place[i] for i in inside], [place[read.above[i]] for i in kept], [read.numbers[i] for i in kept]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [*(pa.int64(),) * 2, *(pa.string(),) * 3, *(pa.int64(),) * 2, pa.list_(pa.string()), ints, ints, longs, longs]
    for batch in batches:
        rows = []
        for row, page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("row", "page_id", "url", "html"))):
            read = segments(page)
            found = [s for s in read.texts if s[1]] or read.texts
            texts, subtrees = [t for t, _, _ in found], sorted(read.subtrees)
            content, markup = _number(texts), _number(map(str, subtrees))
            rows.append((row, page_id, url, host_of(url), address_of(url), content, markup, texts, *_holders([i for _, _, i in found], read), subtrees))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in PARSED.split(", ")])


def _without_templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("texts", "inside", "above", "numbers", "gone"))
        kept = [left_texts(texts, inside, above, numbers, set(gone)) if gone else texts for texts, inside, above, numbers, gone in zip(*columns)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(kept, pa.list_(pa.string()))], names=["page_id", "url", "texts"])


def parsed_pages(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row for each page: its text segments and subtree hashes, staged."""
    ship_package(pages.sparkSession)
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"), text_of(html).alias("html"),
    )
    return stage(rows.mapInArrow(_parse, PARSED), "pages")


def different_pages(parsed: DataFrame) -> DataFrame:
    """``row, host`` of one row for each page: rows of one address or with the
    same main text are one page.  Both aggregates combine map-side."""
    first = F.min(F.struct("content", "markup", "row")).alias("f")
    # Rows without a url are told apart by their main text only.
    named = parsed.groupBy("host", "address", F.when(F.col("address").isNull(), F.col("content")).alias("_own")).agg(first).select("host", "f.*")
    return named.groupBy("host", "content").agg(F.min(F.struct("markup", "row")).alias("f")).select("host", "f.row")


def site_templates(parsed: DataFrame) -> DataFrame:
    """``host, subtree, pages``: subtrees on many different pages of their host.
    Counts combine map-side, so a large host is no large group."""
    different = stage(different_pages(parsed), "different")
    pages = different.groupBy("host").agg(F.count("*").alias("all"))
    once = parsed.join(different.select("row"), "row", "left_semi")
    counts = once.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").agg(F.count("*").alias("pages"))
    many = stage(counts.where(F.col("pages") >= LEAST_PAGES), "subtrees")
    return join_facts(many, pages, "host").where(F.col("pages") >= LEAST_SHARE * F.col("all")).drop("all")


def main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    The text of the page's articles (or its main element), else of its body,
    without furniture and site templates; character references decoded, white
    space inside a block one blank, blocks joined by one blank.  A null page
    is empty; a page without text gives "" and 0.  A null url is a host of its
    own.  Repeated rows and null ids are rows like others; an empty table
    gives an empty one.
    """
    parsed = parsed_pages(pages, page_id=page_id, url=url, html=html)
    templates = stage(site_templates(parsed), "templates")
    # Only the pairs of page and subtree meet the templates; texts stay.
    pairs = parsed.select("row", "host", F.explode(F.array_distinct("numbers")).alias("subtree"))
    hits = stage(join_facts(pairs, templates.select("host", "subtree"), ["host", "subtree"]).select("row", "subtree"), "hits")
    # Pages that no template touches need no join; the others are few rows.
    touched = stage(hits.groupBy("row").agg(F.collect_set("subtree").alias("gone")), "touched")
    if touched.isEmpty():
        kept = parsed.select("page_id", "url", "texts")
    else:
        marked = parsed.select("row", "page_id", "url", "texts", "inside", "above", "numbers").join(touched, "row", "left").drop("row")
        kept = marked.mapInArrow(_without_templates, "page_id long, url string, texts array<string>")
    text = F.array_join("texts", " ")
    return kept.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
