"""Column functions over plain text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkmill import fixed


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Blanks removed at both ends, Unicode blanks included."""
    return F.btrim(text, F.lit(fixed.BLANK_CHARS))


def words(text: Column) -> Column:
    """Words between runs of blanks; no empty words."""
    return F.filter(F.split(text, f"(?U)[{fixed.BLANKS}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words; counting matches is cheaper than splitting."""
    return F.regexp_count(text, F.lit(f"(?U)[^{fixed.BLANKS}]+")).cast("bigint")


def cjk_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(fixed.CJK)).cast("bigint")


def has_cjk(text: Column) -> Column:
    return text.rlike(fixed.CJK)


def mixed_script(text: Column) -> Column:
    """A word over 3 characters that is partly but less than half CJK, or more
    than 40 % of the words with CJK in them.  NULL when there is no word."""

    def test(ws: Column) -> Column:
        broken = F.exists(
            ws,
            lambda w: (F.length(w) > 3)
            & has_cjk(w)
            & (cjk_count(w) / F.length(w) < 0.5),
        )
        share = F.try_divide(F.size(F.filter(ws, has_cjk)), F.size(ws))
        return broken | (share > 0.4)

    return bind(words(text), test)


def has_initials(text: Column) -> Column:
    return text.rlike(fixed.INITIALS)


def needs_context(question: Column, context_words: Sequence[str] = fixed.CONTEXT_WORDS) -> Column:
    """The question refers to its source text, or names people by initials."""
    lowered = F.lower(question)
    found = has_initials(question)
    for word in context_words:
        found = found | F.contains(lowered, F.lit(word))
    return found


def think_text(title: Column) -> Column:
    """Inside of a think block when there is one, else the title itself."""
    inner = F.regexp_extract(title, r"(?s)<think>(.*?)</think>", 1)
    return F.when(inner != "", strip(inner)).otherwise(title)


def translation_cleanup(text: Column) -> Column:
    """Message tags removed; a leading ```text fence and its end removed."""
    plain = F.regexp_replace(text, "</?msg>", "")
    return F.when(
        F.startswith(plain, F.lit("```text")),
        F.regexp_replace(F.substring(plain, F.lit(8), F.length(plain)), r"(?s).{0,3}\z", ""),
    ).otherwise(plain)


def strip_lead_ins(
    text: Column,
    lead_ins: Sequence[str] = fixed.LEAD_INS,
    drop_first: Sequence[str] = fixed.DROP_FIRST_SENTENCE,
) -> Column:
    """Lead-ins removed where the first sentence has them (then trimmed and
    capitalised); the whole first sentence removed where it holds a trigger.

    First sentence and remainder always come from the original text, so a
    trigger wins over the lead-in removal.
    """

    def capital(t: Column) -> Column:
        return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.length(t)))

    first = F.substring_index(text, ".", 1)
    cleaned = F.aggregate(
        F.filter(F.array(*[F.lit(x) for x in lead_ins]), lambda tag: F.contains(first, tag)),
        text,
        lambda acc, tag: bind(strip(F.replace(acc, tag, F.lit(""))), capital),
    )
    trigger = F.exists(F.array(*[F.lit(x) for x in drop_first]), lambda tag: F.contains(first, tag))
    rest = F.when(F.contains(text, F.lit(".")), strip(F.substring(text, F.length(first) + 2, F.length(text))))
    return F.when(trigger, F.coalesce(rest, F.lit(""))).otherwise(cleaned)


def is_refusal(text: Column, phrases: Sequence[str] = fixed.REFUSALS) -> Column:
    return F.exists(
        F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(F.lower(text), p)
    )


def first_date(text: Column) -> Column:
    """First d/m/yyyy in the text, at midnight; NULL when none or not a date."""
    found = F.regexp_extract(text, r"(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.try_to_timestamp(found, F.lit("d/M/yyyy"))


def iso_time(text: Column) -> Column:
    """``dd/MM/yyyy HH:mm`` as ISO text; anything else unchanged."""
    parsed = F.try_to_timestamp(text, F.lit("d/M/yyyy H:m"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss"), text)


def absolute_url(href: Column, base: Column) -> Column:
    """Absolute links kept; others joined to ``base`` with one slash."""
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(
        F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(href, "^/+", ""))
    )


def resolve_url(href: Column, page: Column) -> Column:
    """``href`` resolved against the page it stands on (scheme-relative, root,
    query, fragment and sibling forms; dot segments collapse)."""
    origin = F.regexp_extract(page, r"^(\w+://[^/?#]+)", 1)
    scheme = F.regexp_extract(page, r"^(\w+:)", 1)
    no_fragment = F.regexp_replace(page, "#.*$", "")
    no_query = F.regexp_replace(no_fragment, r"\?.*$", "")
    # A page without a path stands at the root.
    folder = F.when(no_query == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_replace(no_query, "[^/]*$", "")
    )
    joined = (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .when(href == "", page)
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .otherwise(F.concat(folder, href))
    )
    return _collapse_dots(joined)


def _collapse_dots(url: Column) -> Column:
    """``.`` and ``..`` path segments resolved, where there are any."""

    def collapse(u: Column) -> Column:
        origin = F.regexp_extract(u, r"^(\w+://[^/?#]+)", 1)
        path = F.regexp_extract(u, r"^\w+://[^/?#]+(/[^?#]*)", 1)
        tail = F.substring(u, F.length(origin) + F.length(path) + 1, F.length(u))
        kept = F.aggregate(
            F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1),
            F.array().cast("array<string>"),
            lambda acc, seg: F.when(seg == ".", acc)
            .when(seg == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
            .otherwise(F.concat(acc, F.array(seg))),
        )
        # A path that ends in a dot segment names a folder.
        end = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
        new_path = F.concat(F.lit("/"), F.array_join(kept, "/"))
        return F.concat(origin, new_path, F.when(new_path == "/", F.lit("")).otherwise(end), tail)

    dotted = url.rlike(r"^\w+://[^/?#]+/([^?#]*/)?\.\.?(/|$|\?|#)")
    return F.when(dotted, bind(url, collapse)).otherwise(url)


def checkpoint_number(path: Column) -> Column:
    """Number in ``checkpoint-<n>``; NULL when there is none."""
    return F.regexp_extract(path, r"checkpoint-([0-9]+)", 1).try_cast("bigint")


def version_number(tag: Column) -> Column:
    """First digits of a version tag (``v12`` -> 12); NULL when there are none."""
    return F.regexp_extract(tag, r"(\d+)", 1).try_cast("bigint")


def registry_name(path: Column) -> Column:
    """Model name of a ``models:/<name>/<version>`` path."""
    return F.regexp_extract(path, r"^(?:models:/)?([^/]+)/", 1)


def registry_version(path: Column) -> Column:
    """Version or alias of a ``models:/<name>/<version>`` path."""
    return F.substring_index(path, "/", -1)
