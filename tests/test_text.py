import datetime as dt
import re
from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkmill.functions import markdown as md
from talkmill.functions import text as tx

QUICK = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
BLANKISH = st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0    　abcéñ你.", max_size=30)


@QUICK
@given(st.lists(BLANKISH, min_size=1, max_size=40))
def test_words_like_split(values, texts):
    assert values(tx.word_count, *texts) == [len(t.split()) for t in texts]
    assert values(tx.words, *texts) == [t.split() for t in texts]
    assert values(tx.strip, *texts) == [t.strip() for t in texts]


def mixed(line):
    words = line.split()
    if not words:
        return None
    cjk = [len(re.findall("[一-鿿]", w)) for w in words]
    if any(c and c / len(w) < 0.5 and len(w) > 3 for c, w in zip(cjk, words)):
        return True
    return sum(c > 0 for c in cjk) / len(words) > 0.4


@QUICK
@given(st.lists(st.text(alphabet="ab 你好", max_size=20), min_size=1, max_size=40))
def test_mixed_script(values, lines):
    assert values(tx.mixed_script, *lines) == [mixed(x) for x in lines]


def test_lead_ins(values):
    got = values(
        tx.strip_lead_ins,
        "Tuyệt vời! abc. def",
        "x gì tôi có y. rest. more ",
        "nothing here",
        "gì tôi có",
        "Chào bạn, Tuyệt vời! vâng",
        "abc. Tuyệt vời! only later",
        "",
        "Tuyệt vời!",
    )
    assert got == ["Abc. def", "rest. more", "nothing here", "", "Vâng", "abc. Tuyệt vời! only later", "", ""]


def test_refusal_and_context(values):
    assert values(tx.is_refusal, "Tôi rất tiếc, không", "vâng") == [True, False]
    assert values(tx.has_initials, "N.Q.A.", "N.Q.A", "N.Q", "N.") == [True, True, False, False]
    assert values(tx.needs_context, "Theo bài viết?", "What?", "ông N.Q.A. là ai") == [True, False, True]


def test_dates(values):
    day = values(tx.first_date, "Thứ sáu, ngày 25/04/2025 - 11:39", "5/4/2025", "31/02/2025", "x", "99/9/2025 1/1/2025")
    assert day == [dt.datetime(2025, 4, 25), dt.datetime(2025, 4, 5), None, None, None]
    assert values(tx.iso_time, "22/05/2024 10:00", "2024-05-22T10:00:00", "?") == [
        "2024-05-22T10:00:00",
        "2024-05-22T10:00:00",
        "?",
    ]


def test_think_and_tags(values):
    assert values(tx.think_text, "a<think> b\nc </think>d", "t", "<think></think>") == ["b\nc", "t", "<think></think>"]
    assert values(tx.translation_cleanup, "<msg>hi</msg>", "```text\nhello\n```") == ["hi", "\nhello\n"]


def test_numbers(values):
    assert values(tx.checkpoint_number, "a/checkpoint-120", "a/final") == [120, None]
    assert values(tx.version_number, "v12", "7", "x") == [12, 7, None]


PAGE = "http://x.com/a/b/c.htm?q=1#f"
HREFS = ["/p", "d.htm", "../d", "../../../d", "//y.com/z", "?k=1", "#g", "http://z.com/q", "./e/./f/..", "mailto:a@b", "", "g/"]


def test_resolve_url_like_urljoin(values):
    for page in (PAGE, "http://x.com", "http://x.com/"):
        got = values(lambda h: tx.resolve_url(h, F.lit(page)), *HREFS)
        assert got == [urljoin(page, h) for h in HREFS], page


def test_absolute_url(values):
    got = values(lambda h: tx.absolute_url(h, F.lit("https://en.site/")), "/a", "b", "http://c")
    assert got == ["https://en.site/a", "https://en.site/b", "http://c"]


def unwrap(text):
    """Character by character: a lone newline is a blank, unless a list or table
    sign follows."""
    padded = "x" + text + "x"
    out = [
        " " if c == "\n" and padded[i] != "\n" and padded[i + 2] not in "\n-*|" else c
        for i, c in enumerate(text)
    ]
    return "".join(out).replace("** _", "**_").replace("_ **", "_**")


def normalise(text):
    """Fences alternate; an odd one out at the end opens nothing."""
    pieces = text.split("```")
    fenced = {i for i in range(1, len(pieces) - 1, 2)}
    collapsed = lambda p: " ".join(w for i, w in enumerate(p.split(" ")) if w or i in (0, p.count(" ")))
    return "```".join(p if i in fenced else unwrap(collapsed(p) if p.strip(" ") else p[:1]) for i, p in enumerate(pieces))


def repaired(text):
    lines, out, i = text.split("\n"), [], 0
    while i < len(lines):
        pipes = lines[i].count("|")
        nxt = lines[i + 1] if i + 1 < len(lines) else ""
        if pipes and nxt.count("|") == pipes and not set(nxt) - set(" -:|"):
            while i < len(lines) and "|" in lines[i]:
                out.append("| " + lines[i] + "|\n")
                i += 1
            out.append("\n")
        else:
            out.append(lines[i] + "\n")
            i += 1
    return "".join(out)


@QUICK
@given(st.lists(st.text(alphabet="ab`\n *_-|", max_size=40), min_size=1, max_size=60))
def test_markdown_like_model(values, texts):
    texts = texts + [t.replace("a", "```") for t in texts]
    assert values(md.normalise_markdown, *texts) == [normalise(t) for t in texts]


@QUICK
@given(st.lists(st.text(alphabet="a|-: \n", max_size=40), min_size=1, max_size=60))
def test_tables_like_model(values, texts):
    assert values(md.repair_tables, *texts) == [repaired(t) for t in texts]


def test_markdown_examples(values):
    got = values(md.unwrap_newlines, "a\nb", "a\n\nb", "a\n- b", "x ** _y_ **")
    assert got == ["a b", "a\n\nb", "a\n- b", "x **_y_**"]
    table = values(md.repair_tables, "a | b\n---|---\n1 | 2")
    assert table == ["| a | b|\n| ---|---|\n| 1 | 2|\n\n"]
