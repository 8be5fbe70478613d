from pyspark.sql import functions as F

from talkmill.functions import messages as ms
from talkmill.operators import conversations as cv
from talkmill.operators import packing


def conv(*pairs):
    return [{"role": r, "content": c} for r, c in pairs]


def plain(messages):
    return None if messages is None else [(m["role"], m["content"]) for m in messages]


def run(values, function, *conversations):
    return values(function, *[(c,) for c in conversations], ddl=f"m {ms.MESSAGES}")


U, A, S = "user", "assistant", "system"


def test_valid_part(values):
    cases = [
        conv((U, "a"), (A, "b"), (U, "c"), (A, "")),
        conv((U, "a"), (A, "")),
        conv((U, "a")),
        conv((U, "a"), (A, "b")),
        conv((U, "a"), (A, "b"), (U, "")),
    ]
    got = [plain(m) for m in run(values, ms.valid_part, *cases)]
    assert got == [[(U, "a"), (A, "b")], None, None, [(U, "a"), (A, "b")], [(U, "a"), (A, "b")]]
    strict = [plain(m) for m in run(values, lambda m: ms.valid_part(m, "drop"), *cases)]
    assert strict == [None, None, None, [(U, "a"), (A, "b")], None]


def test_flat_validity_agrees_with_nested(spark, values):
    cases = [
        conv((U, "a"), (A, "b"), (U, "c"), (A, "")),
        conv((U, "a"), (A, "")),
        conv((U, "a")),
        conv((U, "a"), (A, "b")),
        conv((U, "a"), (A, "b"), (U, ""), (A, "d")),
        conv((A, ""), (U, "x"), (A, "y")),
    ]
    rows = [(i, t, m["role"], m["content"]) for i, c in enumerate(cases) for t, m in enumerate(c)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for mode in ("truncate", "drop"):
        nested = [plain(m) for m in run(values, lambda m: ms.valid_part(m, mode), *cases)]
        kept = {}
        for r in cv.keep_valid(turns, mode).orderBy("conv_id", "turn").collect():
            kept.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert [kept.get(i) for i in range(len(cases))] == nested


def test_good_turns(values):
    cases = [
        conv((U, "q"), (A, "Tuyệt vời! abc. def"), (U, "r"), (A, "Tôi rất tiếc")),
        conv((U, "q"), (A, "Tôi rất tiếc")),
        conv((A, "hello")),
        conv((A, "hello"), (U, "x")),
        conv((U, "q"), (A, "one"), (A, "two")),
    ]
    got = [plain(m) for m in run(values, ms.good_turns, *cases)]
    assert got == [
        [(U, "q"), (A, "Abc. def")],
        [],
        [(A, "hello")],
        [],
        [(U, "q"), (A, "one"), (A, "one"), (A, "two")],
    ]


def test_flat_pairs_agree_with_nested(spark, values):
    cases = [
        conv((U, "q"), (A, "Tuyệt vời! abc. def"), (U, "r"), (A, "Tôi rất tiếc")),
        conv((A, "hello")),
        conv((A, "hello"), (U, "x")),
        conv((U, "q"), (A, "one"), (A, "two")),
    ]
    rows = [(i, t, m["role"], m["content"]) for i, c in enumerate(cases) for t, m in enumerate(c)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {}
    for r in cv.good_pairs(turns).orderBy("conv_id", "pair", "slot").collect():
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert [found.get(i, []) for i in range(len(cases))] == [plain(m) for m in run(values, ms.good_turns, *cases)]


def test_script_and_context(values):
    cases = [conv((U, "a"), (A, "你")), conv((U, "a")), conv((U, "<content>\n\nNone\n\n</content> q"))]
    assert run(values, ms.has_cjk, *cases) == [True, False, False]
    assert run(values, ms.has_null_context, *cases) == [False, False, True]
    assert run(values, ms.total_words, conv((U, "a b"), (A, "c"))) == [3]


def test_default_system(values):
    got = [plain(m) for m in run(values, ms.with_system, conv((U, "a")), conv((S, "s"), (U, "a")))]
    assert got == [[(S, "Bạn là trợ lý hữu ích. /no_think"), (U, "a")], [(S, "s"), (U, "a")]]


def test_parse_qa(values):
    good = "x ### Question: q1 ### Answer: a1 ### Question: q2 ### Answer:\n a2\n"
    none = "### Question: q ### Question: r ### Answer: a"
    two = "### Question: q ### Answer: a ### Answer: b"
    got = values(ms.parse_qa, good, none, two, "nothing")
    assert [None if g is None else [(p["question"], p["answer"]) for p in g] for g in got] == [
        [("q1", "a1"), ("q2", "a2")],
        None,
        None,
        [],
    ]


def test_parse_questions(values):
    text = "- before\n### Question:\n- one\n  - two \n-\nplain\n### Question:\n-three"
    assert values(ms.parse_questions, text, "none") == [["one", "two", "three"], []]


def test_qa_to_messages(values):
    pairs = [{"question": "Theo bài?", "answer": "x"}, {"question": "b", "answer": "y"}]
    rows = [(pairs, "TEXT"), (pairs, None), ([{"question": "b", "answer": "y"}], "TEXT")]
    got = values(
        lambda p, c: ms.qa_to_messages(p, c), *rows, ddl="p array<struct<question:string,answer:string>>, c string"
    )
    assert got[0][0]["content"].startswith("Bạn được cung cấp") and "TEXT" in got[0][0]["content"]
    assert got[0][0]["content"].endswith("Theo bài?") and len(got[0]) == 4
    assert plain(got[1])[0] == (U, "Theo bài?")
    assert plain(got[2]) == [(U, "b"), (A, "y")]


def test_reasoning(values):
    rows = [
        ("q", "a", "t", None, None, None),
        ("q", "a", "t", "vq", "va", None),
        ("q", "a", "t", "vq", "va", "vt"),
        ("你", "a", "t", "vq", "va", "vt"),
        ("q", "a", "t", "vq", "va", "你"),
        ("你", "a", "t", None, None, None),
    ]
    ddl = "q string, a string, t string, vq string, va string, vt string"
    got = values(lambda *c: ms.reasoning_sample(*c, key=c[0]), *rows, ddl=ddl)
    assert [g and g["pair"] for g in got] == ["en_en", "vi_en", "vi_vi", None, "vi_en", "en_en"]
    assert got[2]["messages"][2]["content"] == "<think>\nvt\n</think>\n\nva"
    assert got[1]["messages"][2]["content"].startswith("<think>\nThe translation of the user request is:\n\nq\n\nt\n")


def test_parts(values):
    ddl = "p array<struct<type:string,text:string,content:string,reasoning:string>>"
    text = {"type": "text", "text": "a", "content": None, "reasoning": None}
    bad = {"type": "reasoning", "text": None, "content": None, "reasoning": "undefined"}
    got = values(lambda p: ms.sanitise_parts(ms.dedupe_parts(p)), ([text, bad, text, bad],), ddl=ddl)
    assert [p["text"] for p in got[0]] == ["a"]


def test_nest_splits_long_conversations(spark):
    turns = spark.range(10).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit(U).alias("role"), F.col("id").cast("string").alias("text")
    )
    got = cv.nest(turns, rows_per_part=4).orderBy("part").collect()
    assert [[m["content"] for m in r["messages"]] for r in got] == [list("0123"), list("4567"), list("89")]


def test_training_messages(spark):
    rows = [
        (1, 0, U, "one two"), (1, 1, A, "three"),
        (2, 0, S, "be kind"), (2, 1, U, "x"), (2, 2, A, ""),
        (3, 0, S, "sys"), (3, 1, U, "x y z"), (3, 2, A, "w"), (3, 3, U, "v"), (3, 4, A, ""),
        (4, 0, U, "你"), (4, 1, A, "b"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = packing.training_messages(turns, max_words=100, max_rows=2).orderBy("chunk_id", "slot", "turn").collect()
    # Conversation 1 has 3 + 7 prompt words, 3 has 5; 2 keeps only its system message.
    assert [(r["chunk_id"], r["slot"], r["role"], r["text"]) for r in got] == [
        (0, -1, S, "Bạn là trợ lý hữu ích. /no_think"),
        (0, 0, U, "one two"),
        (0, 0, A, "three"),
        (0, 1, U, "x y z"),
        (0, 1, A, "w"),
    ]


def test_long_conversations_stay(spark):
    """What is too long to pack is kept as it is, every usable one once."""
    long_text = " ".join(["w"] * 1200)
    rows = [(1, 0, U, "one two"), (1, 1, A, "three"), (2, 0, U, long_text), (2, 1, A, "b"), (3, 0, S, "sys"), (3, 1, U, long_text), (3, 2, A, "c")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = packing.training_messages(turns).orderBy("kind", "chunk_id", "slot", "turn").collect()
    assert [(r["kind"], r["chunk_id"], r["turn"], r["role"], r["text"][:3]) for r in got if r["kind"] == "long"] == [
        ("long", 0, -1, S, "Bạn"),
        ("long", 0, 0, U, "w w"),
        ("long", 0, 1, A, "b"),
        ("long", 1, 0, S, "sys"),
        ("long", 1, 1, U, "w w"),
        ("long", 1, 2, A, "c"),
    ]
    assert [r["text"] for r in got if r["kind"] == "merged" and r["role"] == U] == ["one two"]


def test_templates(spark):
    samples = spark.createDataFrame([(1, "q", "a", "t"), (2, "r", "b", "u")], "id int, question string, answer string, think string")
    got = cv.for_template(samples, "qwen3").collect()
    assert {r["pair"] for r in got} == {"en_en"} and all(len(r["messages"]) == 3 for r in got)
    assert cv.for_template(samples, "r1").count() == 2
    assert cv.for_template(samples, "llama").columns == samples.columns
    chats = spark.createDataFrame([([("user", "x")],)], f"messages {ms.MESSAGES}")
    assert [m["role"] for m in cv.for_template(chats, "qwen3").first()["messages"]] == [S, U]
    assert [m["role"] for m in cv.for_template(chats, "r1").first()["messages"]] == [U]
