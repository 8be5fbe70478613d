"""Nothing is lost to a size: long conversations, sparse turns, long lines."""

from pyspark.sql import functions as F

from talkmill.operators import conversations as cv
from talkmill.operators import packing, profiling
from talkmill.sources import readers

TURN = "conv_id long, turn long, role string, text string"


def test_training_set_keeps_every_conversation(spark):
    said = [
        (conv, turn, role, " ".join(["w"] * words))
        for conv, words in ((1, 600), (2, 2), (3, 2))
        for turn, role in enumerate(("user", "assistant"))
    ]
    rows = packing.training_set(spark.createDataFrame(said, TURN), prompt=None).collect()
    # The merged chunk opens with the first text of its first conversation.
    got = sorted((r["kind"], r["chunk_id"], len(r["messages"]), r["word_count"]) for r in rows)
    assert got == [("long", 0, 2, 1200), ("merged", 0, 5, 10)]
    assert sorted(r["place"] for r in rows) == [0, 1]


def test_training_set_of_nothing(spark):
    assert packing.training_set(spark.createDataFrame([], TURN)).collect() == []


def test_parts_count_from_the_first_turn(spark):
    said = [(1, 4096, "user", "a"), (1, 4097, "assistant", "b"), (2, 0, "user", "c"), (2, 5000, "assistant", "d")]
    nested = cv.nest(spark.createDataFrame(said, TURN))
    assert sorted((r["conv_id"], r["part"], len(r["messages"])) for r in nested.collect()) == [(1, 0, 2), (2, 0, 1), (2, 1, 1)]
    ready = cv.for_template(nested, "qwen3").collect()
    prompts = {(r["conv_id"], r["part"]): r["messages"][0]["role"] for r in ready}
    assert prompts == {(1, 0): "system", (2, 0): "system", (2, 1): "assistant"}


def test_single_quotes_at_any_length(spark):
    line = F.concat(F.lit("{'a': '"), F.repeat(F.lit("x"), 17_000_000), F.lit("'}"))
    good = F.concat(F.lit('{"a": "'), F.repeat(F.lit("'"), 17_000_000), F.lit('"}'))
    row = spark.range(1).select(readers.is_json(line).alias("bad"), readers.is_json(good).alias("good")).first()
    assert (row["bad"], row["good"]) == (False, True)


def test_tokens_of_any_script(spark):
    texts = ["", None, "a_b, c!", "một hai ba …", "数字 12\u0085x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(profiling.token_count(F.col("t")).alias("n"))
    assert [r["n"] for r in rows.collect()] == [0, 0, 4, 4, 3]
