"""A key with a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from talkmill.operators import conversations as cv
from talkmill.operators import packing
from talkmill.session import join_facts


@pytest.fixture()
def small_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_split(spark, small_limits, how):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    ).repartition(8)
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k % 2 = 0")
    joined = join_facts(rows, facts, "k", how)
    joined.collect()
    assert "skew=true" in final_plan(joined)


def truth(turns):
    """Kept turns of one conversation, or None."""
    if any(t["text"] and "你" in t["text"] for t in turns):
        return None
    kept = []
    for t in turns:
        if t["text"] == "":
            if t["role"] == "assistant":
                kept = kept[:-1]
            break
        kept.append(t)
    return kept if len(kept) > 1 else None


def random_turns(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        size = 200 if conv == 7 else rng.randint(1, 9)
        for turn in range(size):
            role = rng.choice(["user", "assistant", "system"]) if turn == 0 else rng.choice(["user", "assistant"])
            text = rng.choice(["a", "b c", "d e f", "", "你"]) if rng.random() < 0.12 else "x y"
            if conv == 7 and turn < 150:
                text = "x y"
            rows.append((conv, turn * 2, role, text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_blocks_do_not_change_results(spark, monkeypatch, seed):
    monkeypatch.setattr(cv, "TURNS_PER_BLOCK", 4)
    rows = random_turns(seed)
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append({"turn": turn, "role": role, "text": text})
    expected = {}
    for conv, ts in by_conv.items():
        kept = truth(ts)
        if kept:
            extra = 0 if kept[0]["role"] == "system" else 7
            expected[conv] = (len(kept), sum(len(t["text"].split()) for t in kept) + extra)
    got = packing.usable(cv.measure(turns)).collect()
    assert {r["conv_id"]: (r["n_messages"], r["word_count"]) for r in got} == expected
    flat = {}
    for r in cv.keep_valid(cv.drop_wrong_script(turns)).orderBy("conv_id", "turn").collect():
        flat.setdefault(r["conv_id"], []).append(r["turn"])
    assert flat == {c: [t["turn"] for t in truth(ts)] for c, ts in by_conv.items() if truth(ts)}
    stops = {r["conv_id"]: r["stop"] for r in got}
    for conv in expected:
        kept = [t["turn"] for t in truth(by_conv[conv])]
        assert [t["turn"] for t in by_conv[conv] if stops[conv] is None or t["turn"] < stops[conv]] == kept


def test_flat_operators_agree_with_facts(spark):
    turns = spark.createDataFrame(random_turns(5), "conv_id bigint, turn bigint, role string, text string")
    clean = cv.word_counts(cv.add_system(cv.keep_valid(cv.drop_wrong_script(turns))))
    facts = packing.usable(cv.measure(turns)).select(
        "conv_id", (F.col("n_messages") + (~F.col("has_system")).cast("int")).alias("n_messages"), "word_count"
    )
    assert clean.exceptAll(facts).count() == 0 and clean.count() == facts.count() > 0
