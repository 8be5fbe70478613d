import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from talkmill.operators import ordered, packing


def loop(lengths, max_words, max_rows):
    """Longest first, each chunk as long as it fits (one row at least)."""
    rest, chunks = sorted(lengths, reverse=True), []
    while rest:
        sizes = [k for k in range(1, min(max_rows, len(rest)) + 1) if sum(rest[:k]) <= max_words]
        size = max(sizes, default=1)
        chunks.append(rest[:size])
        rest = rest[size:]
    return chunks


def closed_form(lengths, max_words, max_rows):
    histogram = {}
    for n in lengths:
        histogram[n] = histogram.get(n, 0) + 1
    segments = packing.packing_segments(list(histogram.items()), max_words, max_rows)
    chunks = {}
    for position, n in enumerate(sorted(lengths, reverse=True)):
        s = max(x for x in segments if position >= x.start)
        chunks.setdefault(s.first_chunk + (position - s.start) // s.size, []).append(n)
    return [chunks[c] for c in sorted(chunks)]


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60), st.integers(1, 60), st.integers(1, 6))
def test_segments_equal_the_loop(lengths, max_words, max_rows):
    assert closed_form(lengths, max_words, max_rows) == loop(lengths, max_words, max_rows)


@pytest.mark.parametrize(
    "lengths, max_words, max_rows, chunks",
    [
        ([5, 4, 3, 2, 1], 6, 2, [[5], [4], [3, 2], [1]]),
        ([3, 3, 3], 6, 2, [[3, 3], [3]]),
        ([9, 1, 1, 1], 6, 3, [[9], [1, 1, 1]]),
        ([], 6, 2, []),
    ],
)
def test_examples(lengths, max_words, max_rows, chunks):
    assert closed_form(lengths, max_words, max_rows) == chunks


@pytest.mark.parametrize("max_words, max_rows", [(1000, 2), (600, 4), (3000, 7)])
def test_pack_equals_the_loop(spark, max_words, max_rows):
    # One length holds a third of the rows.
    rows = spark.range(3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, 300).otherwise(F.pmod(F.xxhash64("id"), F.lit(1500))).alias("word_count"),
    )
    short = [r for r in rows.collect() if r["word_count"] < max_words]
    got = {}
    for r in packing.pack(rows, "k", max_words, max_rows).orderBy("pos").collect():
        got.setdefault(r["chunk_id"], []).append((r["word_count"], r["k"], r["slot"]))
    assert [[w for w, _, _ in got[c]] for c in sorted(got)] == loop([r["word_count"] for r in short], max_words, max_rows)
    assert all([s for _, _, s in c] == list(range(len(c))) for c in got.values())
    in_order = [(w, k) for c in sorted(got) for w, k, _ in got[c]]
    assert in_order == sorted(in_order, key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("n, kept, whole", [(15, 0, 0), (16, 0, 1), (17, 1, 1), (32, 1, 2), (33, 2, 2)])
def test_groups_drop_the_tail(spark, n, kept, whole):
    rows = spark.range(n).withColumnRenamed("id", "i")
    assert packing.groups(rows, "i", n, drop_tail="reference").select("group_id").distinct().count() == kept
    assert packing.groups(rows, "i", n, drop_tail="partial").select("group_id").distinct().count() == whole


def test_group_shuffle_keeps_groups_together(spark):
    rows = spark.range(96).select(
        F.lit("short").alias("kind"), F.floor(F.col("id") / 16).alias("group_id"), F.col("id").alias("item")
    )
    got = [(r["group_id"], r["item"]) for r in packing.shuffle_groups(rows, seed=3).collect()]
    groups = [got[i : i + 16] for i in range(0, 96, 16)]
    assert all(len({g for g, _ in part}) == 1 and [i for _, i in part] == sorted(i for _, i in part) for part in groups)
    assert [g[0][0] for g in groups] != [g[0][0] for g in [got2 for got2 in sorted(groups)]]


def hot(spark):
    """A third of the rows has one key, and ties in the order column."""
    return spark.range(5000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 97).alias("k"),
        F.floor(F.pmod(F.xxhash64("id"), F.lit(40))).alias("o"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 2).alias("v"),
    )


def test_ordered_scan_equals_windows(spark):
    rows = hot(spark)
    order = [F.col("o").desc(), F.col("id").asc()]
    w = Window.partitionBy("k").orderBy(*order)
    expected = rows.select(
        "id",
        F.row_number().over(w).alias("rn"),
        F.lag("v").over(w).alias("prev"),
        F.sum(F.coalesce("v", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
    )
    got = ordered.ordered_scan(
        rows.withColumn("v0", F.coalesce("v", F.lit(0))),
        ["k"],
        order,
        row_number="rn",
        lags={"prev": "v"},
        running_sums={"run": "v0"},
        partitions=13,
    ).select("id", "rn", "prev", "run")
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_hot_key_is_spread(spark):
    laid = ordered.range_layout(hot(spark).filter("k = -1"), [F.col("k"), F.col("o"), F.col("id")], 8)
    sizes = [r["count"] for r in laid.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_global_row_number(spark):
    rows = hot(spark)
    order = [F.col("o"), F.col("id")]
    got = ordered.global_row_number(rows, order, partitions=7).select("id", "rn")
    expected = rows.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn"))
    assert got.exceptAll(expected).count() == 0 and got.count() == 5000


def test_index_continues(spark):
    rows = spark.createDataFrame([("b",), ("a",)], "x string")
    assert {r["x"]: r["idx"] for r in ordered.index_rows(rows, None, [F.col("x")]).collect()} == {"a": 0, "b": 1}
    assert {r["x"]: r["idx"] for r in ordered.index_rows(rows, 41, [F.col("x")]).collect()} == {"a": 42, "b": 43}
    text = spark.createDataFrame([("3",), ("12",), ("nan",), (None,)], "i string")
    assert ordered.next_index(text, "i").first()[0] == 13
    assert ordered.next_index(text.filter("false"), "i").first()[0] == 0


def test_export_is_cut_at_whole_chunks(spark):
    rows = spark.range(23)
    got = packing.export_chunks(rows, [F.col("id")], size=5, limit=12).groupBy("chunk").count().orderBy("chunk").collect()
    assert [tuple(r) for r in got] == [(0, 5), (1, 5), (2, 5)]
    whole = packing.export_chunks(rows, [F.col("id")], size=5, limit=100).groupBy("chunk").count().orderBy("chunk").collect()
    assert [r["count"] for r in whole] == [5, 5, 5, 5, 3]
