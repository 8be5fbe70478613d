"""Mixing sources to target weights by a splitting tree of block quotas.

Columns and SQL functions only.  For each source the plan takes whole passes
over its documents and, of one more pass, documents in an order permuted by a
hash until the target is met; a document larger than what is missing is passed
over.  The documents of a pass fall into blocks by that same hash.  A binary tree then hands out the blocks: every node holds how many
blocks of each source it has, and splits them between its halves by a
multivariate hypergeometric draw, so each output shard gets its exact share of
blocks and the sources in it vary as in drawing without replacement.  A leaf's
quotas become ranges of block numbers; no two leaves share a block.  In a shard
rows are ordered by another hash.

A node's row has one counter for each source; the fold over them is meant for
up to some ten thousand sources.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.llm.common import WORD, stage, text_of, unused
from talkmill.operators.ordered import global_row_number
from talkmill.session import join_facts

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words, in the mix
MOST = 2  # times a source's words that its target may be
BLOCK_DOCS = 1024
SHARD_WORDS = 4_000_000


def _bits(*columns, seed: int, salt: int):
    return F.xxhash64(*columns, F.lit(seed), F.lit(salt))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sid, source, docs, source_size, target`` from ``source, size`` rows.

    Sources in code point order, null last, have the weights in turn.  Targets
    above ``most`` times the source's size stop there, and what they leave is
    shared by weight among the others until none is above.  Each round is one
    aggregate over the table of sources.
    """
    totals = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    ranked = global_row_number(totals, [F.col("source").isNull(), F.col("source")], "sid", 0)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    sources = stage(ranked.withColumn("weight", weight), "sources")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    each, capped = 0.0, -1
    full = F.col("source_size") * float(most)
    while True:
        over = F.col("weight") * each > full
        n, taken, left = sources.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, full)), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == capped or not left:
            break
        capped, each = n, (share * words - taken) / left
    target = F.least(full, F.col("weight") * each)
    return sources.select("sid", "source", "docs", "source_size", target.alias("target"))


def _draw(seed: int) -> str:
    """Blocks of source ``s`` that go left, one draw after the other."""
    u = f"pmod(xxhash64({seed}L, node, s, i), 9007199254740992L) / 9007199254740992D"
    return (
        f"IF(counts[s] = 0, 0L, aggregate(sequence(1L, counts[s]), 0L, "
        f"(k, i) -> k + IF({u} * (acc.n - i + 1) < acc.l - k, 1L, 0L)))"
    )


def splitting_tree(root: DataFrame, levels: int, seed: int) -> DataFrame:
    """``node, counts`` of the leaves below ``root`` (the same columns)."""
    tree = root
    for _ in range(levels):
        total = "aggregate(counts, 0L, (a, c) -> a + c)"
        lefts = (
            f"aggregate(sequence(0, size(counts) - 1), "
            f"named_struct('n', {total}, 'l', {total} div 2, 'out', cast(array() as array<bigint>)), "
            f"(acc, s) -> transform(array({_draw(seed)}), d -> named_struct('n', acc.n - counts[s], 'l', acc.l - d, 'out', concat(acc.out, array(d))))[0], "
            f"acc -> acc.out)"
        )
        halves = tree.select("node", "counts", F.expr(f"explode(array({lefts})) AS lefts"))
        tree = halves.selectExpr(
            "inline(array(named_struct('node', node * 2, 'counts', lefts), "
            "named_struct('node', node * 2 + 1, 'counts', zip_with(counts, lefts, (a, b) -> a - b))))"
        )
    return tree


def mixing_plan(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17,
    weights=WEIGHTS, share: float = SHARE, most: int = MOST, shard_words: int = SHARD_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """What each row of ``docs`` gives to the mix.

    First table: ``doc_id, again, sid, source, size, source_size, target,
    copies`` for every row of ``docs``.  Second: ``doc_id, again, pass, shard,
    place`` for every copy in the mix.  ``again`` numbers rows that share a
    doc_id (from 1).  A null text has size 0 and gives no words; null sources
    are one source, the last; null ids are ordinary ids.  No document gives
    more than ``most`` times its size.  The same rows give the same mix.  An
    empty table gives two empty ones.
    """
    key = [F.col("source"), F.col("size")]
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
    )
    rows = stage(rows.withColumn("again", F.row_number().over(Window.partitionBy("doc_id").orderBy(*key))), "sizes")
    targets = source_targets(rows, weights, share, most)
    # A struct as key matches a null source as well.
    facts = targets.select(F.struct("source").alias("_key"), "sid", "docs", "source_size", "target")
    placed = join_facts(rows.withColumn("_key", F.struct("source")), facts, "_key").drop("_key")
    placed = placed.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    placed = placed.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    placed = placed.withColumn("bin", F.pmod(_bits("doc_id", "again", seed=seed, salt=1), F.ceil(F.col("docs") / BLOCK_DOCS)))
    placed = stage(placed, "placed")

    # The documents of the permuted order until one does not fit, and again
    # those of the rest that are no larger than what is missing, until none is.
    # Words before a document: of the bins before its own, and of the documents
    # before it in its bin.
    before = Window.partitionBy("sid").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("sid", "bin").orderBy(_bits("doc_id", "again", seed=seed, salt=2), "doc_id", "again")
    columns = ["sid", "bin", "doc_id", "again", "size"]
    gaps = stage(placed.groupBy("sid").agg(F.first("rest").alias("gap")), "gaps")
    left, picked = placed.where("size > 0").select(*columns), None
    while True:
        smaller = left.join(gaps.where("gap > 0"), "sid").where("size <= gap")
        bins = stage(smaller.groupBy("sid", "bin").agg(F.sum("size").alias("words")), "bins")
        if bins.isEmpty():
            break
        bins = bins.select("sid", "bin", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
        running = join_facts(smaller, bins, ["sid", "bin"]).withColumn(
            "upto", F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        )
        running = stage(running.withColumn("fits", F.col("upto") <= F.col("gap")), "running")
        took = running.where("fits").groupBy("sid").agg(F.max("upto").alias("took"))
        gaps = stage(gaps.join(took, "sid", "left").select("sid", (F.col("gap") - F.coalesce("took", F.lit(0))).alias("gap")), "gaps")
        found, left = running.where("fits").select("doc_id", "again"), running.where("not fits").select(*columns)
        picked = found if picked is None else picked.unionByName(found)
    extra = placed.withColumn("_id", F.struct("doc_id", "again"))
    if picked is None:
        extra = extra.withColumn("extra", F.lit(0))
    else:
        used = picked.select(F.struct("doc_id", "again").alias("_id"), F.lit(1).alias("_used"))
        extra = extra.join(used, "_id", "left").withColumn("extra", F.coalesce("_used", F.lit(0))).drop("_used")
    extra = stage(extra, "extra")
    # All others are larger than the gap: the nearest one, if it brings its source nearer.
    near = extra.where("extra = 0 and size > 0").join(gaps.where("gap > 0"), "sid").withColumn("off", F.abs(F.col("size") - F.col("gap"))).where("off < gap")
    best = F.struct("off", _bits("doc_id", "again", seed=seed, salt=3).alias("h"), "doc_id", "again")
    last = near.groupBy("sid").agg(F.min(best).alias("f")).select(F.struct("f.doc_id", "f.again").alias("_id"), F.lit(1).alias("_last"))
    extra = join_facts(extra, last, "_id", "left").withColumn("extra", F.greatest("extra", F.coalesce("_last", F.lit(0)))).drop("_id", "_last")
    chosen = stage(extra.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0)), "chosen")

    copies = chosen.where("copies > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    numbered = Window.partitionBy("sid").orderBy("pass", "bin")
    blocks = stage(copies.groupBy("sid", "pass", "bin").agg(F.sum("size").alias("words")), "blocks")
    words, n_sources = blocks.agg(F.sum("words")).first()[0] or 0, targets.count()
    levels = max(0, math.ceil(math.log2(max(1, words / shard_words))))
    owned = blocks.groupBy("sid").agg(F.count("*").alias("n"))
    dense = targets.select("sid").join(owned, "sid", "left").select("sid", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    root = dense.agg(F.sort_array(F.collect_list(F.struct("sid", "n"))).alias("c")).select(
        F.lit(0).cast("long").alias("node"), F.col("c.n").alias("counts")
    )
    leaves = stage(splitting_tree(root, levels, seed), "leaves") if n_sources else root.limit(0)
    quotas = leaves.select(F.col("node").alias("shard"), F.posexplode("counts").alias("sid", "quota")).where("quota > 0")
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = quotas.withColumn("low", F.coalesce(F.sum("quota").over(earlier), F.lit(0)))
    owners = ranges.select("sid", "shard", F.explode(F.sequence(F.col("low"), F.col("low") + F.col("quota") - 1)).alias("block"))
    blocks = blocks.withColumn("block", F.row_number().over(numbered).cast("long") - 1)
    given = blocks.join(owners.withColumn("sid", F.col("sid").cast("long")), ["sid", "block"]).select("sid", "pass", "bin", "shard")
    drawn = join_facts(copies, given, ["sid", "pass", "bin"]).select(
        "doc_id", "again", "pass", "shard", _bits("doc_id", "again", "pass", seed=seed, salt=4).alias("place")
    )
    return chosen.select("doc_id", "again", "sid", "source", "size", "source_size", "target", "copies"), drawn


def mixed(docs: DataFrame, **named) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, by
    shard and shuffled within it."""
    doc_id, text, source = (named.get(k, k) for k in ("doc_id", "text", "source"))
    _, drawn = mixing_plan(docs, **named)
    drawn = stage(drawn, "drawn")
    own_id, again, shard, place, row = unused(docs.columns, "own_id", "again", "shard", "place", "row")
    taken = drawn.select(F.col("doc_id").alias(own_id), F.col("again").alias(again), F.col("shard").alias(shard), F.col("place").alias(place))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(own_id))
    if (drawn.agg(F.max("again")).first()[0] or 1) > 1:
        order = [F.col(f"`{source}`").cast("string"), F.regexp_count(text_of(text), F.lit(WORD))]
        docs = docs.withColumn(row, F.row_number().over(Window.partitionBy(F.col(f"`{doc_id}`").cast("long")).orderBy(*order)))
        same = same & (F.col(row) == F.col(again))
    shards = drawn.agg(F.max("shard")).first()[0] or 0
    found = docs.join(taken, same)
    return found.repartition(int(shards) + 1, shard).sortWithinPartitions(shard, place).select(*columns)
