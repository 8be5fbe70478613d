"""How five quality filters interact, for every order of applying them.

A row's failures are one number of five bits.  Bits A and B come from row sums
and nonzero counts of the document-term matrix (``term_matrix``), C and D from
the text itself, E from the table's digests.  The rows of a part are counted
per number, at most 32 counts, and all 120 orders follow from those counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import stage, text_of
from talkmill.llm.term_matrix import row_sums, term_matrix
from talkmill.session import join_facts

FILTERS = "ABCDE"

LEAST_WORDS = 200
LEAST_DISTINCT = 50  # per cent of the words
MOST_CAPITALS = 2  # per cent of the code points
SYMBOLS = "[#$%&*|]"


def failures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id, part, failed``: for each row of ``docs`` the filters that it
    fails, A to E as bits 1, 2, 4, 8, 16.

    A: under 200 words; B: distinct words below half of the words; C: more
    than 2 % of the code points are A-Z; D: holds one of ``#$%&*|``; E: a
    smaller doc_id of the table has the same text.  A null text is the empty
    text (it fails A only, and E if repeated); a null part is the empty
    string.  Rows that repeat a doc_id are judged one by one and are no copies
    of each other; a row without doc_id neither fails E nor makes others fail.
    """
    whole = F.col("text")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), text_of(text).alias("text"))
    rows = rows.select(
        "doc_id", "part", "text", F.sha2(whole, 256).alias("digest"),
        F.when(F.regexp_count(whole, F.lit("[A-Z]")) * 100 > F.length(whole).cast("long") * MOST_CAPITALS, 4).otherwise(0).alias("capitals"),
        F.when(whole.rlike(SYMBOLS), 8).otherwise(0).alias("symbols"),
    )
    matrix, _ = term_matrix(rows)
    known = stage(row_sums(matrix), "flags")
    firsts = known.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    few = F.when(F.col("row_sum") < LEAST_WORDS, 1).otherwise(0)
    repeated = F.when(F.col("nonzero") * 100 < F.col("row_sum") * LEAST_DISTINCT, 2).otherwise(0)
    copy = F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    return join_facts(known, firsts, "digest", "left").select(
        "doc_id", "part", (few + repeated + F.col("capitals") + F.col("symbols") + copy).cast("int").alias("failed")
    )


def _cells(cells: Column, test, value: str) -> Column:
    """Sum of one count over the cells whose failures pass a test."""
    chosen = F.filter(cells, lambda c: test(c["failed"]))
    return F.aggregate(chosen, F.lit(0).cast("long"), lambda total, c: total + c[value])


def audit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", **named) -> DataFrame:
    """One row per part, order of the filters and step, zeros included:
    ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``.

    ``labels`` (doc_id, quality, toxic): a document counts as good or toxic
    when one of its label rows says 1; unlabelled and null ones do not.  An
    empty ``docs`` has no parts and gives no rows.
    """
    failed = failures(docs, doc_id=doc_id, **named)
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )
    counted = (
        join_facts(failed, said, "doc_id", "left")
        .groupBy("part", "failed")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    )
    # At most 32 cells per part.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = parts.select("part", "cells", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )
    before, own = F.lit(0), F.lit(0)
    for i, letter in enumerate(FILTERS):
        place = F.instr("filter_order", letter)
        before = before + F.when(place < F.col("step"), 1 << i).otherwise(0)
        own = own + F.when(place == F.col("step"), 1 << i).otherwise(0)
    steps = steps.withColumns({"before": before, "own": own})
    cells, earlier, this = F.col("cells"), F.col("before"), F.col("own")

    def removed(f: Column) -> Column:
        return (f.bitwiseAND(earlier) == 0) & (f.bitwiseAND(this) != 0)

    # Of all orders, a row with f failures falls to each of them equally often.
    share = F.lit(len(list(permutations(FILTERS))))
    fallen = F.filter(cells, lambda c: c["failed"].bitwiseAND(this) != 0)
    shapley = F.aggregate(fallen, F.lit(0).cast("long"), lambda total, c: total + c["n"] * (share / F.bit_count(c["failed"])).cast("long"))
    return steps.select(
        "part", "filter_order", "step",
        _cells(cells, lambda f: f.bitwiseAND(earlier + this) == 0, "n").alias("kept"),
        _cells(cells, removed, "n").alias("removed"),
        _cells(cells, lambda f: (f.bitwiseAND(earlier) != 0) & (f.bitwiseAND(this) != 0), "n").alias("redundant"),
        _cells(cells, lambda f: f == this, "n").alias("unique_fails"),
        _cells(cells, removed, "good").alias("good_lost"),
        _cells(cells, removed, "toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
