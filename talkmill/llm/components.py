"""Connected components of links between ids, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import join_known, packed, stage


def _to_least(edges: DataFrame, larger_only: bool, rows: int) -> DataFrame:
    """Every neighbour of a node is linked with the least of the node and its
    neighbours.  The least is an aggregate with map-side combine; it comes
    back by a join that splits hot nodes.  An edge may come out repeatedly."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = join_known(edges, packed(least, rows), "a")
    if larger_only:
        found = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return found.where("a <> b")


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``(id, root)`` for every id that is in a link, ``root`` the smallest id
    of its component, itself included.

    Rounds of two steps (to the least neighbour among larger ones, then among
    smaller ones) until nothing changes; their number grows with the logarithm
    of the longest path.  Each round is a table in the shared folder; the
    driver sees a count and a checksum only.  Links with a null or to the
    same id say nothing; no link gives no row.
    """
    edges = stage(
        links.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
        .where(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col("a") > F.col("b")))
        .distinct(),
        "links",
    )
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == before or not seen[0]:
            break
        before, rows = tuple(seen), 2 * seen[0]
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stage(_to_least(both, True, rows), "links")
        edges = stage(packed(_to_least(large, False, rows).distinct(), 2 * rows), "links")
    # Every edge now goes from an id to its root.
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )
