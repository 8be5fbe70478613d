"""Keyed dedup, resume, upsert and marking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.session import join_facts, stage


def last_wins(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """One row per key: the last one by ``order``, with ``position`` = the
    first ``order`` of the key.  ``order`` is unique.

    Copies collapse map-side on a digest of the key, so a key that holds a
    third of the rows sends one row per task; payload is joined back on the
    unique ``order``.
    """
    ends = rows.groupBy(F.sha2(key.cast("string"), 256).alias("_key")).agg(
        F.max(order).alias(order), F.min(order).alias("position")
    )
    return rows.join(ends.select(order, "position"), order)


def first_wins(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """One row per key: the first one by the unique ``order``."""
    starts = rows.groupBy(F.sha2(key.cast("string"), 256).alias("_key")).agg(F.min(order).alias(order))
    return rows.join(starts.select(order), order, "left_semi")


def insert_new(target: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """Rows to insert: the first per key, and only keys ``target`` lacks."""
    return join_facts(first_wins(rows, F.col(key), order), target.select(key).distinct(), key, "left_anti")


def not_done(rows: DataFrame, done: list[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in none of the earlier outputs."""
    if not done:
        return rows
    keys = done[0].select(key)
    for frame in done[1:]:
        keys = keys.union(frame.select(key))
    return join_facts(rows, keys.filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def split_known(rows: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows against the keys of ``known``."""
    keys = stage(known.select(key).distinct(), "known")
    return rows.join(keys, key, "left_semi"), rows.join(keys, key, "left_anti")


def upsert_content(links: DataFrame, contents: DataFrame, key: str = "link") -> DataFrame:
    """Links with contents merged in: stored content longer than one character
    stays; otherwise the new ``content, time, word_count`` are set; unknown
    links are added.  Both sides have unique keys.

    ``action`` says what happened to the row: kept, updated, inserted, none.
    """
    old, new = links.alias("o"), contents.alias("n")
    has_old = F.length("o.content") > 1
    known, given = F.col("o._here").isNotNull(), F.col("n._here").isNotNull()
    merged = (
        old.withColumn("_here", F.lit(1)).alias("o")
        .join(new.withColumn("_here", F.lit(1)).alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    )
    take_new = given & ~F.coalesce(has_old, F.lit(False))
    set_columns = ["content", "time", "word_count"]
    kept = [c for c in links.columns if c not in (key, *set_columns)]
    return merged.select(
        F.coalesce(f"o.{key}", f"n.{key}").alias(key),
        *[F.col(f"o.{c}") for c in kept],
        *[F.when(take_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in set_columns],
        F.when(~known, "inserted")
        .when(take_new, "updated")
        .when(given, "kept")
        .otherwise("none")
        .alias("action"),
    )


def enrich(qa: DataFrame, source: DataFrame, key: str = "link") -> DataFrame:
    """Generated pairs with the content of their source; NULL without one."""
    return qa.join(source.select(key, "content"), key, "left")


def mark_processed(rows: DataFrame, outcomes: DataFrame, key: str = "link") -> DataFrame:
    """``message_generated`` and ``status`` set from ``outcomes`` (key,
    succeeded): a success is (True, True), an empty result or a failure
    (True, False); other rows keep their values."""
    seen = outcomes.groupBy(key).agg(F.max("succeeded").alias("_ok"))
    hit = F.col("_ok").isNotNull()
    return join_facts(rows, seen, key, "left").withColumns(
        {
            "message_generated": F.when(hit, F.lit(True)).otherwise(F.col("message_generated")),
            "status": F.when(hit, F.col("_ok")).otherwise(F.col("status")),
        }
    ).drop("_ok")


def delete_host(rows: DataFrame, pattern: str, column: str = "link") -> DataFrame:
    """Rows whose link does not match the pattern."""
    return rows.filter(~F.col(column).rlike(pattern))
