"""Counts, sizes, column profiles and typed clean-up."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.operators.queues import boolean_or_null, text_or_null
from talkmill.session import ship_package, stage


def row_count(rows: DataFrame, *where: Column) -> DataFrame:
    for test in where:
        rows = rows.filter(test)
    return rows.agg(F.count(F.lit(1)).alias("n"))


def corpus_size(scanned: DataFrame) -> DataFrame:
    """Files and megabytes behind a file scan."""
    files = scanned.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")
    ).withColumn("megabytes", F.col("bytes") / (1024 * 1024))


def by_kind(rows: DataFrame, kind: Column) -> DataFrame:
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def counted(rows: DataFrame, **tests: Column) -> tuple[DataFrame, Observation]:
    """``rows`` with run counters that fill while an action runs over them."""
    seen = Observation()
    return rows.observe(seen, *[F.count_if(t).alias(name) for name, t in tests.items()]), seen


def counted_table(rows: DataFrame, label: str, **tests: Column) -> tuple[DataFrame, dict[str, int]]:
    """``rows`` written to the shared folder, and the run's counters: how many
    rows met each test.  The counters come out of the run that writes."""
    watched, seen = counted(rows, **tests)
    written = stage(watched, label)
    return written, {name: seen.get[name] for name in tests}


#: Distinct values that the counts of the most frequent ones keep track of.
TRACKED = 10_000


def sketch_profile(rows: DataFrame, top: int = 3) -> DataFrame:
    """One row per column that is not null throughout: ``column_name, types,
    n_values, smallest, largest, n_distinct, top``, nulls ignored.

    Everything is one aggregate over one scan, and every part of it merges:
    JSON types seen (about ten), the smallest and the largest value as text,
    an estimate of the distinct values (HLL), and the most frequent values
    with their counts (a sketch of bounded size; exact up to ``TRACKED``
    distinct values, else counts may be too high).
    """
    facts = []
    for name in rows.columns:
        text = F.col(f"`{name}`").cast("string")
        parsed = F.regexp_extract(F.schema_of_variant(F.try_parse_json(text)), "^[A-Z]+", 0)
        kind = F.when(text.isNotNull(), F.coalesce(parsed, F.lit("TEXT")))
        quoted = name.replace("`", "``")
        often = F.expr(f"approx_top_k(CAST(`{quoted}` AS STRING), {int(top)}, {TRACKED})")
        facts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.array_sort(F.collect_set(kind)).alias("types"),
                F.count(text).alias("n_values"),
                F.min(text).alias("smallest"),
                F.max(text).alias("largest"),
                F.hll_sketch_estimate(F.hll_sketch_agg(text)).alias("n_distinct"),
                often.alias("top"),
            )
        )
    return rows.agg(F.array(*facts).alias("f")).select(F.inline("f")).filter("n_values > 0")


def column_profile(rows: DataFrame, samples: int = 2) -> DataFrame:
    """``column_name, types, samples``: JSON types seen in each column and its
    first distinct values, ignoring NULL (``sketch_profile`` needs one pass).

    Plain aggregates: one pass per sample, each giving the next larger value
    of every column, and no shuffle of values.  There are about ten types.
    """
    names = rows.columns
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in names])

    def kind(c: str) -> Column:
        parsed = F.regexp_extract(F.schema_of_variant(F.try_parse_json(c)), "^[A-Z]+", 0)
        return F.when(F.col(c).isNotNull(), F.coalesce(parsed, F.lit("TEXT")))

    kinds = texts.agg(*[F.array_sort(F.collect_set(kind(c))).alias(c) for c in names]).first()
    found: dict[str, list[str]] = {c: [] for c in names}
    for _ in range(samples):
        larger = [
            F.min(F.when(F.col(c) > found[c][-1], F.col(c)) if found[c] else F.col(c)).alias(c)
            for c in names
        ]
        for c, value in texts.agg(*larger).first().asDict().items():
            if value is not None:
                found[c].append(value)
    profile = [(c, kinds[c], found[c]) for c in names if kinds[c]]
    return rows.sparkSession.createDataFrame(
        profile, "column_name string, types array<string>, samples array<string>"
    )


def typed(rows: DataFrame, float_to_int: bool = False) -> DataFrame:
    """Columns brought to the warehouse's types: whole numbers as bigint, nested
    values as JSON text, everything unknown as text.

    ``float_to_int=True`` also turns floats into whole numbers, as the old load
    did.
    """

    def rule(field: T.StructField) -> Column:
        c = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return c.cast("bigint").alias(field.name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return (c.try_cast("bigint") if float_to_int else c.cast("double")).alias(field.name)
        if isinstance(kind, (T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType)):
            return c
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(c).alias(field.name)
        return c.cast("string").alias(field.name)

    return rows.select(*[rule(f) for f in rows.schema.fields])


def from_words(rows: DataFrame, texts: list[str], flags: list[str]) -> DataFrame:
    """Text stand-ins for missing and boolean values as typed values."""
    return rows.withColumns(
        {**{c: text_or_null(F.col(c)) for c in texts}, **{c: boolean_or_null(F.col(c)) for c in flags}}
    )


#: Words, and single marks that are neither letters, digits nor blanks.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1C-\x1F\x85]"


def token_count(text: Column, tokenizer=None) -> Column:
    """Tokens of a text, null counting as empty: words and single marks, or by
    a tokenizer with ``encode``.  ``tokenizer`` is a function that makes one,
    called once per Python worker."""
    if tokenizer is None:
        return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = tokenizer()
        for batch in batches:
            yield batch.map(lambda t: 0 if t is None else len(encoder.encode(t)))

    ship_package(SparkSession.active())
    return count(text)
