"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.session import shared_path, ship_package, stage

__all__ = ["SPACE", "WORD", "fitting_broadcast", "free_shuffles", "give_back", "shared_path", "ship_package", "stage", "join_known", "packed", "small_batches", "text_of", "pick", "unused"]

#: The blanks that separate words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a table of ids that a broadcast may have (16 MB of longs).
BROADCAST_IDS = 2_000_000


def text_of(name: str) -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under an operator's own names, so that other
    columns of the input can have any name."""
    return df.select(*(F.col(f"`{given}`").alias(own) for own, given in columns.items()))


def unused(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash
    with none of ``taken`` (column names do not differ by case)."""
    lower = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in lower:
            name = "_" + name
        out.append(name)
    return out


def fitting_broadcast(small: DataFrame, rows: int) -> DataFrame:
    """``small`` with the broadcast hint while its counted rows stay below the
    bound, else as it is, for a shuffled join."""
    return F.broadcast(small) if rows <= BROADCAST_IDS else small


#: Rows of a few longs that a broadcast may have (some 20 MB).
BROADCAST_FACTS = 500_000


def join_known(rows: DataFrame, facts: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to at most one row of ``facts`` (a few longs) per key.

    The facts are staged and counted: below the bound every task gets them,
    above it both sides are shuffled, as plain shuffles, so that hot keys can
    be split.
    """
    known = stage(facts, "facts")
    return rows.join(F.broadcast(known) if known.count() <= BROADCAST_FACTS else known, key, how)


def packed(df: DataFrame, rows: int, each: int = 1_000_000) -> DataFrame:
    """``df``, known to have at most ``rows`` rows, in no more partitions than
    these need: few rows give few files and tasks, whatever the cluster's
    shuffle partitions are."""
    return df.coalesce(max(1, min(run_of(df.sparkSession), -(-rows // each))))


def arrow_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one
    more entry for the end).  Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def give_back() -> None:
    """Return freed memory to the system.  Python workers live on between
    stages, and what they hold is missing to the others on their machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: it keeps its own account


def free_shuffles(spark: SparkSession) -> None:
    """Let the files of finished shuffles go.  Spark deletes them once the
    driver collects the frames that made them, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows of texts that go to a Python worker at once.
BATCH_ROWS = 1024
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs send at most ``BATCH_ROWS`` rows to a worker at once.

    An executor holds each batch of texts several times: in Arrow's buffers,
    which double, in the buffer of the pipe, and in the worker.  Tasks see the
    same rows; the session's own setting holds again afterwards.  Jobs that
    run later, from a lazy result, follow that one.
    """
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def by_bytes(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows of at most ``most`` bytes; a longer row is
    a range of its own."""
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def run_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
