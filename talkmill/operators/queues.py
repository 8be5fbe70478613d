"""Which rows are still to be worked on."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill import fixed


def text_or_null(column: Column) -> Column:
    """Stand-in words for missing values become NULL."""
    return F.when(~column.isin(fixed.MISSING_WORDS), column)


def boolean_or_null(column: Column) -> Column:
    """'True' and 'False' as booleans; everything else NULL."""
    return F.when(column == fixed.TRUE_WORD, True).when(column == fixed.FALSE_WORD, False)


def pending_both(rows: DataFrame) -> DataFrame:
    """No content yet AND not known to be a bad link (typed columns)."""
    return rows.filter(
        (F.col("content").isNull() | (F.col("content") == "")) & ~F.coalesce("is_err_link", F.lit(False))
    )


def pending_either(rows: DataFrame) -> DataFrame:
    """No content yet OR not known to be a bad link (text columns)."""
    content, bad = F.col("content"), F.col("is_err_link")
    return rows.filter(
        content.isNull() | content.isin("nan", "None") | bad.isNull() | bad.isin("False", "nan")
    )


def pending_content(rows: DataFrame) -> DataFrame:
    """No content yet, with text stand-ins."""
    return rows.filter(F.col("content").isNull() | F.col("content").isin("nan", ""))


def work_queue(
    rows: DataFrame,
    flag: str,
    min_words: int,
    start: datetime,
    limit: int | None = None,
    tie: str = "link",
) -> DataFrame:
    """Newest rows with content that are not generated yet: all, or the first
    ``limit``."""
    ready = rows.filter(
        (F.col(flag).isNull() | ~F.col(flag))
        & F.col("content").isNotNull()
        & (F.col("word_count") >= min_words)
        & (F.col("time") >= F.lit(start))
    )
    ordered = ready.orderBy(F.col("time").desc(), F.col(tie))
    return ordered if limit is None else ordered.limit(limit)


def capped(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows in a fixed order."""
    return rows.orderBy(*order).limit(limit)
