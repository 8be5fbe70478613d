"""Row numbers, lags and running sums in a total order, without gathering a
group (or the whole table) in one task.

Rows are range-partitioned on (keys, order), so a key that holds a third of
the table is spread over a third of the partitions.  In-partition results come
from plain expressions; what crosses a partition boundary is a carry table
with at most two rows per partition, so it stays small at any size.

``order`` must end in a unique column; otherwise ties have no fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.session import range_partitions, stage

PART, POS, KEY = "_part", "_pos", "_key"
ROW_BITS = 33  # monotonically_increasing_id keeps the row number in 33 bits


def range_layout(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Rows in ``order`` over range partitions, staged with their partition
    number ``_part`` and position ``_pos`` (from 0) as plain columns."""
    n = partitions or range_partitions(df.sparkSession)
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    placed = placed.select(
        *df.columns,
        F.shiftright("_row", ROW_BITS).cast("int").alias(PART),
        F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias(POS),
    )
    return stage(placed, "layout")


def global_row_number(
    df: DataFrame, order: list[Column], name: str = "rn", start: int = 1, partitions: int | None = None
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` plus ``start - 1``.

    One range shuffle; the offsets are one row per partition.
    """
    laid = range_layout(df, order, partitions)
    counts = laid.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so this un-partitioned window stays small.
    offsets = counts.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return laid.join(F.broadcast(offsets), PART).select(
        *df.columns, (F.col(POS) + F.col("_before") + F.lit(start)).alias(name)
    )


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    *,
    row_number: str | None = None,
    lags: dict[str, str] | None = None,
    running_sums: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Window results per ``keys`` in ``order``, safe for very large groups.

    ``row_number``: name of a 1-based row number.
    ``lags``: new name -> column, its value on the previous row of the key.
    ``running_sums``: new name -> column, its sum up to and including the row.
    """
    lags, sums = lags or {}, running_sums or {}
    # One struct as key: equal structs match also where a field is NULL.
    keyed = df.withColumn(KEY, F.struct(*keys))
    laid = range_layout(keyed, [F.col(k).asc() for k in keys] + order, partitions)

    # Keys that open a partition are the only ones that can have earlier rows
    # elsewhere: one row per partition.
    opening = laid.filter(F.col(POS) == 0).select(KEY).distinct()
    boundary = laid.join(F.broadcast(opening), KEY, "left_semi")
    last = F.struct(*[F.col(c) for c in lags.values()]) if lags else F.lit(None)
    per_part = boundary.groupBy(PART, KEY).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(last, POS).alias("_last"),
        *[F.sum(c).alias(f"_sum_{new}") for new, c in sums.items()],
    )
    earlier = Window.partitionBy(KEY).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # At most two rows per partition; not broadcast by force, as a lag may
    # carry long texts.  The join keys are the window's, so a merge join needs
    # no further shuffle or sort of the rows.
    carry = per_part.select(
        PART,
        KEY,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        F.last("_last").over(earlier).alias("_last_before"),
        *[F.coalesce(F.sum(f"_sum_{new}").over(earlier), F.lit(0)).alias(f"_before_{new}") for new in sums],
    )

    # (_part, key) groups are never larger than one range partition.
    local = Window.partitionBy(PART, KEY).orderBy(POS)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = laid.withColumns(
        {
            "_local": F.row_number().over(local),
            **{f"_lag_{new}": F.lag(c).over(local) for new, c in lags.items()},
            **{f"_run_{new}": F.sum(c).over(upto) for new, c in sums.items()},
        }
    )
    joined = inside.join(carry, [PART, KEY], "left")
    out = [F.col(c) for c in df.columns]
    if row_number:
        out.append((F.col("_local") + F.coalesce("_n_before", F.lit(0))).alias(row_number))
    for new, c in lags.items():
        out.append(
            F.when(F.col("_local") == 1, F.col(f"_last_before.{c}")).otherwise(F.col(f"_lag_{new}")).alias(new)
        )
    for new in sums:
        out.append((F.col(f"_run_{new}") + F.coalesce(f"_before_{new}", F.lit(0))).alias(new))
    return joined.select(*out)


def index_rows(df: DataFrame, existing_max: int | None, order: list[Column], name: str = "idx") -> DataFrame:
    """Contiguous index continuing after ``existing_max`` (NULL means -1)."""
    start = (-1 if existing_max is None else existing_max) + 1
    return global_row_number(df, order, name=name, start=start)


def next_index(df: DataFrame, column: str) -> DataFrame:
    """One row ``next_index``: max of the numeric values of ``column`` + 1, or 0."""
    top = F.coalesce(F.max(F.col(column).try_cast("bigint")), F.lit(-1))
    return df.agg((top + 1).alias("next_index"))
