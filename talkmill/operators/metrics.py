"""Metric rows: trainer logs and gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions.text import bind
from talkmill.sources.readers import closes_early


def log_metrics(lines: DataFrame, line: str = "value", step: str = "current_steps", keep: tuple[str, ...] = ()) -> DataFrame:
    """``step, key, metric`` for the numeric fields of JSON log lines.

    Booleans count as 1 and 0; quoted numbers are text and do not count; the
    field ``step`` is left out and the step is read from ``current_steps``.
    """
    # Read inside brackets, so that text behind the object makes the line bad.
    boxed = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")), "array<map<string,variant>>", {"allowSingleQuotes": "false"}
    )
    parsed = lines.select(*keep, F.when(~closes_early(F.col(line)), boxed).alias("_a"))
    # No filter on the parsed value: it would be pushed down and parse again.
    single = F.when(F.size("_a") == 1, F.get("_a", F.lit(0)))

    def entries(m: Column) -> Column:
        at = F.try_variant_get(F.try_element_at(m, F.lit(step)), "$", "bigint")
        shown = F.transform(
            F.map_entries(m),
            lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("shown"), at.alias("step")),
        )
        return F.filter(shown, lambda e: (e["key"] != "step") & e["shown"].rlike("^[-0-9tf]"))

    fields = parsed.select(*keep, F.explode(bind(single, entries)).alias("e"))
    shown = F.col("e.shown")
    number = (
        F.when(shown == "true", F.lit(1.0)).when(shown == "false", F.lit(0.0)).otherwise(shown.try_cast("double"))
    )
    return fields.select(*keep, "e.step", F.col("e.key").alias("key"), number.alias("metric"))


def config_params(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, param`` of the plain (not nested) fields of a run configuration.
    The type of a value decides, not how its text begins."""
    parsed = lines.select(*keep, F.from_json(line, "map<string,variant>").alias("_m"))
    rows = parsed.select(*keep, F.explode("_m").alias("key", "_v"))
    plain = rows.filter(~F.schema_of_variant("_v").rlike("^(ARRAY|OBJECT|VOID)"))
    return plain.select(*keep, "key", F.col("_v").cast("string").alias("param"))


def select_gauge(
    gauges: DataFrame, metric: str, instance: str = ".*", gpu: str = ".*", scale: float = 1.0
) -> DataFrame:
    """Series of one metric whose labels match the patterns as a whole."""
    whole = lambda p: f"^(?:{p})$"
    return gauges.filter(
        (F.col("metric") == metric)
        & F.col("instance").rlike(whole(instance))
        & F.col("gpu").rlike(whole(gpu))
    ).withColumn("value", F.col("value") * scale)


def across_series(gauges: DataFrame, at: Column) -> DataFrame:
    """Average and sum over all series per point in time."""
    return gauges.groupBy(at.alias("ts")).agg(
        F.avg("value").alias("avg_value"), F.sum("value").alias("sum_value")
    )


def over_time(points: DataFrame, column: str) -> DataFrame:
    return points.agg(F.avg(column).alias("mean_value"))


def label_values(gauges: DataFrame, label: str) -> DataFrame:
    return gauges.select(label).distinct()
