"""Metric rows, gauges and run settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmill.operators import metrics as mt
from talkmill.plans.registry import query


def log_lines(t):
    """Trainer log lines made of events: numbers, a flag, text; some broken."""
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("current_steps"),
            F.col("value").alias("loss"),
            F.col("user_id").alias("step"),
            F.col("event_type").alias("phase"),
            (F.col("value") > 10).alias("high"),
            F.lit("7").alias("quoted"),
        )
    )
    broken = F.concat(line, F.lit("}}"))
    return t("events").select("event_id", F.when(F.col("event_id") % 50 == 7, broken).otherwise(line).alias("value"))


SQL_METRICS = """SELECT event_id AS step, 'current_steps' AS key, CAST(event_id AS DOUBLE) AS metric FROM events WHERE event_id % 50 <> 7
    UNION ALL SELECT event_id, 'loss', value FROM events WHERE event_id % 50 <> 7
    UNION ALL SELECT event_id, 'high', CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END FROM events WHERE event_id % 50 <> 7"""


@query("metric_unpivot", SQL_METRICS)
def metric_unpivot(t):
    return mt.log_metrics(log_lines(t))


@query(
    "config_params",
    """SELECT event_id, 'event_type' AS key, event_type AS param FROM events
       UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events
       UNION ALL SELECT event_id, 'note', '[draft] ' || event_type FROM events""",
)
def config_params(t):
    line = F.to_json(F.struct("event_type", "user_id", F.concat(F.lit("[draft] "), "event_type").alias("note"), F.array("user_id").alias("layers"), F.struct("value").alias("nested")))
    return mt.config_params(t("events").select("event_id", line.alias("value")), keep=("event_id",))


def gauges(t):
    """Events as gauges: the type is the metric, the user the GPU."""
    return t("events").select(
        "ts",
        F.col("event_type").alias("metric"),
        F.concat(F.lit("node"), F.col("user_id") % 4).alias("instance"),
        F.col("user_id").cast("string").alias("gpu"),
        "value",
    )


@query(
    "gauge_avg_sum",
    """SELECT date_trunc('hour', ts) AS ts, round(avg(value), 6) AS avg_value, round(sum(value), 6) AS sum_value
       FROM events WHERE event_type = 'view' GROUP BY 1""",
)
def gauge_avg_sum(t):
    points = mt.across_series(mt.select_gauge(gauges(t), "view"), F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz"))
    return points.select("ts", F.round("avg_value", 6).alias("avg_value"), F.round("sum_value", 6).alias("sum_value"))


@query(
    "gauge_mean",
    """SELECT round(avg(s), 4) AS mean_value FROM (SELECT sum(value) AS s FROM events WHERE event_type = 'view' GROUP BY date_trunc('hour', ts))""",
)
def gauge_mean(t):
    points = mt.across_series(mt.select_gauge(gauges(t), "view"), F.date_trunc("hour", F.col("ts")))
    return mt.over_time(points, "sum_value").select(F.round("mean_value", 4).alias("mean_value"))


@query("gauge_labels", "SELECT DISTINCT 'node' || user_id % 4 AS instance FROM events")
def gauge_labels(t):
    return mt.label_values(gauges(t), "instance")


@query(
    "gauge_scaled",
    """SELECT ts, 'node' || user_id % 4 AS instance, CAST(user_id AS VARCHAR) AS gpu, round(value * 1000000, 3) AS value FROM events
       WHERE event_type = 'click' AND user_id % 4 IN (1, 2) AND user_id BETWEEN 10 AND 19""",
)
def gauge_scaled(t):
    chosen = mt.select_gauge(gauges(t), "click", "node[12]", "1.", scale=1_000_000)
    return chosen.select("ts", "instance", "gpu", F.round("value", 3).alias("value"))
