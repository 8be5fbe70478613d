"""Streams over the event table: each query runs everything available and gives
the result of the stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.operators import versions as vs
from talkmill.plans.metrics import SQL_METRICS, log_lines
from talkmill.plans.registry import ORACLES, QUERIES
from talkmill.session import shared_path
from talkmill.sources.readers import table
from talkmill.streaming import follow


def stream_query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream, with a time zone for the watermark."""
    stream = follow.parquet_stream(spark, folder, follow.EVENT_SCHEMA, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@stream_query("stream_tail", SQL_METRICS)
def stream_tail(spark, folder):
    path = shared_path(spark, "log")
    log_lines(lambda name: table(spark, folder, name)).select("value").write.text(path)
    return follow.to_table(follow.tail_metrics(follow.log_stream(spark, path)), "tail")


@stream_query(
    "stream_counters",
    """SELECT count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 50) AS large FROM events""",
)
def stream_counters(spark, folder):
    """Counters of every micro-batch, summed, against the rows written."""
    counters = {"errors": F.col("event_type") == "error", "large": F.col("value") > 50}
    written, batches = follow.counted_to_table(events(spark, folder), "counted", **counters)
    found = batches.agg(F.sum("errors").alias("errors"), F.sum("large").alias("large"))
    return found.select(written.agg(F.count("*")).scalar().alias("n_rows"), "errors", "large")


@stream_query("stream_new_items", "SELECT DISTINCT user_id AS item FROM events")
def stream_new_items(spark, folder):
    # Keys are forgotten after 60 days, longer than the events last.
    items = events(spark, folder).select(F.col("user_id").alias("item"), "ts")
    return follow.to_table(follow.new_items(items, "item", "ts", "60 days"), "items").select("item")


@stream_query(
    "stream_series",
    """SELECT time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '2000-01-01') AS step, event_type, count(*) AS n, round(sum(value), 6) AS sum_value
       FROM events GROUP BY 1, 2""",
)
def stream_series(spark, folder):
    steps = follow.to_latest(follow.series(events(spark, folder), "event_type"), ["step", "event_type"], "series")
    return steps.select(F.col("step").cast("timestamp_ntz").alias("step"), "event_type", "n", F.round("sum_value", 6).alias("sum_value"))


@stream_query(
    "stream_idle_gaps",
    """WITH e AS (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS prev FROM events),
       s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 45 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts) AS g FROM e)
       SELECT event_type, min(ts) AS active_from, max(ts) AS last_activity, count(*) AS n FROM s GROUP BY event_type, g
       HAVING max(ts) + INTERVAL 45 MINUTE <= (SELECT max(ts) FROM events)""",
)
def stream_idle_gaps(spark, folder):
    found = follow.to_table(follow.stalls(events(spark, folder), "event_type", 45 * 60), "stalls")
    return found.select(
        "event_type",
        F.col("active_from").cast("timestamp_ntz").alias("active_from"),
        F.col("last_activity").cast("timestamp_ntz").alias("last_activity"),
        "n",
    )


@stream_query(
    "stream_stall_phases",
    """WITH RECURSIVE polls AS (SELECT user_id, s, active, done, row_number() OVER (PARTITION BY user_id ORDER BY s) AS k FROM (
         SELECT user_id, epoch(date_trunc('hour', ts))::BIGINT AS s, bool_or(event_type IN ('view', 'click')) AS active, bool_or(event_type = 'purchase') AS done
         FROM events GROUP BY 1, 2) WHERE s + 3600 <= (SELECT epoch(max(ts)) FROM events)),
       runs AS (
         SELECT user_id, k, s, s AS begun, CASE WHEN active THEN s END AS last, CASE WHEN active THEN s ELSE s - 3600 END AS since,
           active::BIGINT AS n, done, false AS ended FROM polls WHERE k = 1
         UNION ALL
         SELECT user_id, k, s, begun, last, since, n, done, s >= since + 3600 * (CASE WHEN done THEN 20 WHEN last IS NULL THEN 96 ELSE 12 END) AS ended
         FROM (SELECT p.user_id, p.k, p.s, CASE WHEN f.fresh THEN p.s ELSE r.begun END AS begun,
             CASE WHEN p.active THEN p.s WHEN f.fresh THEN NULL ELSE r.last END AS last,
             CASE WHEN p.active THEN p.s WHEN f.fresh THEN p.s - 3600 ELSE r.since END AS since,
             CASE WHEN f.fresh THEN 0 ELSE r.n END + p.active::BIGINT AS n, CASE WHEN f.fresh THEN p.done ELSE r.done OR p.done END AS done
           FROM runs r JOIN polls p ON p.user_id = r.user_id AND p.k = r.k + 1,
             LATERAL (SELECT r.ended OR p.s > r.since + 3600 * (CASE WHEN r.done THEN 20 WHEN r.last IS NULL THEN 96 ELSE 12 END) AS fresh) f)),
       steps AS (SELECT *, since + 3600 * (CASE WHEN done THEN 20 WHEN last IS NULL THEN 96 ELSE 12 END) AS due, lead(s) OVER (PARTITION BY user_id ORDER BY k) AS next FROM runs)
       SELECT user_id, CASE WHEN done THEN 'completed' WHEN last IS NULL THEN 'not started' ELSE 'running' END AS phase,
         make_timestamp(begun * 1000000) AS begun, make_timestamp(last * 1000000) AS last_activity,
         make_timestamp((CASE WHEN ended THEN s ELSE due END + 3600) * 1000000) AS stalled_at, n AS active_polls
       FROM steps WHERE ended OR next > due OR (next IS NULL AND due + 3600 < (SELECT epoch(max(ts)) FROM events))""",
)
def stream_stall_phases(spark, folder):
    kind = F.col("event_type")
    found = follow.stall_phases(events(spark, folder), "user_id", kind.isin("view", "click"), kind == "purchase", 3600)
    rows = follow.to_table(found, "phases")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("begun", "last_activity", "stalled_at")}
    return rows.withColumns(times)


@stream_query(
    "stream_quota",
    """WITH w AS (SELECT date_trunc('hour', ts) + to_hours(unnest(range(1, 25))) AS window_end, user_id FROM events)
       SELECT window_end, user_id, count(*) AS n_messages FROM w GROUP BY ALL""",
)
def stream_quota(spark, folder):
    counts = follow.to_latest(follow.hourly_counts(events(spark, folder), "user_id"), ["hour", "user_id"], "quota")
    return follow.rolling_quota(counts, "user_id").select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "user_id", "n_messages")


@stream_query(
    "stream_trigger",
    """SELECT version_number, record_count, training_status FROM (VALUES (3.0::DOUBLE, 0::BIGINT, 'DONE')) v(version_number, record_count, training_status)
       UNION ALL SELECT 4.0, count(*), 'PENDING' FROM events WHERE ts > TIMESTAMP '2024-01-11' HAVING count(*) > 500""",
)
def stream_trigger(spark, folder):
    base = shared_path(spark, "trigger")
    seed = [(3.0, "", datetime(2024, 1, 11), 0, "DONE")]
    spark.createDataFrame(seed, vs.VERSION_SCHEMA).coalesce(1).write.parquet(f"{base}/versions")
    run = follow.version_trigger(f"{base}/versions", f"{base}/rows", lambda: datetime(2025, 1, 1))
    follow.run_available(events(spark, folder).writeStream.foreachBatch(run), f"{base}/checkpoint")
    made = spark.read.schema(vs.VERSION_SCHEMA).parquet(f"{base}/versions")
    return made.select("version_number", "record_count", "training_status")


@stream_query(
    "stream_new_versions",
    "SELECT DISTINCT user_id AS version FROM events",
)
def stream_new_versions(spark, folder):
    base = shared_path(spark, "deployed")
    schema = "version bigint"
    table(spark, folder, "events").filter("event_type = 'view'").select(
        F.col("user_id").alias("version")
    ).distinct().write.parquet(base)
    run = follow.new_versions(base, "version", schema)
    stream = events(spark, folder).select(F.col("user_id").alias("version"))
    follow.run_available(stream.writeStream.foreachBatch(run), f"{base}-checkpoint")
    return spark.read.schema(schema).parquet(base)
