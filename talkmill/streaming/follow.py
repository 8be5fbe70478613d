"""Structured Streaming: log tails, new items, fixed-cadence series, stalls,
rolling quotas and data-version triggers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from talkmill import fixed
from talkmill.operators import versions as vs
from talkmill.operators.metrics import log_metrics
from talkmill.session import shared_path, ship_package

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def parquet_stream(spark: SparkSession, folder: str, schema: str, glob: str, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of new log files.  The writer rolls files; a file is read whole."""
    return spark.readStream.text(folder)


def tail_metrics(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Metric rows of new log lines; unreadable lines give none."""
    return log_metrics(lines, line, keep=keep)


def new_items(items: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Every item the first time it is seen.  With an event time and a delay the
    seen keys are forgotten after the delay; without, they are kept."""
    if event_time and delay:
        return items.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return items.dropDuplicates([key])


def series(
    gauges: DataFrame,
    label: str,
    cadence: str = f"{fixed.POLL_SECONDS} seconds",
    delay: str = "1 minute",
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Mean value per label and time step; rows older than the delay are late."""
    return (
        gauges.withWatermark(ts, delay)
        .groupBy(F.window(ts, cadence), label)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"))
        .select(F.col("window.start").alias("step"), label, "n", "sum_value")
    )


def stalls(
    events: DataFrame, key: str, gap_seconds: int = fixed.STALL_SECONDS, delay: str = "0 seconds", ts: str = "ts"
) -> DataFrame:
    """A row when a key has been silent for ``gap_seconds``: the time of its
    last activity and the number of events since the stall before.  A key that
    is still active gives none.  ``build_session`` has sessions merged before
    the shuffle, so a hot key sends few rows."""
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, f"{gap_seconds} seconds"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            key,
            F.col("session_window.start").alias("active_from"),
            (F.col("session_window.end") - F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("last_activity"),
            "n",
        )
    )


def stall_polls(started: bool, completed: bool) -> int:
    """Polls without activity after which a run counts as stalled: eight times
    as many before the first activity, another number after completion."""
    if completed:
        return fixed.UPLOAD_SECONDS // fixed.POLL_SECONDS
    polls = fixed.STALL_SECONDS // fixed.POLL_SECONDS
    return polls if started else polls * fixed.STALL_FACTOR_BEFORE_START


def stall_limit(started: bool, completed: bool, interval: int = fixed.POLL_SECONDS) -> int:
    """``stall_polls`` in seconds."""
    return stall_polls(started, completed) * interval


# What is kept of a key: of its run the begin of its first poll, of its last
# active poll, of the poll it is measured from, the number of active polls,
# whether it is completed; and the polls that the watermark has not passed.
RUN_STATE = (
    "begun bigint, last bigint, since bigint, active bigint, completed boolean, "
    "polls array<bigint>, works array<boolean>, ends array<boolean>"
)


def _follow_runs(interval: int, columns: list[str]):
    """The function of a keyed state: polls of one key in order, and the timer
    of its run."""

    def limit(run: tuple) -> int:
        return run[2] + stall_polls(run[1] is not None, run[4]) * interval

    def stalled(key: tuple, run: tuple, poll: int) -> tuple:
        phase = "completed" if run[4] else "running" if run[1] is not None else "not started"
        return (*key, phase, run[0], run[1], poll + interval, run[3])

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        kept = tuple(state.get) if state.exists else (None,) * 5 + ([], [], [])
        run = kept[:5] if kept[0] is not None else None
        waiting = {p: (a, c) for p, a, c in zip(*kept[5:])}
        for frame in frames:
            # However many events: one entry per poll.  Most keys have few, so
            # no data frame is grouped for them.
            polls, *tests = (frame[c].to_numpy() for c in ("poll", "active", "completed"))
            timed = polls == polls  # rows without a time belong to no poll
            seen, active, completed = (set(polls[timed & x].tolist()) for x in (timed, *(t.astype(bool) for t in tests)))
            for poll in map(int, seen):
                before = waiting.get(poll, (False, False))
                waiting[poll] = (before[0] or poll in active, before[1] or poll in completed)
        passed = state.getCurrentWatermarkMs() / 1000
        for poll in sorted(p for p in waiting if p + interval <= passed):
            active, completed = waiting.pop(poll)
            if run is not None and poll > limit(run):
                found.append(stalled(key, run, limit(run)))
                run = None
            begun, last, since, n, done = run or (poll, None, poll - interval, 0, False)
            run = (begun, poll if active else last, poll if active else since, n + int(active), done or completed)
            if poll >= limit(run):
                found.append(stalled(key, run, poll))
                run = None
        if run is not None and limit(run) + interval < passed:
            found.append(stalled(key, run, limit(run)))
            run = None
        times = [p + interval for p in waiting] + ([limit(run) + interval + 1] if run is not None else [])
        if times:
            polls = sorted(waiting)
            flags = [[waiting[p][k] for p in polls] for k in range(2)]
            state.update((*(run or (None,) * 5), polls, *flags))
            state.setTimeoutTimestamp(max(int(min(times) * 1000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame(found, columns=columns, dtype=object)

    return follow


def stall_phases(
    events: DataFrame,
    key: str,
    activity: Column,
    completed: Column,
    interval: int = fixed.POLL_SECONDS,
    delay: str = "0 seconds",
    ts: str = "ts",
) -> DataFrame:
    """A row when a key's run has stalled, with the phase it was in: ``key,
    phase, begun, last_activity, stalled_at, active_polls``.

    Time is cut into polls of ``interval`` seconds.  A run begins with a key's
    first event of any kind; events that meet ``activity`` keep it alive, one
    that meets ``completed`` marks it as completed.  It has stalled at the end
    of the poll in which ``stall_polls`` without activity are reached, and the
    key's next event begins another run.  A poll is looked at when the
    watermark has passed it, so batches do not matter; rows later than the
    delay are left out.  A null key is a key; a null test is not met.

    A key's events stream through a task and its state has one entry per poll
    that the watermark has not passed, however many events there are.  The
    state's timer fires without further events of the key.
    """
    ship_package(events.sparkSession)
    poll = F.floor(F.unix_micros(ts) / (interval * 1_000_000)) * interval
    polls = events.withWatermark(ts, delay).select(
        key, ts, poll.cast("bigint").alias("poll"),
        F.coalesce(activity, F.lit(False)).alias("active"), F.coalesce(completed, F.lit(False)).alias("completed"),
    )
    names = [key, "phase", "begun", "last_activity", "stalled_at", "active_polls"]
    kinds = T.StructType([events.schema[key], T.StructField("phase", T.StringType()), *(T.StructField(n, T.LongType()) for n in names[2:])])
    found = polls.groupBy(key).applyInPandasWithState(
        _follow_runs(interval, names), kinds, T.StructType.fromDDL(RUN_STATE), "append", GroupStateTimeout.EventTimeTimeout
    )
    times = {name: F.timestamp_seconds(name) for name in ("begun", "last_activity", "stalled_at")}
    return found.withColumns(times)


def hourly_counts(messages: DataFrame, user: str, delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Messages per user and hour: what the stream keeps for ``rolling_quota``."""
    return (
        messages.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 hour"), user)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("hour"), user, "n")
    )


def rolling_quota(counts: DataFrame, user: str, hours: int = fixed.QUOTA_HOURS) -> DataFrame:
    """Messages per user in windows of ``hours`` that slide by an hour, from a
    table of ``hourly_counts``: counts, not messages, are spread over windows."""
    ends = F.sequence(F.col("hour") + F.expr("INTERVAL 1 HOUR"), F.col("hour") + F.expr(f"INTERVAL {hours} HOURS"), F.expr("INTERVAL 1 HOUR"))
    spread = counts.select(F.explode(ends).alias("window_end"), user, "n")
    return spread.groupBy("window_end", user).agg(F.sum("n").alias("n_messages"))


def version_trigger(
    version_path: str,
    rows_path: str,
    now: Callable[[], datetime],
    threshold: int = fixed.NEW_ROWS_THRESHOLD,
    ts: str = "ts",
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: appends the batch to the stored rows, counts
    rows newer than the last data version, and appends a PENDING version when
    they exceed the threshold.  A replayed batch overwrites its own rows.  Rows
    are stored by day, and days before that version are not read again."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn("day", F.to_date(ts))
        dated.write.mode("overwrite").partitionBy("day").parquet(f"{rows_path}/batch={batch_id}")
        versions = spark.read.schema(vs.VERSION_SCHEMA).parquet(version_path)
        last = vs.latest_version(versions).select("version_number", F.to_date("timestamp").alias("day")).first()
        number = last["version_number"] if last else 0.0
        stored = spark.read.schema(dated.schema).option("basePath", rows_path).parquet(rows_path)
        if last and last["day"]:
            stored = stored.filter(F.col("day") >= F.lit(last["day"]))
        found = vs.retrain_check(vs.since_version(stored, versions, number, ts), threshold).first()
        if found["is_train"]:
            query = f"SELECT * FROM messages WHERE {ts} > mark({number}) LIMIT {found['new_records']}"
            row = vs.next_version_row(number, found["new_records"], now(), query)
            spark.createDataFrame([row], vs.VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(version_path)

    return run


def new_versions(deployed_path: str, key: str, schema: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: rows whose key is not deployed yet are added
    to the deployed table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        deployed = batch.sparkSession.read.schema(schema).parquet(deployed_path).select(key).distinct()
        fresh = batch.dropDuplicates([key]).join(deployed, key, "left_anti")
        fresh.write.mode("append").parquet(deployed_path)

    return run


def run_available(writer: DataStreamWriter, checkpoint: str, timeout: int = 600) -> list[dict]:
    """Process everything there is, then stop.  Returns what was observed: one
    entry per observation and micro-batch of those that Spark still remembers
    (``spark.sql.streaming.numRecentProgressUpdates``)."""
    query = writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    try:
        if not query.awaitTermination(timeout):
            raise TimeoutError(f"stream not finished after {timeout} s")
        return [
            {"batch": progress.batchId, "name": name, **metrics.asDict()}
            for progress in query.recentProgress
            for name, metrics in progress.observedMetrics.items()
        ]
    finally:
        query.stop()


def counted_to_table(stream: DataFrame, label: str, timeout: int = 600, **tests: Column) -> tuple[DataFrame, DataFrame]:
    """``to_table`` with run counters: (table, ``batch`` and one count per
    test, a row per micro-batch that had rows)."""
    spark = stream.sparkSession
    out = shared_path(spark, label)
    watched = stream.observe("counters", F.count(F.lit(1)).alias("_rows"), *[F.count_if(t).alias(name) for name, t in tests.items()])
    writer = watched.writeStream.outputMode("append").format("parquet").option("path", out)
    seen = [e for e in run_available(writer, f"{out}-checkpoint", timeout) if e["name"] == "counters" and e["_rows"]]
    schema = ", ".join(["batch bigint", *[f"`{name}` bigint" for name in tests]])
    return spark.read.schema(stream.schema).parquet(out), spark.createDataFrame([(e["batch"], *[e[t] for t in tests]) for e in seen], schema)


def to_table(stream: DataFrame, label: str, timeout: int = 600) -> DataFrame:
    """Run an append stream into a table of the shared folder and read it."""
    spark = stream.sparkSession
    out = shared_path(spark, label)
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", out)
    run_available(writer, f"{out}-checkpoint", timeout)
    return spark.read.schema(stream.schema).parquet(out)


def to_latest(stream: DataFrame, keys: list[str], label: str, timeout: int = 600) -> DataFrame:
    """Run an updating stream and keep the newest row of each key.  Batches are
    stored by number, so a replay overwrites itself."""
    spark = stream.sparkSession
    out = shared_path(spark, label)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b{batch_id}")

    writer = stream.writeStream.outputMode("update").foreachBatch(store)
    run_available(writer, f"{out}-checkpoint", timeout)
    rows = spark.read.option("recursiveFileLookup", True).parquet(out)
    newest = rows.groupBy(*keys).agg(F.max("_batch").alias("_batch"))
    return rows.join(newest, [*keys, "_batch"], "left_semi").drop("_batch")
