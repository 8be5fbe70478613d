"""Sinks: append, rolling files, good/bad split, chunks, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill import fixed
from talkmill.session import stage
from talkmill.sources import commits

# The tags of the message columns in a dataset manifest.
MANIFEST_TAGS = {
    "role_tag": "role",
    "content_tag": "content",
    "user_tag": "user",
    "assistant_tag": "assistant",
    "system_tag": "system",
}


def append(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    rows.write.format(fmt).mode("append").save(path)


def append_table(rows: DataFrame, name: str) -> None:
    rows.write.mode("append").saveAsTable(name)


def upload_batches(rows: DataFrame, path: str, rows_per_load: int = fixed.UPLOAD_ROWS) -> None:
    """Files of at most ``rows_per_load`` rows, one load each."""
    rows.write.mode("append").option("maxRecordsPerFile", rows_per_load).json(path)


def rolling_json(rows: DataFrame, path: str, rows_per_file: int = fixed.ROWS_PER_FILE) -> None:
    """JSON-lines files of at most ``rows_per_file`` rows."""
    rows.write.option("maxRecordsPerFile", rows_per_file).json(path)


def json_results(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def csv_results(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def split_write(rows: DataFrame, good: Column, path: str, fmt: str = "json") -> None:
    """One pass into ``outcome=good`` and ``outcome=bad`` below ``path``."""
    outcome = F.when(F.coalesce(good, F.lit(False)), "good").otherwise("bad")
    rows.withColumn("outcome", outcome).write.partitionBy("outcome").format(fmt).save(path)


def chunked(rows: DataFrame, path: str, fmt: str = "json") -> None:
    """One folder per export chunk.  Rows are placed by chunk first, so that a
    chunk is one file, and rows of a chunk stay in order."""
    placed = rows.repartitionByRange(F.col("chunk"), F.col("rn")).sortWithinPartitions("chunk", "rn")
    placed.write.partitionBy("chunk").format(fmt).save(path)


def manifest(files: DataFrame) -> DataFrame:
    """``name, entry`` per data file of a scan with ``file_name``: the name
    without its ending, and the columns and tags of the dataset."""
    names = files.select("file_name").distinct()
    return names.select(
        F.regexp_replace("file_name", r"\.jsonl?$", "").alias("name"),
        F.struct(
            F.col("file_name"),
            F.lit("sharegpt").alias("formatting"),
            F.struct(F.lit("messages").alias("messages")).alias("columns"),
            F.struct(*[F.lit(v).alias(k) for k, v in MANIFEST_TAGS.items()]).alias("tags"),
        ).alias("entry"),
    )


EXPORT_LOG = "number bigint, chunk bigint, run string, n bigint, checksum decimal(38,0)"


def checksum(rows: DataFrame, columns: list[str]) -> Column:
    """Sum of the hashes of rows, whatever their order."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("decimal(38,0)").alias("checksum")


def _facts(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(F.col("chunk").cast("bigint").alias("chunk")).agg(F.count("*").alias("n"), checksum(rows, columns))


def export_committed(rows: DataFrame, path: str, chunks_per_commit: int = 1000, fmt: str = "json") -> int:
    """Export ``rows`` (with ``chunk`` and ``rn``) so that a broken export goes
    on where it stopped.

    Chunks are written a range at a time, read back, and committed with their
    row count and checksum if these are the source's; only then do they count.
    A later call skips committed chunks whose source has not changed and
    writes all others.  Returns the number of chunks this call has written.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != "chunk"]
    kept = stage(rows, "export")  # numbered once, whatever the number of ranges
    last = kept.agg(F.max("chunk")).first()[0]
    number = commits.log(spark, path, EXPORT_LOG).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    written = 0
    for low in range(0, -1 if last is None else last + 1, chunks_per_commit):
        part = kept.filter(F.col("chunk").between(low, low + chunks_per_commit - 1))
        due = stage(_facts(part, columns).join(exported_chunks(spark, path), ["chunk", "n", "checksum"], "left_anti"), "due")
        n = due.count()
        if not n:
            continue
        number += 1
        run = commits.new_run()
        place = f"{path}/data/run={run}"
        chunked(part.join(due.select("chunk"), "chunk", "left_semi"), place, fmt)
        stored = _facts(spark.read.schema(rows.schema).format(fmt).load(place), columns)
        broken = due.join(stored, ["chunk", "n", "checksum"], "left_anti").count()
        if broken:
            raise OSError(f"{broken} chunks were not stored as they are")
        entries = due.select(F.lit(number).cast("bigint").alias("number"), "chunk", F.lit(run).alias("run"), "n", "checksum")
        commits.commit(spark, path, entries, EXPORT_LOG)
        written += n
    return written


def exported_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``chunk, run, n, checksum`` of every committed chunk, as of its latest
    commit."""
    latest = F.max_by(F.struct("run", "n", "checksum"), "number")
    return commits.log(spark, path, EXPORT_LOG).groupBy("chunk").agg(latest.alias("l")).select("chunk", "l.*")


def read_export(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """The rows of all committed chunks, with ``chunk``.  Runs that are in no
    commit are not opened; of the others, chunks written again later are left
    out."""
    live = exported_chunks(spark, path)
    runs = [r["run"] for r in live.select("run").distinct().collect()]  # one per commit
    if not runs:
        return spark.createDataFrame([], f"{schema}, chunk bigint")
    reader = spark.read.schema(f"{schema}, run string, chunk bigint").option("basePath", f"{path}/data").format(fmt)
    stored = reader.load([f"{path}/data/run={r}" for r in runs])
    return stored.join(live.select("run", "chunk"), ["run", "chunk"], "left_semi").drop("run")
