"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings that hold at any size.  Parallelism (spark.sql.shuffle.partitions,
# executor memory) belongs to the cluster and is not fixed here.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where a later step needs one more shuffle for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions of a hot key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Pages can be large: few of them per Arrow batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def build_session(app: str = "talkmill", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in
    ``spark.checkpoint.dir``, else the context's checkpoint folder; a local
    session without either gets a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="talkmill-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/talkmill/{label}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, once.  Spark
    serves the archive to the executors; an installed package needs none."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or "site-packages" in package.parts:
        return
    name = str(Path(tempfile.mkdtemp(prefix="talkmill-")) / package.name)
    context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where two passes must see the same rows.  A table survives the loss
    of executors, is compressed, and later reads prune its columns.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_facts(rows: DataFrame, facts: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join many rows per key to at most one row of facts per key.

    Facts usually come out of an aggregate on the key.  Joined directly, the
    join would reuse that aggregate's partitioning and a key with a third of
    all rows would stay in one task: the skew join only splits sides that are
    plain shuffles.  Staged facts give it two such sides, or a broadcast when
    their measured size is below the session's limit.
    """
    return rows.join(stage(facts, "facts"), key, how)


def range_partitions(spark: SparkSession) -> int:
    """Number of range partitions: the cluster's shuffle parallelism."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
