"""Tables with incremental upserts: rows in buckets by the hash of their key.

A bucket has base files and, for each later commit that touched it, small delta
files with the new rows of the changed keys.  An upsert reads the touched
buckets, computes the new rows of its keys, and writes those; the commit that
names the files comes last.  ``compact`` writes buckets with many deltas anew.
Files are never changed, so a failed run leaves the old state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.session import join_facts, stage
from talkmill.sources import commits

BUCKETS = 64
COMPACT_SHARE = 0.1  # changed rows, as a share of a bucket's base rows

LOG = "number bigint, bucket int, base boolean, run string, n bigint, key string, buckets int, schema string"


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


class State:
    """What the commits say: key, schema, and the live files of each bucket.
    As large as the number of buckets and of deltas not compacted yet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        entries = commits.log(spark, path, LOG).collect()
        if not entries:
            raise ValueError(f"no table at {path}")
        last = max(entries, key=lambda e: e["number"])
        self.number = last["number"]
        self.key, self.buckets = last["key"], last["buckets"]
        self.schema = T.StructType.fromDDL(last["schema"])
        self.bases: dict = {}
        for e in sorted(entries, key=lambda e: e["number"]):
            if e["base"]:
                self.bases[e["bucket"]] = e
        self.deltas = [e for e in entries if not e["base"] and e["number"] > self._base_number(e["bucket"])]

    def _base_number(self, bucket: int) -> int:
        return self.bases[bucket]["number"] if bucket in self.bases else -1

    def files(self, entries: list) -> DataFrame:
        """The rows of some log entries, with ``_commit`` and ``_deleted``."""
        full = T.StructType([*self.schema.fields, T.StructField("_commit", T.LongType()), T.StructField("_deleted", T.BooleanType())])
        paths = [f"{self.path}/data/run={e['run']}/bucket={e['bucket']}" for e in entries if e["n"]]
        return self.spark.read.schema(full).parquet(*paths) if paths else self.spark.createDataFrame([], full)

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """The table's rows now, or those of some buckets.  Buckets without
        deltas are read as they are; in the others the newest row of a key
        counts."""
        wanted = set(self.bases) | {e["bucket"] for e in self.deltas}
        if buckets is not None:
            wanted &= set(buckets)
        changed = {e["bucket"] for e in self.deltas} & wanted
        whole = self.files([e for b, e in self.bases.items() if b in wanted - changed])
        columns = self.schema.names
        if not changed:
            return whole.select(*columns)
        old = self.files([e for b, e in self.bases.items() if b in changed])
        new = self.files([e for e in self.deltas if e["bucket"] in changed])
        newest = new.groupBy(self.key).agg(F.max("_commit").alias("_commit"))
        live = join_facts(new, newest, [self.key, "_commit"], "left_semi").filter(~F.col("_deleted"))
        kept = join_facts(old, new.select(self.key).distinct(), self.key, "left_anti")
        return whole.unionByName(kept).unionByName(live).select(*columns)


def _write(rows: DataFrame, path: str, key: str, buckets: int) -> tuple[str, dict[int, int]]:
    """Write rows into a run's folders by bucket: its name, rows per bucket."""
    run = commits.new_run()
    placed = rows.withColumn("bucket", _bucket(key, buckets)).repartition("bucket")
    placed.write.partitionBy("bucket").parquet(f"{path}/data/run={run}")
    fields = [*rows.schema.fields, T.StructField("bucket", T.IntegerType())]
    written = rows.sparkSession.read.schema(T.StructType(fields)).parquet(f"{path}/data/run={run}")
    return run, {r["bucket"]: r["n"] for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}


def create(rows: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> None:
    """Store rows with a unique, non-null key as a keyed table."""
    spark = rows.sparkSession
    marked = rows.withColumns({"_commit": F.lit(0).cast("bigint"), "_deleted": F.lit(False)})
    run, counts = _write(marked, path, key, buckets)
    ddl = rows.schema.toDDL()
    entries = [(0, b, True, run, counts.get(b, 0), key, buckets, ddl) for b in range(buckets)]
    commits.commit(spark, path, entries, LOG)


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The table as of the last commit."""
    return State(spark, path).rows()


def upsert(spark: SparkSession, path: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Change the rows of some keys: ``change`` gets the stored rows of the
    keys in ``keys`` (one column of the table's key's name, and any others) and
    returns all rows these keys have from now on; a key it leaves out is
    deleted, a new one inserted.  Null keys are left out.  Returns the buckets
    touched; only those are read, and only rows of these keys are written.
    """
    state = State(spark, path)
    named = stage(keys.select(state.key).filter(F.col(state.key).isNotNull()).distinct(), "keys")
    touched = [r["b"] for r in named.select(_bucket(state.key, state.buckets).alias("b")).distinct().collect()]
    if not touched:
        return []
    stored = stage(state.rows(touched).join(named, state.key, "left_semi"), "stored")
    fresh = stage(change(stored).select(*state.schema.names).filter(F.col(state.key).isNotNull()), "fresh")
    gone = join_facts(stored, fresh.select(state.key), state.key, "left_anti")
    number = state.number + 1
    marked = fresh.withColumn("_deleted", F.lit(False)).unionByName(gone.withColumn("_deleted", F.lit(True)))
    ordered = marked.withColumn("_commit", F.lit(number).cast("bigint")).select(*state.schema.names, "_commit", "_deleted")
    run, counts = _write(ordered, path, state.key, state.buckets)
    ddl = state.schema.toDDL()
    entries = [(number, b, False, run, n, state.key, state.buckets, ddl) for b, n in counts.items()]
    if entries:
        commits.commit(spark, path, entries, LOG)
    return sorted(counts)


def compact(spark: SparkSession, path: str, share: float = COMPACT_SHARE) -> list[int]:
    """Write the buckets anew whose deltas have at least ``share`` of their base
    rows; all others keep their files."""
    state = State(spark, path)
    changed: dict[int, int] = {}
    for e in state.deltas:
        changed[e["bucket"]] = changed.get(e["bucket"], 0) + e["n"]
    due = sorted(b for b, n in changed.items() if n >= share * (state.bases[b]["n"] if b in state.bases else 0))
    if not due:
        return []
    number = state.number + 1
    rows = state.rows(due).withColumns({"_commit": F.lit(number).cast("bigint"), "_deleted": F.lit(False)})
    run, counts = _write(rows, path, state.key, state.buckets)
    ddl = state.schema.toDDL()
    commits.commit(spark, path, [(number, b, True, run, counts.get(b, 0), state.key, state.buckets, ddl) for b in due], LOG)
    return due
