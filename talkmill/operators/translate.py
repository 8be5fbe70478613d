"""Translation of conversations that can be broken off and resumed.

A conversation is translated up to its first empty message.  Conversations are
worked off in parts by the hash of their id; the rows of a part and the ids it
has finished are written first, and one commit makes both count.  A part that
broke before its commit is done again; a finished id never is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions import text as tx
from talkmill.session import join_facts, stage
from talkmill.sources import commits

LOG = "number bigint, run string, n bigint"
PARTS = 4


def before_empty(turns: DataFrame, key: str = "conv_id", order: str = "turn", content: str = "text") -> DataFrame:
    """The turns of each conversation before its first null or empty one."""
    empty = F.coalesce(F.length(content), F.lit(0)) == 0
    stops = turns.filter(empty).groupBy(key).agg(F.min(order).alias("_stop"))
    return join_facts(turns, stops, key, "left").filter(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def _runs(spark: SparkSession, path: str, folder: str, schema) -> DataFrame:
    """What the committed runs have written below one folder."""
    names = [r["run"] for r in commits.log(spark, path, LOG).collect()]  # one per part
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}/run={n}" for n in names])


def finished(spark: SparkSession, path: str, key_type: str = "bigint", key: str = "conv_id") -> DataFrame:
    """The ids that need no further work, those without a kept turn included."""
    return _runs(spark, path, "ids", f"{key} {key_type}")


def translate(
    turns: DataFrame,
    path: str,
    translator: Callable[[DataFrame], DataFrame],
    *,
    key: str = "conv_id",
    order: str = "turn",
    content: str = "text",
    parts: int = PARTS,
) -> int:
    """Translate the conversations of ``turns`` that ``path`` has not finished;
    returns their number.  ``translator`` adds a column ``translated`` to its
    rows (``generate.respond``, or columns); its message tags and fences are
    removed.  A null id is left out.  Nothing new gives no commit.
    """
    spark = turns.sparkSession
    kind = turns.schema[key].dataType.simpleString()
    ids = turns.select(key).filter(F.col(key).isNotNull()).distinct()
    pending = stage(ids.join(finished(spark, path, kind, key), key, "left_anti"), "pending")
    number = commits.log(spark, path, LOG).count()
    done = 0
    for part in range(parts):
        own = pending.filter(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)) == part)
        n = own.count()
        if not n:
            continue
        kept = before_empty(join_facts(turns, own, key, "left_semi"), key, order, content)
        rows = translator(kept).select(key, order, tx.translation_cleanup(F.col("translated")).alias("translated"))
        run = commits.new_run()
        rows.write.parquet(f"{path}/rows/run={run}")
        own.write.parquet(f"{path}/ids/run={run}")
        commits.commit(spark, path, [(number, run, n)], LOG)
        number += 1
        done += n
    return done


def translated(spark: SparkSession, path: str, schema: str = "conv_id bigint, turn bigint, translated string") -> DataFrame:
    """The translated turns of all committed parts, each once."""
    return _runs(spark, path, "rows", schema)
