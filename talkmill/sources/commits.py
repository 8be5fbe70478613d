"""A log of commits beside a table's files.

Data is written to folders of its own first; a commit then names them in one
small file, which becomes visible as a whole or not at all.  Readers follow
the log only, so what a failed run left behind is never seen.  One writer at a
time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def new_run() -> str:
    """Name of a run's folder, never used before."""
    return uuid.uuid4().hex


def log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All committed rows; none where nothing is committed yet."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commit(spark: SparkSession, path: str, rows: list[tuple] | DataFrame, schema: str) -> None:
    """Append the rows of one commit, as one file."""
    frame = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.mode("append").parquet(f"{path}/commits")
