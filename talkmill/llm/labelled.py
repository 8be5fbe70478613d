"""A bounded sample of labelled documents for classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import stage, text_of


def training_rows(docs: DataFrame, labels: DataFrame, most: int, *, label_columns: list[str], learnable=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text`` and the label columns of about ``most`` labelled documents.

    Which ones is decided by a hash of the id, alike at every size.  Rows with
    a null id or label are left out; of several labels of an id the largest
    counts, and of several texts the one that sorts first, so an id gives one
    row.  ``learnable``: a condition on the column ``id``.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("id"), *(F.col(c).cast("int").alias(c) for c in label_columns)).dropna()
    own = own if learnable is None else own.where(learnable)
    total = own.count()
    share = min(1_000_000, most * 1_000_000 // max(1, total))
    chosen = own.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < share)
    chosen = stage(chosen.groupBy("id").agg(*(F.max(c).alias(c) for c in label_columns)), "labels")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), text_of(text).alias("text"))
    # At most about ``most`` rows of two or three numbers.
    one = texts.join(F.broadcast(chosen.select("id")), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return one.join(F.broadcast(chosen), "id")
