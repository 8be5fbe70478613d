"""A training corpus from ``documents``: five stages, each over all that the
one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkmill.llm import cuckoo, mixing, ngram_join, queries, toxicity
from talkmill.session import stage
from talkmill.sources.readers import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that are rejected as toxic.  Null and empty texts are
    scored like texts without words; every row is judged by itself, repeated
    ones and those without doc_id too; nothing is rejected without labels of
    both classes; an empty table stays empty."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without blanks: the
    longest, then the smallest doc_id (null last).  Null counts as empty, so
    one empty text stays; of repeated rows one stays; an empty table stays
    empty."""
    return cuckoo.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near copies,
    with all its rows.  Texts without words and rows without doc_id are linked
    with nothing and stay; an empty table stays empty."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, by shard.  Texts without words give
    nothing to it; a null source is a source; repeated rows are drawn one by
    one; an empty table stays empty."""
    return mixing.mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each row's ids and of their bytes.  Null and empty texts have
    no ids; repeated rows come out as often; an empty table gives none."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_texts),
]

#: A trained classifier, a random mix and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)
