"""Registry of queries, and SQL pieces used by several of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from talkmill.sources.readers import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable], Query]:
    """Register a function of a table loader ``t("orders")``."""

    def register(run: Callable) -> Query:
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return run(lambda table_name: table(spark, folder, table_name))

        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return call

    return register


def sql_words(column: str) -> str:
    """List of the words of a text."""
    return rf"list_filter(regexp_split_to_array({column}, '\s+'), lambda w: w <> '')"


def sql_word_count(column: str) -> str:
    return f"CAST(len({sql_words(column)}) AS BIGINT)"


def sql_strip(column: str) -> str:
    return rf"regexp_replace({column}, '^\s+|\s+$', '', 'g')"
