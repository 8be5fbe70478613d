"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from talkmill.plans import QUERIES
from tests.compare import difference, duck_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Queries with HTML tags, a tokenizer or a text generator in their last stage.
IN_PYTHON = {
    "generate_by_question",
    "generate_pairs",
    "page_article_text",
    "page_articles",
    "page_split",
    "site_articles",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = contract.queries()[name](spark, FOLDER)
    got = spark_rows(frame)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert ("Python" in plan or "InPandas" in plan) == (name in IN_PYTHON)
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        assert difference(got, duck_rows(FOLDER, sql)) is None
    else:
        assert got[1]


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
