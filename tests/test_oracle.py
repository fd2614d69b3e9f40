"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as spark_entry
from tests.oracle_compare import difference, duck

SF_DIR = os.environ.get("TIERFLOW_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    """Queries on training text may have none; they have tests of their own."""
    assert {q.__name__ for q in spark_entry._QUERIES} <= set(spark_entry.oracle_sql())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    found = difference(
        spark, con, spark_entry.queries()[name], spark_entry.oracle_sql()[name], SF_DIR
    )
    assert found is None


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["product", "total_revenue", "order_count", "avg_order_value"]
    assert result.count() > 0
