"""Every query against its SQL."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from lakelayers.suite.queries import QUERIES as SUITE

# The subpackage for training data has tests of its own.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in SUITE}
SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name in SUITE}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, QUERIES[name], SQL[name], sf_dir) == []


@pytest.mark.parametrize(
    ("name", "old", "new"),
    [
        ("gold_daily_summary", "count(DISTINCT customer_id)", "count(customer_id)"),
        ("silver_dedup", "seq DESC", "seq ASC"),
        ("cast_money", "DECIMAL(18,2)) AS amount", "DECIMAL(18,1)) AS amount"),
        ("quality_orders_raw", "AND n > 1", "AND n > 2"),
    ],
)
def test_comparison_sees_a_wrong_answer(spark, con, sf_dir, name, old, new):
    assert old in SQL[name]
    assert differences(spark, con, QUERIES[name], SQL[name].replace(old, new), sf_dir)


def test_entry(spark):
    first = entry_points.entry(spark)
    assert first.schema == entry_points.entry(spark).schema
    assert first.count() > 0
