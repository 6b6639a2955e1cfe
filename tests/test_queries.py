"""Every registered query equals its SQL twin, in values and in Python types."""

from __future__ import annotations

import pytest
from compare import oracle_connection, spark_rows, sql_rows, typed
from conftest import SF_SMALL

import __spark_entry__ as entry_points
from cartflow.registry.oracle import oracle_sql
from cartflow.registry.queries import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    spark_names, found = spark_rows(spark, QUERIES[name], SF_SMALL)
    sql_names, expected = sql_rows(connection, SQL[name])
    assert spark_names == sql_names
    assert found
    assert typed(found) == typed(expected)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["month", "order_count", "total_revenue"]
    assert rows.count() > 0
