"""Registered queries against their SQL twins, on odd rows and on the small tables, and on empty tables."""

from __future__ import annotations

import duckdb
import pytest
from compare import spark_rows, sql_rows, typed
from fixtures import empty_dir, odd_dir  # noqa: F401

import corpus_pipeline
from cartflow.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


def connection(folder: str):
    made = duckdb.connect()
    for name in ("documents", "benchmark", "pages"):
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return made


def same(spark, folder: str, name: str) -> None:
    names, found = spark_rows(spark, QUERIES[name], folder)
    expected_names, expected = sql_rows(connection(folder), ORACLE_SQL[name])
    assert names == expected_names
    assert typed(found) == typed(expected)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_odd_rows(spark, odd_dir, name):
    same(spark, odd_dir, name)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_small_tables(spark, name):
    same(spark, SMALL, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, odd_dir, name):
    rows = QUERIES[name](spark, empty_dir)
    assert rows.collect() == []
    assert rows.columns == QUERIES[name](spark, odd_dir).columns


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_empty_pipeline(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
