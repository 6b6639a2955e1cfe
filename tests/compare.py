"""Side-by-side run of registered queries and their SQL twins."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool) or value is None:
        return value
    return value


def spark_rows(spark: SparkSession, query, sf_dir: str) -> tuple[list[str], list[tuple]]:
    rows = query(spark, sf_dir)
    names = sorted(rows.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in rows.collect()]


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in cursor.fetchall()]
    return [columns[i] for i in order], rows


def sort_key(row: tuple) -> tuple:
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


def typed(rows: list[tuple]) -> list[tuple]:
    """Rows in a fixed order, every value with its Python type."""
    return [tuple((type(v).__name__, v) for v in row) for row in sorted(rows, key=sort_key)]
