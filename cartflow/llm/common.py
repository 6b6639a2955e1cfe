"""Helpers shared by the operators: text words, scratch tables, expression binding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.settings import scratch_path

#: White space that ends a word; every other code point belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside the lambdas of ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text in order; no word for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def materialize(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: later reads survive lost executors."""
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def unsized(rows: DataFrame) -> DataFrame:
    """``rows`` as one side of a join in which neither side may be broadcast by Spark's estimate.

    Spark takes what an array explodes to, and what is grouped from it, to be as many rows as before, and compressed files
    to be as large in memory.
    """
    return rows.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
