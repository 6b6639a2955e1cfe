"""Raw tables from CSV files: by-name columns, strict types, first row per key."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.operators.conform import by_name, strict
from cartflow.operators.dedup import COPIES, first_per_key
from cartflow.schemas import TableSpec
from cartflow.sources.csv_files import SEQUENCE, read_rows

log = logging.getLogger(__name__)


def stored_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.schema.fields, T.StructField(COPIES, T.LongType())])


def keep_first(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows reduced to the first per key; tables without a key keep all rows."""
    if not spec.key:
        return rows.select(*spec.columns, F.lit(1).cast("bigint").alias(COPIES))
    return first_per_key(rows, spec.key, SEQUENCE, columns=spec.columns)


def load_table(spark: SparkSession, spec: TableSpec, location: str) -> DataFrame:
    """The table as loaded from ``location``, with ``load_copies`` read rows behind each row.

    Without any file the table is empty.
    """
    rows = read_rows(spark, location, spec.line_breaks)
    if rows is None:
        log.warning("no file %s: table %s is empty", location, spec.name)
        return spark.createDataFrame([], stored_schema(spec))
    missing = [c for c in spec.columns if c not in rows.columns]
    if missing:
        log.warning("%s has no column %s: loaded as NULL", location, ", ".join(missing))
    return keep_first(strict(by_name(rows, spec), spec), spec)
