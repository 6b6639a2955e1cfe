"""Which staging rows are published.

Staging rows carry ``row_version``, the table version that last wrote them. The
sync state is the highest version published (of a bucket, where buckets are published on their own) plus the rows
rejected on the way, so neither the gate nor the selection has to join with everything ever published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_ID = ("order_id", "row_version")


def unsynced(
    rows: DataFrame, through: int | Column | None, rejected: DataFrame | None, row_id: Sequence[str] = ROW_ID
) -> DataFrame:
    """Rows written after version ``through``, and older rows that were rejected."""
    if through is None:
        return rows
    newer = rows.where(F.col("row_version") > through)
    if rejected is None:
        return newer
    return newer.unionByName(rejected_rows(rows, through, rejected, row_id))


def rejected_rows(rows: DataFrame, through: int | Column, rejected: DataFrame, row_id: Sequence[str] = ROW_ID) -> DataFrame:
    """Rows up to version ``through`` that were rejected."""
    older = rows.where(F.col("row_version") <= through)
    return older.join(rejected.select(*row_id), list(row_id), "left_semi")


def with_sync_flag(
    rows: DataFrame, through: int | Column | None, rejected: DataFrame | None, row_id: Sequence[str] = ROW_ID
) -> DataFrame:
    """All rows with ``synced_to_es``: published up to ``through`` and not rejected."""
    if through is None:
        return rows.withColumn("synced_to_es", F.lit(False))
    published = F.col("row_version") <= through
    if rejected is None:
        return rows.withColumn("synced_to_es", published)
    failed = rejected.select(*row_id).withColumn("_failed", F.lit(True))
    flagged = rows.join(failed, list(row_id), "left")
    return flagged.withColumn("synced_to_es", published & F.col("_failed").isNull()).drop("_failed")
