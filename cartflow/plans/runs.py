"""Run ledger state and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how many latest runs the failure check looks at.
RECENT_RUNS = 5


def run_state(events: DataFrame) -> DataFrame:
    """One row per run from its start event and, if there is one, its finish event."""
    start, last = F.col("step") == 0, F.col("step")
    return (
        events.groupBy("run_id")
        .agg(
            F.max(F.when(start, F.col("dag_id"))).alias("dag_id"),
            F.max(F.when(start, F.col("run_type"))).alias("run_type"),
            F.max_by(F.struct("status", "rows_processed", "error_message"), last).alias("_last"),
            F.min(F.when(start, F.col("at"))).alias("started_at"),
            F.max(F.when(~start, F.col("at"))).alias("finished_at"),
        )
        .select(
            "run_id",
            "dag_id",
            "run_type",
            "_last.status",
            "_last.rows_processed",
            "started_at",
            "finished_at",
            "_last.error_message",
        )
    )


def recent_runs(runs: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    return (
        runs.orderBy(F.col("started_at").desc_nulls_first(), F.col("run_id").desc())
        .limit(n)
        .select("run_id", "run_type", "status", "rows_processed", "started_at")
    )


def recent_failed_runs(runs: DataFrame, n: int = RECENT_RUNS) -> DataFrame:
    """Failed runs among the last ``n``: the limit comes before the filter."""
    return recent_runs(runs, n).where(F.col("status") == "failed")


def health_checks(raw_orders: DataFrame, order_documents: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per check: its name, the counted value, and whether it passed."""

    def check(rows: DataFrame, name: str, ok) -> DataFrame:
        counted = rows.agg(F.count("*").alias("value"))
        return counted.select(F.lit(name).alias("check_name"), "value", ok(F.col("value")).alias("ok"))

    return (
        check(raw_orders, "raw_orders_present", lambda n: n > 0)
        .unionByName(check(order_documents, "order_documents_counted", lambda n: F.lit(True)))
        .unionByName(check(recent_failed_runs(runs), "no_recent_failed_runs", lambda n: n == 0))
    )
