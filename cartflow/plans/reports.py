"""Reports over the derived tables.

Ascending sorts put NULL last and descending ones put it first; every limited
sort ends with the key, so ties fall the same way on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.functions import month_of, rounded_mean, rounded_percent, to_whole, whole_seconds

# Lengths of the limited reports.
TOP_N = 10
RUN_HISTORY_N = 20


def _up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def monthly_order_volume(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month_of(F.col("order_purchase_timestamp")).alias("month"))
        .agg(
            F.count("*").alias("order_count"),
            F.sum("total_payment").cast("decimal(38,2)").alias("total_revenue"),
        )
        .orderBy(_up("month"))
    )


def order_status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status and their share.

    The total is a one-value sub-query over the counts, whose shuffle it shares, so
    the counts never gather in one task.
    """
    counts = orders.groupBy("order_status").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return (
        counts.withColumn("_total", total)
        .select("order_status", "count", rounded_percent(F.col("count"), F.col("_total")).alias("pct"))
        .orderBy(_down("count"), _up("order_status"))
    )


def top_categories(revenue: DataFrame, n: int = TOP_N) -> DataFrame:
    return (
        revenue.groupBy(F.col("product_category_name_english").alias("category"))
        .agg(F.sum("total_revenue").alias("revenue"), F.sum("total_orders").alias("orders"))
        .orderBy(_down("revenue"), _up("category"))
        .limit(n)
    )


def avg_delivery_by_state(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("delivery_days").isNotNull())
        .groupBy("customer_state")
        .agg(F.sum("delivery_days").alias("_days"), F.count("*").alias("delivered_orders"))
        .select(
            "customer_state",
            rounded_mean(F.col("_days"), F.col("delivered_orders"), 1).alias("avg_delivery_days"),
            "delivered_orders",
        )
        .orderBy(_up("avg_delivery_days"), _up("customer_state"))
    )


def _delay_rate(orders: DataFrame, *by: str) -> DataFrame:
    delivered = orders.where(F.col("order_delivered_customer_date").isNotNull())
    counts = delivered.groupBy(*by).agg(
        F.count("*").alias("total_orders"), F.count_if("is_delayed").alias("delayed_orders")
    )
    rate = rounded_percent(F.col("delayed_orders"), F.col("total_orders"))
    return counts.select(*by, "total_orders", "delayed_orders", rate.alias("delay_rate_pct"))


def delay_rate_by_state(orders: DataFrame) -> DataFrame:
    return _delay_rate(orders, "customer_state").orderBy(_down("delay_rate_pct"), _up("customer_state"))


def delay_rate_overall(orders: DataFrame) -> DataFrame:
    return _delay_rate(orders)


def review_score_distribution(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("avg_review_score").isNotNull())
        .groupBy(to_whole(F.col("avg_review_score")).alias("score"))
        .agg(F.count("*").alias("order_count"))
        .orderBy(_up("score"))
    )


def top_sellers(sellers: DataFrame, n: int = TOP_N) -> DataFrame:
    return (
        sellers.select("seller_id", "seller_state", "total_revenue", "total_orders", "on_time_rate")
        .orderBy(_down("total_revenue"), _up("seller_id"))
        .limit(n)
    )


def run_history(runs: DataFrame, n: int = RUN_HISTORY_N) -> DataFrame:
    return (
        runs.orderBy(_down("started_at"), _down("run_id"))
        .limit(n)
        .select(
            "run_id",
            "dag_id",
            "run_type",
            "status",
            "rows_processed",
            whole_seconds(F.col("finished_at"), F.col("started_at")).alias("duration_sec"),
            "started_at",
        )
    )
