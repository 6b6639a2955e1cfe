"""Chart data, read from published documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions import month_of
from cartflow.plans import reports


def in_time_range(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Orders bought from ``start`` up to and including ``end``."""
    bought = F.col("order_purchase_timestamp")
    return orders.where(
        bought.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    )


def monthly_orders(orders: DataFrame) -> DataFrame:
    month = month_of(F.col("order_purchase_timestamp")).alias("month")
    return (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month)
        .agg(F.count("*").alias("order_count"))
        .orderBy("month")
    )


def revenue_by_category(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(F.sum("total_revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_first(), "category")
    )


def delivery_days_by_state(orders: DataFrame) -> DataFrame:
    return reports.avg_delivery_by_state(orders)


def delay_rate_by_state(orders: DataFrame) -> DataFrame:
    return reports.delay_rate_by_state(orders)
