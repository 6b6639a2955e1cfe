"""Staging rows shaped as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions import iso_text
from cartflow.plans.staging import UNKNOWN_CATEGORY

ORDER_DATES = (
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def order_documents(enriched: DataFrame, iso_dates: bool = True) -> DataFrame:
    """Order documents: dates as ISO text; the approval date is not published.

    With ``iso_dates=False`` dates stay timestamps, the type the index keeps them in.
    """
    dates = {c: (iso_text(F.col(c)).alias(c) if iso_dates else F.col(c)) for c in ORDER_DATES}
    return enriched.select(
        "order_id",
        "customer_id",
        "customer_city",
        "customer_state",
        "order_status",
        *dates.values(),
        "delivery_days",
        "is_delayed",
        "delay_days",
        "total_payment",
        "item_count",
        "avg_review_score",
    )


def product_documents(revenue: DataFrame) -> DataFrame:
    name = F.col("product_category_name_english")
    return revenue.select(
        "product_id",
        F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN_CATEGORY)).alias("category"),
        "total_revenue",
        "total_orders",
        "avg_price",
    )


def seller_documents(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        "seller_city",
        "seller_state",
        "total_orders",
        "total_revenue",
        "avg_review_score",
        "on_time_rate",
    )
