"""Derived tables: enriched orders, product revenue, seller performance.

Each function maps raw tables by name to one derived
table. Every many-side input is aggregated to its join key before it is joined,
so no join multiplies rows, whatever the number of rows behind one key. Sums and
counts use types wider than a single order needs; values are otherwise as declared.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.functions import rounded_mean, rounded_percent, whole_days


class Raw(Protocol):
    """Raw tables by name."""

    def __getitem__(self, name: str) -> DataFrame: ...


ENRICHED_COLUMNS = (
    "order_id",
    "customer_id",
    "customer_city",
    "customer_state",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "delivery_days",
    "is_delayed",
    "delay_days",
    "total_payment",
    "item_count",
    "avg_review_score",
)

# Columns a repeated order overwrites; all others keep their first value.
ENRICHED_UPDATES = (
    "order_status",
    "order_delivered_customer_date",
    "delivery_days",
    "is_delayed",
    "delay_days",
    "total_payment",
    "item_count",
    "avg_review_score",
)

# A seller's place is the one of the first insert.
SELLER_UPDATES = ("total_orders", "total_revenue", "avg_review_score", "on_time_rate")

# Fixed value: category of products without a translated one.
UNKNOWN_CATEGORY = "unknown"

DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"
PURCHASED = "order_purchase_timestamp"


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment"))


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count("*").alias("item_count"))


def review_scores(reviews: DataFrame) -> DataFrame:
    """Mean of the valid scores (1 to 5) of each order."""
    valid = reviews.where(F.col("review_score").between(1, 5))
    sums = valid.groupBy("order_id").agg(
        F.sum("review_score").alias("_sum"), F.count("review_score").alias("_n")
    )
    return sums.select("order_id", rounded_mean(F.col("_sum"), F.col("_n"), 2).alias("avg_review_score"))


def is_delayed() -> Column:
    """Delivered after the estimate; an order lacking either date is not delayed."""
    return F.coalesce(F.col(DELIVERED) > F.col(ESTIMATED), F.lit(False))


def is_on_time() -> Column:
    return F.coalesce(F.col(DELIVERED) <= F.col(ESTIMATED), F.lit(False))


def orders_enriched(raw: Raw, columns: Sequence[str] = ENRICHED_COLUMNS) -> DataFrame:
    """One row per order with its customer, dates, payment, items and review score.

    Joins that only serve columns not asked for are left out: all of them are
    left joins to a unique key, so they cannot change the other columns. The customer
    join comes first; the rows then stay partitioned by order for the other joins and
    for a merge with older rows.
    """
    wanted = set(columns)
    rows = raw["orders"].where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull())
    if wanted & {"customer_city", "customer_state"}:
        customers = raw["customers"].select("customer_id", "customer_city", "customer_state")
        rows = rows.join(customers, "customer_id", "left")
    if "total_payment" in wanted:
        rows = rows.join(payment_totals(raw["order_payments"]), "order_id", "left")
    if "item_count" in wanted:
        rows = rows.join(item_counts(raw["order_items"]), "order_id", "left")
    if "avg_review_score" in wanted:
        rows = rows.join(review_scores(raw["order_reviews"]), "order_id", "left")
    derived = {
        "delivery_days": lambda: whole_days(F.col(DELIVERED), F.col(PURCHASED)),
        "is_delayed": is_delayed,
        "delay_days": lambda: whole_days(F.col(DELIVERED), F.col(ESTIMATED)),
        "total_payment": lambda: F.coalesce("total_payment", F.lit(0)).cast("decimal(20,2)"),
        "item_count": lambda: F.coalesce("item_count", F.lit(0)).cast("bigint"),
    }
    return rows.select(*[derived.get(c, lambda c=c: F.col(c))().alias(c) for c in columns])


def product_totals(items: DataFrame) -> DataFrame:
    """Revenue, distinct orders and mean price per product, before any lookup."""
    sums = (
        items.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.sum("price").alias("total_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count("price").alias("_priced"),
        )
    )
    return sums.select(
        "product_id",
        F.col("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        "total_orders",
        rounded_mean(F.col("total_revenue"), F.col("_priced"), 2, total_scale=2).alias("avg_price"),
    )


def product_revenue(raw: Raw) -> DataFrame:
    """Totals per product with its translated category.

    Category names are looked up for the products, which then meet the totals on the
    product, so totals are shuffled no further, also not by a merge with older rows.
    """
    named = (
        raw["products"]
        .select("product_id", "product_category_name")
        .join(raw["category_translation"], "product_category_name", "left")
        .select("product_id", "product_category_name_english")
    )
    category = F.coalesce("product_category_name_english", F.lit(UNKNOWN_CATEGORY))
    return (
        product_totals(raw["order_items"])
        .join(named, "product_id", "left")
        .select(
            "product_id",
            category.alias("product_category_name_english"),
            "total_revenue",
            "total_orders",
            "avg_price",
        )
    )


def review_sums(reviews: DataFrame) -> DataFrame:
    """Reviews per order: how many, how many with a score, and the score sum."""
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"),
        F.count("review_score").alias("scored"),
        F.sum("review_score").alias("score_sum"),
    )


def seller_order_facts(raw: Raw) -> DataFrame:
    """One row per (seller, order): items, revenue, review sums, on-time flag.

    Items whose order is unknown drop out. Orders and review sums are joined first
    (both unique per order); the item side is already reduced to seller and order.
    """
    sold = (
        raw["order_items"]
        .where(F.col("seller_id").isNotNull())
        .groupBy("seller_id", "order_id")
        .agg(F.count("*").alias("items"), F.sum("price").alias("revenue"))
    )
    orders = raw["orders"].select("order_id", is_on_time().alias("on_time"))
    facts = orders.join(review_sums(raw["order_reviews"]), "order_id", "left")
    return sold.join(facts, "order_id")


def _wide(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(20,0)")


def seller_performance(raw: Raw) -> DataFrame:
    """Seller totals counted over every (item, review) pair of an order.

    An order with several reviews counts each of its items once per review, in
    revenue, mean score and on-time deliveries alike, while the rate divides by
    distinct orders. The pairs are counted by multiplying, never built, and go straight
    to the seller's totals, map side first.
    """
    pairs = F.coalesce(_wide("reviews"), _wide(F.lit(1)))
    totals = seller_order_facts(raw).groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.sum(F.col("revenue") * pairs).cast("decimal(38,2)").alias("total_revenue"),
        F.sum(_wide("score_sum") * _wide("items")).alias("_score"),
        F.sum(_wide("scored") * _wide("items")).alias("_scored"),
        F.sum(F.when(F.col("on_time"), _wide("items") * pairs).otherwise(F.lit(0))).alias("_on_time"),
    )
    return _with_seller(raw, totals)


def seller_performance_order_grain(raw: Raw) -> DataFrame:
    """Seller totals with every order and every review counted once."""
    totals = (
        seller_order_facts(raw)
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
            F.sum("score_sum").alias("_score"),
            F.sum("scored").alias("_scored"),
            F.count_if("on_time").alias("_on_time"),
        )
    )
    return _with_seller(raw, totals)


def _with_seller(raw: Raw, totals: DataFrame) -> DataFrame:
    sellers = raw["sellers"].select("seller_id", "seller_city", "seller_state")
    return sellers.join(totals, "seller_id").select(
        "seller_id",
        "seller_city",
        "seller_state",
        "total_orders",
        "total_revenue",
        rounded_mean(F.col("_score"), F.col("_scored"), 2).alias("avg_review_score"),
        rounded_percent(F.col("_on_time"), F.col("total_orders")).alias("on_time_rate"),
    )
