"""Inputs of the registered queries that need a before and an after, or a history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions import iso_text
from cartflow.sources.star import StarViews

#: Orders known at the first run, and orders still delivered by the second run.
KNOWN_BEFORE = "2000-01-01"
KEPT_SINCE = "1996-01-01"

#: Staging versions published so far; orders without a payment were rejected.
PUBLISHED_THROUGH = 4


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


class FirstRun:
    """Raw tables as an earlier run saw them: nothing delivered, other places."""

    def __init__(self, raw: StarViews) -> None:
        self._raw = raw

    def __getitem__(self, name: str) -> DataFrame:
        rows = self._raw[name]
        if name == "orders":
            return rows.where(F.col("order_approved_at") < _moment(KNOWN_BEFORE)).withColumns(
                {
                    "order_status": F.lit("created"),
                    "order_delivered_customer_date": F.lit(None).cast("timestamp_ntz"),
                }
            )
        if name == "order_items":
            return rows.where(F.col("shipping_limit_date") < _moment(KNOWN_BEFORE))
        if name in ("customers", "sellers"):
            city = f"{name[:-1]}_city"
            return rows.withColumn(city, F.concat(F.lit("old "), city))
        return rows


class SecondRun:
    """Raw tables of a later run, whose source no longer delivers the oldest rows."""

    def __init__(self, raw: StarViews) -> None:
        self._raw = raw

    def __getitem__(self, name: str) -> DataFrame:
        rows = self._raw[name]
        if name == "orders":
            return rows.where(F.col("order_approved_at") >= _moment(KEPT_SINCE))
        if name == "order_items":
            return rows.where(F.col("shipping_limit_date") >= _moment(KEPT_SINCE))
        return rows


def versioned(enriched: DataFrame) -> DataFrame:
    """Enriched orders written by one staging version per year of approval."""
    return enriched.withColumn("row_version", (F.year("order_approved_at") - 1994).cast("bigint"))


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("total_payment") == 0).select("order_id", "row_version")


def text_documents(raw: StarViews) -> DataFrame:
    """Order documents as text, some with words where the index wants numbers."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return raw.star("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        status.alias("order_status"),
        F.when(priority == "5-LOW", F.lit("soon")).otherwise(F.substring(priority, 1, 1)).alias("delay_days"),
        F.when(status == "P", F.lit("")).otherwise(F.col("o_totalprice").cast("decimal(10,2)").cast("string")).alias(
            "total_payment"
        ),
        iso_text(F.col("o_orderdate")).alias("order_purchase_timestamp"),
    )
