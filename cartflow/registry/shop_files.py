"""The star tables written as the CSV files the load job expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.sources.star import ITEM_ORDER, StarViews

CSV_OUT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

#: Written files are compressed. Spark reads such a file in one task, so none holds more rows than these.
FILE_ROWS = 1_000_000


def item_rows(raw: StarViews) -> DataFrame:
    """Item rows in the order that says which copy of a key is the first."""
    return raw["order_items"].orderBy("order_id", "order_item_id", *ITEM_ORDER)


def short_state(rows: DataFrame, column: str) -> DataFrame:
    """States as two characters at most, as the raw tables declare them."""
    return rows.withColumn(column, F.replace(F.col(column), F.lit("NATION_"), F.lit("")))


def geolocation_rows(raw: StarViews) -> DataFrame:
    """A place for every customer, with many copies, as there is no key."""
    customers = short_state(raw["customers"], "customer_state")
    place = F.col("customer_id") % 10
    return customers.select(
        place.cast("string").alias("geolocation_zip_code_prefix"),
        (place.cast("decimal(10,6)") / 8).cast("decimal(10,6)").alias("geolocation_lat"),
        (-place).cast("decimal(10,6)").alias("geolocation_lng"),
        F.col("customer_city").alias("geolocation_city"),
        F.col("customer_state").alias("geolocation_state"),
    )


def write_lines(lines: DataFrame, header: str, path: str, parts: int = 4) -> None:
    """The one column of ``lines`` as it is, below ``header`` in each of ``parts`` text files."""
    rows = lines.toDF("value").select("value", F.pmod(F.xxhash64("value"), F.lit(parts)).alias("part"), F.lit(1).alias("rank"))
    heads = lines.sparkSession.range(parts).select(F.lit(header).alias("value"), F.col("id").alias("part"), F.lit(0).alias("rank"))
    ordered = rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "rank")
    ordered.select("value", "part").write.partitionBy("part").text(path)


def write_shop_files(spark: SparkSession, raw: StarViews, folder: str) -> None:
    """One folder of CSV part files per raw table."""
    tables = {
        "shop_customers_dataset.csv": short_state(raw["customers"], "customer_state"),
        "shop_sellers_dataset.csv": short_state(raw["sellers"], "seller_state"),
        "shop_products_dataset.csv": raw["products"],
        "product_category_name_translation.csv": raw["translation_rows"],
        "shop_orders_dataset.csv": raw["orders"],
        "shop_order_items_dataset.csv": item_rows(raw),
        "shop_order_payments_dataset.csv": raw["order_payments"],
        "shop_order_reviews_dataset.csv": raw["order_reviews"],
        "shop_geolocation_dataset.csv": geolocation_rows(raw),
    }
    for name, rows in tables.items():
        moments = [c for c, kind in rows.dtypes if kind == "timestamp_ntz"]
        text = rows.withColumns({c: F.col(c).cast("string") for c in moments}) if moments else rows
        text.write.options(**CSV_OUT, compression="gzip", maxRecordsPerFile=FILE_ROWS).csv(f"{folder}/{name}")
