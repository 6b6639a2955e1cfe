"""Order-shaped raw tables derived from a star schema of Parquet files.

The star tables (customer, supplier, part, orders, lineitem, events, nation) hold
the same business facts under other names. Every view below covers the whole
table it is derived from. Gaps the rules must handle are made from ordinary
attributes: guest orders have a customer nobody registered, pending orders have
no delivery date, some parts have no brand, one brand has no translation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.operators.dedup import COPIES, first_per_key
from cartflow.schemas import INT, LONG, MOMENT, NUMBER, TEXT, layout

# The star tables. Stated so that opening a table needs no job.
STAR_TABLES = {
    "nation": layout(("n_nationkey", INT), ("n_name", TEXT), ("n_regionkey", INT)),
    "customer": layout(
        ("c_custkey", LONG),
        ("c_name", TEXT),
        ("c_nationkey", INT),
        ("c_acctbal", NUMBER),
        ("c_mktsegment", TEXT),
    ),
    "supplier": layout(("s_suppkey", LONG), ("s_name", TEXT), ("s_nationkey", INT), ("s_acctbal", NUMBER)),
    "part": layout(
        ("p_partkey", LONG),
        ("p_name", TEXT),
        ("p_brand", TEXT),
        ("p_type", TEXT),
        ("p_size", INT),
        ("p_retailprice", NUMBER),
    ),
    "orders": layout(
        ("o_orderkey", LONG),
        ("o_custkey", LONG),
        ("o_orderstatus", TEXT),
        ("o_totalprice", NUMBER),
        ("o_orderdate", MOMENT),
        ("o_orderpriority", TEXT),
    ),
    "lineitem": layout(
        ("l_orderkey", LONG),
        ("l_partkey", LONG),
        ("l_suppkey", LONG),
        ("l_linenumber", INT),
        ("l_quantity", NUMBER),
        ("l_extendedprice", NUMBER),
        ("l_discount", NUMBER),
        ("l_tax", NUMBER),
        ("l_returnflag", TEXT),
        ("l_linestatus", TEXT),
        ("l_shipdate", MOMENT),
    ),
    "events": layout(
        ("event_id", LONG),
        ("ts", MOMENT),
        ("user_id", LONG),
        ("event_type", TEXT),
        ("value", NUMBER),
        ("props", TEXT),
    ),
    "documents": layout(
        ("doc_id", LONG), ("text", TEXT), ("lang", TEXT), ("source", TEXT), ("n_chars", LONG)
    ),
}

GUEST = -1
NO_BRAND_SIZE = 50
UNTRANSLATED_BRAND = "Brand#7"
ITEM_ORDER = ("product_id", "seller_id", "price", "shipping_limit_date", "freight_value")


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _cents(name: str) -> Column:
    return F.col(name).cast("decimal(10,2)")


class StarViews(Mapping[str, DataFrame]):
    """Raw tables by name, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir
        self._views: dict[str, Callable[[], DataFrame]] = {
            "customers": self._customers,
            "sellers": self._sellers,
            "products": self._products,
            "translation_rows": self._translation_rows,
            "category_translation": self._category_translation,
            "orders": self._orders,
            "order_items": self._order_items,
            "order_payments": self._order_payments,
            "order_reviews": self._order_reviews,
            "run_events": self._run_events,
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self._views[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._views)

    def __len__(self) -> int:
        return len(self._views)

    def star(self, table: str) -> DataFrame:
        return self._spark.read.schema(STAR_TABLES[table]).parquet(f"{self._dir}/{table}.parquet")

    def _nations(self, key: str) -> DataFrame:
        return self.star("nation").select(F.col("n_nationkey").alias(key), "n_name")

    def _customers(self) -> DataFrame:
        rows = self.star("customer").join(self._nations("c_nationkey"), "c_nationkey")
        return rows.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    def _sellers(self) -> DataFrame:
        rows = self.star("supplier").join(self._nations("s_nationkey"), "s_nationkey")
        return rows.select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )

    def _products(self) -> DataFrame:
        brand = F.when(F.col("p_size") != NO_BRAND_SIZE, F.col("p_brand"))
        return self.star("part").select(
            F.col("p_partkey").alias("product_id"),
            brand.alias("product_category_name"),
            F.col("p_name").alias("product_name"),
        )

    def _translation_rows(self) -> DataFrame:
        """One row per part as a file might hold it; one brand's key is missing."""
        brand = F.col("p_brand")
        return self.star("part").select(
            F.when(brand != UNTRANSLATED_BRAND, brand).alias("product_category_name"),
            F.lower(brand).alias("product_category_name_english"),
        )

    def _category_translation(self) -> DataFrame:
        rows = self._translation_rows().where(F.col("product_category_name").isNotNull())
        return first_per_key(
            rows, ["product_category_name"], ["product_category_name_english"]
        ).drop(COPIES)

    def _orders(self) -> DataFrame:
        key, price = F.col("o_orderkey"), F.col("o_totalprice")
        status, priority, placed = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
        guest = (status == "P") & (priority == "5-LOW")
        waiting = (status == "P") & (priority == "4-NOT SPECIFIED")
        return self.star("orders").select(
            key.alias("order_id"),
            F.when(price < 2000, F.lit(None))
            .when(guest, F.lit(GUEST).cast("bigint"))
            .otherwise(F.col("o_custkey"))
            .alias("customer_id"),
            status.alias("order_status"),
            F.when((price < 2500) | (price >= 3000), placed + _hours(key % 24)).alias(
                "order_purchase_timestamp"
            ),
            (placed + _hours(key % 24 + key % 7)).alias("order_approved_at"),
            F.when(~waiting, placed + _days(key * 7 % 40) + _hours(key % 23)).alias(
                "order_delivered_customer_date"
            ),
            F.when(price < 495000, placed + _days(F.substring(priority, 1, 1).cast("int") * 6)).alias(
                "order_estimated_delivery_date"
            ),
        )

    def _order_items(self) -> DataFrame:
        """Every row is an item; as file rows they repeat some (order, item) numbers."""
        return self.star("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_quantity") != 1, F.col("l_suppkey")).alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            _cents("l_extendedprice").alias("price"),
            _cents("l_quantity").alias("freight_value"),
        )

    def _order_payments(self) -> DataFrame:
        """A card payment unless pending and unpaid, and a voucher for urgent orders."""
        unpaid = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "3-MEDIUM")
        urgent = F.col("o_orderpriority") == "1-URGENT"

        def payment(number: int, kind: str, value: Column) -> Column:
            return F.struct(
                F.lit(number).alias("payment_sequential"),
                F.lit(kind).alias("payment_type"),
                value.cast("decimal(10,2)").alias("payment_value"),
            )

        card = payment(1, "credit_card", F.col("o_totalprice"))
        voucher = payment(2, "voucher", F.lit("12.34"))
        paid = F.array_compact(F.array(F.when(~unpaid, card), F.when(urgent, voucher)))
        return self.star("orders").select(F.col("o_orderkey").alias("order_id"), F.inline(paid))

    def _order_reviews(self) -> DataFrame:
        """Buyers and viewers review their own order, all others one of a few hot orders."""
        own = F.col("event_type").isin("purchase", "view")
        scored = F.col("event_type") != "error"
        return self.star("events").select(
            F.col("event_id").alias("review_id"),
            F.when(own, F.col("event_id")).otherwise(F.col("user_id")).alias("order_id"),
            F.when(scored, F.col("event_id") % 7).cast("smallint").alias("review_score"),
            F.col("ts").alias("review_creation_date"),
        )

    def _run_events(self) -> DataFrame:
        """Every event as a job run: signups are still running; errors and runs that ended within 15 seconds have failed."""
        kind = F.col("event_type")
        seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))

        def step(number: int, status: Column, rows: Column, at: Column, error: Column) -> Column:
            return F.struct(
                F.lit(number).alias("step"),
                status.alias("status"),
                rows.cast("bigint").alias("rows_processed"),
                at.alias("at"),
                error.cast("string").alias("error_message"),
            )

        none = F.lit(None)
        failed = (kind == "error") | (F.col("value") < 15)
        started = step(0, F.lit("running"), F.lit(0), F.col("ts"), none)
        finished = step(
            1,
            F.when(failed, F.lit("failed")).otherwise(F.lit("success")),
            F.col("user_id"),
            F.col("ts") + seconds,
            F.when(failed, F.col("props")),
        )
        steps = F.array_compact(F.array(started, F.when(kind != "signup", finished)))
        return self.star("events").select(
            F.col("event_id").alias("run_id"),
            F.lit("star").alias("dag_id"),
            kind.alias("run_type"),
            F.inline(steps),
        )
