"""Fixed table and document layouts.

Fixed values: column names, types, key columns and lengths are those of the
public data set and of the derived tables its users query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


TEXT, FLAG, MOMENT = T.StringType(), T.BooleanType(), T.TimestampNTZType()
SMALL, INT, LONG, NUMBER = T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()
PRICE, TOTAL, DEGREES = T.DecimalType(10, 2), T.DecimalType(20, 2), T.DecimalType(10, 6)
REVENUE = T.DecimalType(38, 2)


@dataclass(frozen=True)
class Field:
    """One raw column: its type, and the longest text it may hold (0 = any)."""

    name: str
    type: T.DataType
    max_chars: int = 0


def layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


@dataclass(frozen=True)
class TableSpec:
    """A raw table and the CSV file (or folder of part files) it is loaded from.

    ``line_breaks`` tells whether quoted fields may hold line breaks.
    """

    name: str
    file: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    drop_null_keys: bool = False
    line_breaks: bool = False

    def file_name(self, prefix: str) -> str:
        return self.file.format(prefix=prefix)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return layout(*((f.name, f.type) for f in self.fields))


def text(name: str, max_chars: int = 0) -> Field:
    return Field(name, TEXT, max_chars)


def whole(name: str) -> Field:
    return Field(name, INT)


def money(name: str) -> Field:
    return Field(name, PRICE)


def degrees(name: str) -> Field:
    return Field(name, DEGREES)


def moment(name: str) -> Field:
    return Field(name, MOMENT)


# Raw layouts.
RAW_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec(
            "customers",
            "{prefix}_customers_dataset.csv",
            (
                text("customer_id", 50),
                text("customer_unique_id", 50),
                text("customer_zip_code_prefix", 10),
                text("customer_city", 100),
                text("customer_state", 2),
            ),
            ("customer_id",),
        ),
        TableSpec(
            "sellers",
            "{prefix}_sellers_dataset.csv",
            (
                text("seller_id", 50),
                text("seller_zip_code_prefix", 10),
                text("seller_city", 100),
                text("seller_state", 2),
            ),
            ("seller_id",),
        ),
        TableSpec(
            "products",
            "{prefix}_products_dataset.csv",
            (
                text("product_id", 50),
                text("product_category_name", 100),
                whole("product_name_length"),
                whole("product_description_length"),
                whole("product_photos_qty"),
                money("product_weight_g"),
                money("product_length_cm"),
                money("product_height_cm"),
                money("product_width_cm"),
            ),
            ("product_id",),
        ),
        TableSpec(
            "category_translation",
            "product_category_name_translation.csv",
            (
                text("product_category_name", 100),
                text("product_category_name_english", 100),
            ),
            ("product_category_name",),
            drop_null_keys=True,
        ),
        TableSpec(
            "orders",
            "{prefix}_orders_dataset.csv",
            (
                text("order_id", 50),
                text("customer_id", 50),
                text("order_status", 30),
                moment("order_purchase_timestamp"),
                moment("order_approved_at"),
                moment("order_delivered_carrier_date"),
                moment("order_delivered_customer_date"),
                moment("order_estimated_delivery_date"),
            ),
            ("order_id",),
        ),
        TableSpec(
            "order_items",
            "{prefix}_order_items_dataset.csv",
            (
                text("order_id", 50),
                whole("order_item_id"),
                text("product_id", 50),
                text("seller_id", 50),
                moment("shipping_limit_date"),
                money("price"),
                money("freight_value"),
            ),
            ("order_id", "order_item_id"),
        ),
        TableSpec(
            "order_payments",
            "{prefix}_order_payments_dataset.csv",
            (
                text("order_id", 50),
                whole("payment_sequential"),
                text("payment_type", 30),
                whole("payment_installments"),
                money("payment_value"),
            ),
            ("order_id", "payment_sequential"),
        ),
        TableSpec(
            "order_reviews",
            "{prefix}_order_reviews_dataset.csv",
            (
                text("review_id", 50),
                text("order_id", 50),
                Field("review_score", SMALL),
                text("review_comment_title"),
                text("review_comment_message"),
                moment("review_creation_date"),
                moment("review_answer_timestamp"),
            ),
            ("review_id", "order_id"),
            line_breaks=True,
        ),
        TableSpec(
            "geolocation",
            "{prefix}_geolocation_dataset.csv",
            (
                text("geolocation_zip_code_prefix", 10),
                degrees("geolocation_lat"),
                degrees("geolocation_lng"),
                text("geolocation_city", 100),
                text("geolocation_state", 2),
            ),
            (),
        ),
    )
}

# Document layouts. Numbers stay exact decimals.
DOCUMENT_SCHEMAS = {
    "orders": layout(
        ("order_id", TEXT),
        ("customer_id", TEXT),
        ("customer_city", TEXT),
        ("customer_state", TEXT),
        ("order_status", TEXT),
        ("order_purchase_timestamp", MOMENT),
        ("order_delivered_customer_date", MOMENT),
        ("order_estimated_delivery_date", MOMENT),
        ("delivery_days", INT),
        ("is_delayed", FLAG),
        ("delay_days", INT),
        ("total_payment", TOTAL),
        ("item_count", LONG),
        ("avg_review_score", TOTAL),
    ),
    "products": layout(
        ("product_id", TEXT),
        ("category", TEXT),
        ("total_revenue", REVENUE),
        ("total_orders", LONG),
        ("avg_price", TOTAL),
    ),
    "sellers": layout(
        ("seller_id", TEXT),
        ("seller_city", TEXT),
        ("seller_state", TEXT),
        ("total_orders", LONG),
        ("total_revenue", REVENUE),
        ("avg_review_score", TOTAL),
        ("on_time_rate", TOTAL),
    ),
}

# Key column of every document kind and staging table.
DOCUMENT_KEYS = {"orders": "order_id", "products": "product_id", "sellers": "seller_id"}

RUN_EVENTS = layout(
    ("run_id", LONG),
    ("dag_id", TEXT),
    ("run_type", TEXT),
    ("step", INT),
    ("status", TEXT),
    ("rows_processed", LONG),
    ("at", MOMENT),
    ("error_message", TEXT),
)
