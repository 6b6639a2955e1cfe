"""Registered queries: one per operator or data set, over the star tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow import jobs, ledger
from cartflow.functions import rounded_mean, rounded_ratio, whole_days, whole_seconds
from cartflow.operators.conform import by_name, strict
from cartflow.operators.dedup import first_per_key
from cartflow.operators.sync_state import unsynced, with_sync_flag
from cartflow.operators.upsert import upsert
from cartflow.plans import charts, documents, reports, runs, staging
from cartflow.registry import scenarios
from cartflow.registry.shop_files import CSV_OUT, geolocation_rows, item_rows, write_lines, write_shop_files
from cartflow.schemas import DOCUMENT_KEYS, DOCUMENT_SCHEMAS, RAW_TABLES
from cartflow.settings import Settings, scratch_path
from cartflow.sources.documents import (
    ensure_index,
    index_count,
    index_table,
    split_documents,
    upsert_documents,
)
from cartflow.sources.keyed import read_pattern
from cartflow.sources.raw_tables import load_table
from cartflow.sources.star import ITEM_ORDER, StarViews
from cartflow.sources.versioned import VersionedTable
from cartflow.streaming.orders import publish_orders_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and small ints as ints, as the comparison engine has them."""
    casts = {T.DecimalType: "double", T.ShortType: "int"}
    return rows.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


def query(build: Callable[[StarViews], DataFrame]) -> Callable[[StarViews], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(StarViews(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


def with_spark(build: Callable[[SparkSession, StarViews], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spark, StarViews(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


def _enriched(raw: StarViews, *columns: str) -> DataFrame:
    return staging.orders_enriched(raw, columns or staging.ENRICHED_COLUMNS)


# --- derived tables and reports -------------------------------------------------


@query
def orders_enriched(raw):
    return _enriched(raw)


@query
def product_revenue(raw):
    return staging.product_revenue(raw)


@query
def seller_performance(raw):
    return staging.seller_performance(raw)


@query
def seller_performance_order_grain(raw):
    return staging.seller_performance_order_grain(raw)


@query
def monthly_order_volume(raw):
    return reports.monthly_order_volume(_enriched(raw, "order_purchase_timestamp", "total_payment"))


@query
def order_status_distribution(raw):
    return reports.order_status_distribution(_enriched(raw, "order_status"))


@query
def top_categories(raw):
    return reports.top_categories(staging.product_revenue(raw))


@query
def avg_delivery_by_state(raw):
    return reports.avg_delivery_by_state(_enriched(raw, "customer_state", "delivery_days"))


@query
def delay_rate_by_state(raw):
    return reports.delay_rate_by_state(
        _enriched(raw, "customer_state", "order_delivered_customer_date", "is_delayed")
    )


@query
def delay_rate_overall(raw):
    return reports.delay_rate_overall(_enriched(raw, "order_delivered_customer_date", "is_delayed"))


@query
def review_score_distribution(raw):
    return reports.review_score_distribution(_enriched(raw, "avg_review_score"))


@query
def top_sellers(raw):
    return reports.top_sellers(staging.seller_performance(raw))


@query
def run_history(raw):
    return reports.run_history(runs.run_state(raw["run_events"]))


# --- charts, over documents -----------------------------------------------------


def _order_docs(raw: StarViews, *columns: str) -> DataFrame:
    docs = documents.order_documents(_enriched(raw), iso_dates=False)
    return docs.select(*columns)


def _published(spark: SparkSession, kind: str, docs: DataFrame) -> DataFrame:
    """Documents published into an index of their own, read back from it."""
    path = scratch_path(spark, f"{kind}-chart-index")
    upsert_documents(spark, docs, path, DOCUMENT_SCHEMAS[kind], DOCUMENT_KEYS[kind])
    return index_table(spark, path).read()


def _published_orders(spark: SparkSession, raw: StarViews) -> DataFrame:
    return _published(spark, "orders", documents.order_documents(_enriched(raw), iso_dates=False))


@with_spark
def chart_monthly_orders(spark, raw):
    return charts.monthly_orders(_published_orders(spark, raw))


@with_spark
def chart_revenue_by_category(spark, raw):
    docs = documents.product_documents(staging.product_revenue(raw))
    return charts.revenue_by_category(_published(spark, "products", docs))


@with_spark
def chart_delivery_days_by_state(spark, raw):
    return charts.delivery_days_by_state(_published_orders(spark, raw))


@with_spark
def chart_delay_rate_by_state(spark, raw):
    return charts.delay_rate_by_state(_published_orders(spark, raw))


@with_spark
def orders_in_time_range(spark, raw):
    docs = charts.in_time_range(_published_orders(spark, raw), "1996-01-01", "1998-12-31")
    return docs.select(F.col("_id").cast("bigint").alias("order_id"), "order_purchase_timestamp", "order_status")


@with_spark
def index_pattern_read(spark, raw):
    """Products published into two indices and sellers into a third; the first two read by their common name."""
    folder = scratch_path(spark, "pattern")
    products = documents.product_documents(staging.product_revenue(raw))
    even = F.col("product_id") % 2 == 0
    for name, kind, docs in (
        ("shop_products_even", "products", products.where(even)),
        ("shop_products_odd", "products", products.where(~even).drop("avg_price")),
        ("shop_sellers", "sellers", documents.seller_documents(staging.seller_performance(raw))),
    ):
        upsert_documents(spark, docs, f"{folder}/{name}", DOCUMENT_SCHEMAS[kind], DOCUMENT_KEYS[kind])
    found = read_pattern(spark, folder, "shop_products*", "_id")
    found = found.where(~F.col("_index").endswith("_rejects"))
    return found.select("_index", "_id", "category", "total_orders", "avg_price")


# --- scans, load rules ------------------------------------------------------------


@query
def scan_orders_projection(raw):
    return raw["orders"].select(
        "order_id", "customer_id", F.col("order_status").alias("status"), "order_purchase_timestamp"
    )


def _item_files(spark: SparkSession, raw: StarViews) -> str:
    path = scratch_path(spark, "items-csv")
    item_rows(raw).write.options(**CSV_OUT).csv(path)
    return path


@with_spark
def csv_load_order_items(spark, raw):
    return load_table(spark, RAW_TABLES["order_items"], _item_files(spark, raw))


@with_spark
def csv_load_multiline_text(spark, raw):
    """Whole documents as review texts; their line breaks lie inside quotes."""
    path = scratch_path(spark, "reviews-csv")
    docs = raw.star("documents")
    rows = docs.select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        (F.length("text") % 5 + 1).alias("review_score"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
    )
    rows.write.options(**CSV_OUT, quoteAll=True).csv(path)
    loaded = load_table(spark, RAW_TABLES["order_reviews"], path)
    return loaded.select("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message")


@with_spark
def csv_bom_and_ragged_rows(spark, raw):
    """Customers in lines with a byte order mark, too few or too many fields, and empty lines between them."""
    path = scratch_path(spark, "ragged-csv")
    key, city, state = F.col("customer_id").cast("string"), F.col("customer_city"), F.lit("XX")
    full = F.concat_ws(",", key, city, state)
    line = (
        F.when(F.col("customer_id") % 4 == 0, key)
        .when(F.col("customer_id") % 4 == 1, F.concat(full, F.lit(",more,and more")))
        .when(F.col("customer_id") % 4 == 2, F.concat(full, F.lit("\n")))
        .otherwise(full)
    )
    write_lines(raw["customers"].select(line), "\ufeffcustomer_id,customer_city,customer_state", path)
    return load_table(spark, RAW_TABLES["customers"], path).select("customer_id", "customer_city", "customer_state")


@with_spark
def csv_literal_quotes(spark, raw):
    """Part names behind literal quotes, and quoted with line breaks and doubled quotes; no row is lost."""
    path = scratch_path(spark, "quotes-csv")
    key, name = F.col("product_id").cast("string"), F.col("product_name")
    title = F.concat(name, F.lit(' 5" wide'))
    message = F.concat(F.lit('"'), name, F.lit('\n\nsays ""hi, you""\n"'))
    message = F.when(F.col("product_id") % 3 == 0, name).when(F.col("product_id") % 3 == 1, message).otherwise('7"')
    line = F.concat_ws(",", key, key, (F.col("product_id") % 5).cast("string"), title, message)
    header = "review_id,order_id,review_score,review_comment_title,review_comment_message"
    write_lines(raw["products"].select(line), header, path)
    loaded = load_table(spark, RAW_TABLES["order_reviews"], path)
    return loaded.select("review_id", "review_score", "review_comment_title", "review_comment_message")


@with_spark
def load_geolocation(spark, raw):
    """The table without a key: all rows are kept, copies too."""
    path = scratch_path(spark, "geolocation-csv")
    geolocation_rows(raw).write.options(**CSV_OUT).csv(path)
    loaded = load_table(spark, RAW_TABLES["geolocation"], path)
    return loaded.groupBy("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state").agg(
        F.count("*").alias("rows"), F.sum("geolocation_lat").cast("double").alias("lat"), F.sum("load_copies").alias("read")
    )


@with_spark
def load_misfits_fail(spark, raw):
    """States longer than two characters, missing keys and words for numbers each fail the load of the table."""
    states = raw["sellers"].selectExpr("cast(seller_id as string) seller_id", "seller_state")
    keys = raw["sellers"].selectExpr("cast(null as string) seller_id", "'SP' seller_state")
    numbers = raw["products"].selectExpr("cast(product_id as string) product_id", "product_name product_photos_qty")
    outcomes = []
    for name, table, rows in (("length", "sellers", states), ("key", "sellers", keys), ("number", "products", numbers)):
        spec = RAW_TABLES[table]
        try:
            strict(by_name(rows, spec), spec).write.format("noop").mode("overwrite").save()
            outcomes.append((name, False))
        except Exception as error:
            outcomes.append((name, table in str(error)))
    return spark.createDataFrame(outcomes, "misfit string, failed boolean")


@query
def csv_empty_to_null(raw):
    """Empty text is NULL; a declared column that is not there is NULL too."""
    spec = RAW_TABLES["customers"]
    rows = raw["customers"].select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.when(F.col("customer_city") == "BUILDING", "").otherwise(F.col("customer_city")).alias("customer_city"),
        F.lit("x").alias("not_declared"),
    )
    return by_name(rows, spec)


@query
def load_translation_skip_null_key(raw):
    spec = RAW_TABLES["category_translation"]
    rows = strict(by_name(raw["translation_rows"], spec), spec)
    return first_per_key(rows, spec.key, ["product_category_name_english"])


@query
def load_typed_order_items(raw):
    """Item rows as text, cast back by the declared types."""
    spec = RAW_TABLES["order_items"]
    rows = raw["order_items"]
    return strict(by_name(rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]), spec), spec)


@query
def dedup_first_by_key(raw):
    return first_per_key(raw["order_items"], ["order_id", "order_item_id"], ITEM_ORDER)


# --- filters ----------------------------------------------------------------------


@query
def filter_not_null_keys(raw):
    orders = raw["orders"].where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull())
    return orders.select("order_id", "customer_id")


@query
def filter_review_score_range(raw):
    reviews = raw["order_reviews"]
    return reviews.where(F.col("review_score").between(1, 5)).select("review_id", "order_id", "review_score")


@query
def delay_flags(raw):
    return raw["orders"].select(
        "order_id", staging.is_delayed().alias("is_delayed"), staging.is_on_time().alias("is_on_time")
    )


# --- joins ------------------------------------------------------------------------


@query
def join_orders_customers_left(raw):
    return _enriched(raw, "order_id", "customer_id", "customer_city", "customer_state")


@query
def join_payment_totals(raw):
    orders = raw["orders"].select("order_id")
    return orders.join(staging.payment_totals(raw["order_payments"]), "order_id", "left")


@query
def join_item_counts(raw):
    orders = raw["orders"].select("order_id")
    return orders.join(staging.item_counts(raw["order_items"]), "order_id", "left")


@query
def join_review_scores(raw):
    orders = raw["orders"].select("order_id")
    return orders.join(staging.review_scores(raw["order_reviews"]), "order_id", "left")


@query
def join_items_products_left(raw):
    items = raw["order_items"].select("order_id", "order_item_id", "product_id")
    products = raw["products"].select("product_id", "product_category_name")
    return items.join(products, "product_id", "left")


@query
def join_translation_left(raw):
    products = raw["products"].select("product_id", "product_category_name")
    return products.join(raw["category_translation"], "product_category_name", "left")


@query
def join_sellers_items_inner(raw):
    items = raw["order_items"].select("order_id", "order_item_id", "seller_id")
    return items.join(raw["sellers"], "seller_id")


@query
def join_items_orders_inner(raw):
    items = raw["order_items"].select("order_id", "order_item_id")
    return items.join(raw["orders"].select("order_id", "order_status"), "order_id")


@query
def join_reviews_fanout(raw):
    """Rows the (item, review) join has per order, counted without building them."""
    items = staging.item_counts(raw["order_items"])
    reviews = staging.review_sums(raw["order_reviews"]).select("order_id", "reviews")
    pairs = F.col("item_count") * F.coalesce("reviews", F.lit(1))
    return items.join(reviews, "order_id", "left").select("order_id", pairs.alias("joined_rows"))


# --- aggregates and functions -------------------------------------------------------


@query
def agg_item_count(raw):
    return staging.item_counts(raw["order_items"])


@query
def count_orders(raw):
    return raw["orders"].agg(F.count("*").alias("cnt"))


@query
def agg_payment_total(raw):
    return staging.payment_totals(raw["order_payments"])


@query
def agg_avg_review(raw):
    return staging.review_scores(raw["order_reviews"])


@query
def agg_avg_price(raw):
    return staging.product_totals(raw["order_items"]).select("product_id", "avg_price")


@query
def agg_distinct_orders(raw):
    return staging.product_totals(raw["order_items"]).select("product_id", "total_orders")


@query
def agg_on_time(raw):
    flagged = raw["orders"].select("order_status", staging.is_on_time().alias("on_time"))
    return flagged.groupBy("order_status").agg(
        F.count_if("on_time").alias("on_time_orders"), F.count("*").alias("orders")
    )


@query
def agg_delayed(raw):
    flagged = raw["orders"].select("customer_id", staging.is_delayed().alias("late"))
    return flagged.groupBy("customer_id").agg(
        F.count_if("late").alias("delayed_orders"), F.count("*").alias("orders")
    )


@query
def delivery_days(raw):
    days = whole_days(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))
    return raw["orders"].select("order_id", days.alias("delivery_days"))


@query
def delay_days(raw):
    days = whole_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return raw["orders"].select("order_id", days.alias("delay_days"))


@query
def round_ratio(raw):
    sums = raw["order_items"].groupBy("product_id").agg(
        F.sum("price").alias("total"), F.count("*").alias("n"), F.sum("freight_value").alias("freight")
    )
    return sums.select(
        "product_id",
        rounded_mean(F.col("total"), F.col("n"), 2, total_scale=2).alias("mean_price"),
        rounded_ratio(F.col("n") * 100, F.col("freight"), 1).alias("items_per_100_freight"),
        rounded_ratio(F.col("n") * 1000, F.col("total"), 4, den_scale=2).alias("items_per_1000_spent"),
    )


@query
def run_duration(raw):
    state = runs.run_state(raw["run_events"])
    return state.select(
        "run_id", whole_seconds(F.col("finished_at"), F.col("started_at")).alias("duration_sec")
    )


# --- upserts ------------------------------------------------------------------------


@query
def upsert_orders_enriched(raw):
    old = staging.orders_enriched(scenarios.FirstRun(raw))
    new = staging.orders_enriched(scenarios.SecondRun(raw))
    return upsert(old, new, "order_id", staging.ENRICHED_UPDATES)


@query
def upsert_product_revenue(raw):
    old = staging.product_revenue(scenarios.FirstRun(raw))
    new = staging.product_revenue(scenarios.SecondRun(raw))
    return upsert(old, new, "product_id")


@query
def upsert_seller_performance(raw):
    old = staging.seller_performance(scenarios.FirstRun(raw))
    new = staging.seller_performance(scenarios.SecondRun(raw))
    return upsert(old, new, "seller_id", staging.SELLER_UPDATES)


# --- publication --------------------------------------------------------------------


@query
def order_documents(raw):
    return documents.order_documents(_enriched(raw))


@query
def product_documents(raw):
    return documents.product_documents(staging.product_revenue(raw))


@query
def seller_documents(raw):
    return documents.seller_documents(staging.seller_performance(raw))


@with_spark
def doc_sink_orders(spark, raw):
    """Two publications into one index: the second replaces whole documents."""
    path = scratch_path(spark, "orders-index")
    mapping = DOCUMENT_SCHEMAS["orders"]
    for run in (scenarios.FirstRun(raw), scenarios.SecondRun(raw)):
        docs = documents.order_documents(staging.orders_enriched(run), iso_dates=False)
        upsert_documents(spark, docs, path, mapping, "order_id")
    return index_table(spark, path).read().drop("order_id")


@with_spark
def doc_sink_repeated_ids(spark, raw):
    """All item rows as documents of their products: of one product the last row in item order wins."""
    path = scratch_path(spark, "repeated-index")
    items = raw["order_items"]
    docs = items.select("product_id", F.col("order_id").alias("total_orders"), "order_item_id", *_rank(items))
    order = ["total_orders", "order_item_id", "_rank"]
    result = upsert_documents(spark, docs, path, DOCUMENT_SCHEMAS["products"], "product_id", order=order)
    assert result.errors == 0
    return index_table(spark, path).read().select("_id", "total_orders", "_version")


def _rank(items: DataFrame) -> list:
    return [F.struct(*[F.col(c) for c in items.columns if c not in ("product_id",)]).alias("_rank")]


@with_spark
def doc_sink_keyless(spark, raw):
    """Documents without ids, published twice: all are added each time."""
    path = scratch_path(spark, "keyless-index")
    docs = raw["products"].select(F.col("product_category_name").alias("category"))
    for _ in range(2):
        upsert_documents(spark, docs, path, DOCUMENT_SCHEMAS["products"], "product_id")
    found = index_table(spark, path).read()
    return found.groupBy("category").agg(F.count("*").alias("documents"), F.count_distinct("_id").alias("ids"))


@with_spark
def index_create_if_absent(spark, raw):
    """An index is created once: with documents in it, ensuring it again changes nothing."""
    path, mapping = scratch_path(spark, "ensured-index"), DOCUMENT_SCHEMAS["sellers"]
    ensure_index(spark, path, mapping)
    empty = index_table(spark, path).read().agg(F.count("*").alias("before"))
    docs = raw["sellers"].select("seller_id", "seller_city", "seller_state")
    upsert_documents(spark, docs, path, mapping, "seller_id")
    ensure_index(spark, path, mapping)
    after = index_table(spark, path).read().groupBy("seller_state").agg(F.count("*").alias("after"))
    return after.select("seller_state", "after", F.lit(empty.first()["before"]).alias("before"))


@with_spark
def stream_publish_orders(spark, raw):
    """The same as a stream: one staging version, a publication, another version, another one."""
    settings = Settings(csv_dir="", root=scratch_path(spark, "stream"))
    for run in (scenarios.FirstRun(raw), scenarios.SecondRun(raw)):
        _stage_orders(spark, settings, run)
        publish_orders_stream(spark, settings, f"{settings.root}/checkpoint").awaitTermination()
    return index_table(spark, settings.index("orders")).read().drop("order_id")


def _stage_orders(spark: SparkSession, settings: Settings, raw) -> None:
    table = jobs.staging_table(spark, settings, jobs.ORDERS)
    version = table.next_version()
    new = staging.orders_enriched(raw).withColumn("row_version", F.lit(version).cast("bigint"))
    table.merge(new, version, [*staging.ENRICHED_UPDATES, "row_version"])


@with_spark
def publish_gate(spark, raw):
    """Two publications through the gate: the first publishes all orders, the second finds none waiting."""
    settings = Settings(csv_dir="", root=scratch_path(spark, "gate"))
    _stage_orders(spark, settings, raw)
    outcomes = [jobs.publish_if_needed(spark, settings) for _ in range(2)]
    rows = [(i + 1, o["status"], o["unsynced"], o["documents"]) for i, o in enumerate(outcomes)]
    return spark.createDataFrame(rows, "attempt int, status string, unsynced bigint, documents bigint")


@query
def doc_sink_rejects(raw):
    _, bad = split_documents(scenarios.text_documents(raw), DOCUMENT_SCHEMAS["orders"], "order_id")
    return bad.select("_id", F.array_join("unfit_fields", ",").alias("unfit_fields"))


@query
def doc_sink_accepted(raw):
    good, _ = split_documents(scenarios.text_documents(raw), DOCUMENT_SCHEMAS["orders"], "order_id")
    return good.select("_id", "order_status", "delay_days", "total_payment", "order_purchase_timestamp")


@with_spark
def index_count_orders(spark, raw):
    path = scratch_path(spark, "count-index")
    docs = documents.order_documents(_enriched(raw), iso_dates=False)
    upsert_documents(spark, docs, path, DOCUMENT_SCHEMAS["orders"], "order_id")
    missing = F.lit(index_count(spark, f"{path}-none")).cast("bigint").alias("documents_of_missing_index")
    return index_table(spark, path).read().agg(F.count("*").alias("documents")).select("documents", missing)


def _versioned(raw: StarViews) -> DataFrame:
    columns = ("order_id", "order_approved_at", "total_payment")
    return scenarios.versioned(_enriched(raw, *columns)).drop("order_approved_at")


@query
def unsynced_orders(raw):
    rows = _versioned(raw)
    return unsynced(rows, scenarios.PUBLISHED_THROUGH, scenarios.rejected(rows))


@query
def count_unsynced(raw):
    rows = _versioned(raw)
    waiting = unsynced(rows, scenarios.PUBLISHED_THROUGH, scenarios.rejected(rows))
    return waiting.agg(F.count("*").alias("cnt"))


@query
def mark_synced(raw):
    rows = _versioned(raw)
    return with_sync_flag(rows, scenarios.PUBLISHED_THROUGH, scenarios.rejected(rows))


@with_spark
def full_chain(spark, raw):
    """CSV files loaded, transformed and published; the orders with their sync state."""
    root = scratch_path(spark, "chain")
    settings = Settings(csv_dir=f"{root}/csv", root=root)
    write_shop_files(spark, raw, settings.csv_dir)
    jobs.run_all(spark, settings)
    return jobs.orders_table(spark, settings).select(*staging.ENRICHED_COLUMNS, "synced_to_es")


# --- runs and checks ------------------------------------------------------------------


@query
def run_state(raw):
    return runs.run_state(raw["run_events"])


@query
def recent_runs(raw):
    return runs.recent_runs(runs.run_state(raw["run_events"]))


@query
def recent_failed_runs(raw):
    """Failed runs among the last five of all kinds; failed ones before them do not count."""
    return runs.recent_failed_runs(runs.run_state(raw["run_events"]))


@query
def health_checks(raw):
    docs = documents.order_documents(_enriched(raw), iso_dates=False)
    return runs.health_checks(raw["orders"], docs, runs.run_state(raw["run_events"]))


@with_spark
def ledger_runs(spark, raw):
    """Three tracked runs, one of which fails after counting its rows; the clock is given."""
    ticks = iter(range(10))
    settings = Settings(
        csv_dir="", root=scratch_path(spark, "ledger"), clock=lambda: datetime(2024, 1, 1) + timedelta(minutes=next(ticks))
    )
    for kind, table in (("load", "customers"), ("transform", "sellers"), ("sync", "products")):
        try:
            with ledger.tracked_run(spark, settings, kind, "nightly") as run:
                run.rows = raw[table].count()
                if kind == "transform":
                    raise ValueError("lost")
        except ValueError:
            pass
    return ledger.runs(spark, settings)


@with_spark
def upsert_row_counts(spark, raw):
    """Rows written by two transforms of product revenue, and the stamps of the rows as they are then."""
    settings = Settings(csv_dir="", root=scratch_path(spark, "counts"), clock=lambda: datetime(2024, 2, 3))
    written = [
        jobs._upsert_staging(spark, settings, "product_revenue", staging.product_revenue(run))
        for run in (scenarios.FirstRun(raw), scenarios.SecondRun(raw))
    ]
    rows = jobs.staging_table(spark, settings, "product_revenue").read()
    return rows.groupBy("row_version", F.col("updated_at").cast("timestamp_ntz").alias("updated_at")).agg(
        F.count("*").alias("rows")
    ).withColumn("written", F.when(F.col("row_version") == 1, written[0]).otherwise(written[1]).cast("bigint"))


