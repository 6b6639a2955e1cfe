"""The plans: what they scan, shuffle and join, and what they must never hold."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import cartflow
from cartflow.operators.dedup import first_per_key
from cartflow.operators.upsert import upsert
from cartflow.plans import reports, staging
from cartflow.registry.queries import QUERIES
from cartflow.sources.star import ITEM_ORDER, StarViews

#: Queries that write and read tables while they are built.
ACTIONS = {
    "csv_load_order_items",
    "csv_load_multiline_text",
    "doc_sink_orders",
    "stream_publish_orders",
    "index_count_orders",
    "full_chain",
    "chart_monthly_orders",
    "chart_revenue_by_category",
    "chart_delivery_days_by_state",
    "chart_delay_rate_by_state",
    "orders_in_time_range",
    "index_pattern_read",
    "csv_bom_and_ragged_rows",
    "csv_literal_quotes",
    "load_geolocation",
    "load_misfits_fail",
    "doc_sink_repeated_ids",
    "doc_sink_keyless",
    "index_create_if_absent",
    "publish_gate",
    "ledger_runs",
    "upsert_row_counts",
}


def plan(rows) -> str:
    """Physical plan before it runs."""
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Sizes as on a large cluster: no side is small enough to be broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ACTIONS))
def test_no_query_crosses_or_leaves_the_jvm(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("CartesianProduct", "NestedLoopJoin", "BroadcastHashJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in text
    assert "Window [" not in text  # no query ranks or gathers groups


@pytest.mark.parametrize(
    "name", ["top_categories", "top_sellers", "run_history", "recent_runs", "recent_failed_runs"]
)
def test_limited_sorts_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_SMALL))


def scans(text: str) -> dict[str, list[str]]:
    """Columns read from each star table."""
    found: dict[str, list[str]] = {}
    for columns, table in re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", text):
        names = {c.split("#")[0] for c in columns.split(",") if c}
        found[table] = sorted(names | set(found.get(table, [])))
    return found


def test_scans_read_only_what_is_needed(spark):
    raw = StarViews(spark, SF_SMALL)
    assert scans(plan(staging.item_counts(raw["order_items"]))) == {"lineitem": ["l_orderkey"]}
    text = plan(staging.product_totals(raw["order_items"]))
    assert scans(text) == {"lineitem": ["l_extendedprice", "l_orderkey", "l_partkey"]}
    assert "PushedFilters: [IsNotNull(l_partkey)]" in text
    # A report by status needs no join at all.
    text = plan(QUERIES["order_status_distribution"](spark, SF_SMALL))
    assert set(scans(text)) == {"orders"} and "Join" not in text


def exchanges(text: str, key: str) -> int:
    return len(re.findall(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)", text))


def older(rows):
    """Rows of an earlier version, as a merge reads them: in no partitioning of use."""
    return rows.sparkSession.createDataFrame([], rows.schema)


def test_order_joins_and_merge_share_one_partitioning(spark, no_broadcast):
    raw = StarViews(spark, SF_SMALL)
    rows = staging.orders_enriched(raw)
    text = plan(rows)
    # Orders once, and one per aggregated side; each aggregate is partial before its shuffle.
    assert exchanges(text, "order_id") == 4
    assert len(re.findall(r"functions=\[partial_", text)) == 3
    assert exchanges(text, "customer_id") == 2
    # The merge adds the shuffle of the older rows only.
    assert exchanges(plan(upsert(older(rows), rows, "order_id", staging.ENRICHED_UPDATES)), "order_id") == 5


def test_products_are_looked_up_after_grouping(spark, no_broadcast):
    rows = staging.product_revenue(StarViews(spark, SF_SMALL))
    lines = plan(rows).splitlines()
    first_join = next(n for n, line in enumerate(lines) if "SortMergeJoin" in line)
    grouped = [n for n, line in enumerate(lines) if "count(distinct order_id" in line]
    scan = next(n for n, line in enumerate(lines) if "lineitem" in line)
    assert first_join < min(grouped) < scan
    assert not any("Join" in line for line in lines[min(grouped) : scan])
    # Totals, products; the merge adds the older rows.
    assert exchanges(plan(rows), "product_id") == 2
    assert exchanges(plan(upsert(older(rows), rows, "product_id")), "product_id") == 3


def test_seller_merge_adds_no_shuffle_of_the_totals(spark, no_broadcast):
    rows = staging.seller_performance(StarViews(spark, SF_SMALL))
    assert exchanges(plan(rows), "seller_id") == 2
    assert exchanges(plan(upsert(older(rows), rows, "seller_id", staging.SELLER_UPDATES)), "seller_id") == 3


def test_copies_of_a_key_meet_before_the_shuffle(spark):
    text = plan(first_per_key(StarViews(spark, SF_SMALL)["order_items"], ["order_id", "order_item_id"], ITEM_ORDER))
    before, after = text.split("Exchange", 1)
    assert "partial_min_by" in after and "partial_" not in before
    assert text.count("Exchange") == 1


def test_status_total_reuses_the_counts(spark):
    rows = QUERIES["order_status_distribution"](spark, SF_SMALL)
    rows.collect()
    assert "ReusedExchange" in plan(rows)


def test_hot_customer_is_split(spark, no_broadcast, tmp_path):
    """Every third order belongs to one customer: the join splits its partition."""
    order_count, hot = 120_000, "c-hot"
    orders = spark.range(order_count, numPartitions=8).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.rand(7) < 0.4, hot).otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("order_status"),
    )
    orders.write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    names = orders.select("customer_id").distinct()
    customers = names.select("customer_id", F.lit("city").alias("customer_city"), F.lit("XX").alias("customer_state"))
    customers.write.parquet(str(tmp_path / "customers"))
    customers = spark.read.parquet(str(tmp_path / "customers"))
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        columns = ("order_id", "customer_id", "order_status", "customer_city", "customer_state")
        rows = staging.orders_enriched({"orders": orders, "customers": customers}, columns)
        assert len(rows.collect()) == order_count
        assert "skew=true" in plan(rows)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_hot_order_builds_no_pairs(spark):
    """60,000 items and 60,000 reviews of one order: 3.6e9 pairs are counted, not built."""
    n = 60_000
    items = spark.range(n).select(
        F.lit("o").alias("order_id"), F.lit("s").alias("seller_id"), F.lit("1.00").cast("decimal(10,2)").alias("price")
    )
    reviews = spark.range(n).select(F.lit("o").alias("order_id"), F.lit(4).cast("smallint").alias("review_score"))
    orders = spark.sql(
        "select 'o' order_id, timestamp_ntz'2018-01-01' order_delivered_customer_date, "
        "timestamp_ntz'2018-01-02' order_estimated_delivery_date"
    )
    sellers = spark.sql("select 's' seller_id, 'c' seller_city, 'XX' seller_state")
    raw = {"order_items": items, "order_reviews": reviews, "orders": orders, "sellers": sellers}
    row = staging.seller_performance(raw).first()
    assert (row["total_orders"], float(row["total_revenue"]), float(row["avg_review_score"])) == (1, float(n * n), 4.0)
    assert float(row["on_time_rate"]) == 100.0 * n * n


def test_report_totals_add_up(spark):
    raw = StarViews(spark, SF_SMALL)
    enriched = staging.orders_enriched(raw)
    total = enriched.count()
    assert reports.order_status_distribution(enriched).agg(F.sum("count")).first()[0] == total
    months = reports.monthly_order_volume(enriched).agg(F.sum("order_count")).first()[0]
    assert months == enriched.where("order_purchase_timestamp is not null").count()
    states = reports.delay_rate_by_state(enriched).agg(F.sum("total_orders"), F.sum("delayed_orders")).first()
    whole = reports.delay_rate_overall(enriched).first()
    assert (states[0], states[1]) == (whole["total_orders"], whole["delayed_orders"])


def test_sources_keep_to_the_rules():
    package = Path(cartflow.__file__).parent
    text = {p.name: p.read_text() for p in package.rglob("*.py") if "llm" not in p.relative_to(package).parts}
    whole = "\n".join(text.values())
    for word in ("localCheckpoint", "toPandas", "broadcast(", "crossJoin", ".rdd", "udf("):
        assert word not in whole
    # The only rows brought to the driver: one or two for each bucket (places, marks, counts), and the three health checks.
    assert {name: body.count(".collect()") for name, body in text.items() if ".collect()" in body} == {
        "keyed.py": 3,
        "jobs.py": 2,
        "documents.py": 1,
    }
