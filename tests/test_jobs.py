from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from cartflow import jobs, ledger
from cartflow.schemas import DOCUMENT_SCHEMAS, RAW_TABLES
from cartflow.settings import Settings, scratch_path
from cartflow.sources.documents import index_count, index_table, pending_rejects, upsert_documents
from cartflow.sources.keyed import BUCKET, KeyedTable, read_pattern
from cartflow.sources.versioned import VersionedTable
from cartflow.streaming.orders import publish_orders_stream

FILES = {
    "shop_customers_dataset.csv": "customer_id,customer_city,customer_state\nc1,Rio,RJ\nc2,Santos,SP\n",
    "shop_sellers_dataset.csv": "seller_id,seller_city,seller_state\ns1,Rio,RJ\n",
    "shop_products_dataset.csv": "product_id,product_category_name\np1,beleza\np2,\n",
    "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\nbeleza,beauty\n,x\n",
    "shop_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date,"
        "order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-05 09:00:00,2018-01-04 00:00:00\n"
        "o2,c2,shipped,2018-02-01 10:00:00,,2018-02-09 00:00:00\n"
        "o2,c1,copy,,,\n"
    ),
    "shop_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,price\no1,1,p1,s1,10.00\no1,2,p2,s1,5.50\no2,1,p1,s1,10.00\n"
    ),
    "shop_order_payments_dataset.csv": "order_id,payment_sequential,payment_value\no1,1,15.50\n",
    "shop_order_reviews_dataset.csv": 'review_id,order_id,review_score,review_comment_message\nr1,o1,4,"a\nb"\n',
}
ROWS_READ = 2 + 1 + 2 + 1 + 3 + 3 + 1 + 1


def put(settings, **texts):
    for name, text in texts.items():
        full = [n for n in FILES if n.startswith(name) or n.startswith(f"shop_{name}_dataset")]
        with open(os.path.join(settings.csv_dir, full[0]), "w", encoding="utf-8") as out:
            out.write(text)


@pytest.fixture
def shop(settings):
    for name, text in FILES.items():
        with open(os.path.join(settings.csv_dir, name), "w", encoding="utf-8") as out:
            out.write(text)
    return settings


def orders(spark, settings):
    return {r["order_id"]: r for r in jobs.orders_table(spark, settings).collect()}


def documents(spark, settings, kind):
    return {r["_id"]: r for r in index_table(spark, settings.index(kind)).read().collect()}


def test_full_chain_and_reruns(spark, shop):
    assert jobs.publish_if_needed(spark, shop)["status"] == "skipped"
    assert jobs.run_all(spark, shop) == {"load": ROWS_READ, "transform": 2 + 2 + 1, "sync": 2 + 2 + 1}

    found = orders(spark, shop)
    assert (found["o1"]["delivery_days"], found["o1"]["delay_days"], found["o1"]["is_delayed"]) == (3, 1, True)
    assert found["o2"]["order_status"] == "shipped"
    assert all(r["synced_to_es"] for r in found.values())
    assert VersionedTable(spark, shop.raw("geolocation")).read().count() == 0

    docs = documents(spark, shop, "products")
    assert {k: r["category"] for k, r in docs.items()} == {"p1": "beauty", "p2": "unknown"}
    assert index_count(spark, shop.index("orders")) == 2
    assert index_count(spark, shop.index("orders") + "-none") == 0

    # Nothing is waiting: neither orders nor the other two are published.
    assert jobs.publish_if_needed(spark, shop) == {"status": "skipped", "unsynced": 0, "documents": 0}
    assert jobs.require_healthy(spark, shop) == {
        "raw_orders_present": 2,
        "order_documents_counted": 2,
        "no_recent_failed_runs": 0,
    }

    # The same input again: every row counts as changed and is published again.
    before = {k: (r["delivery_days"], r["total_payment"], r["customer_city"]) for k, r in orders(spark, shop).items()}
    assert jobs.transform(spark, shop) == 5
    after = orders(spark, shop)
    assert {k: (r["delivery_days"], r["total_payment"], r["customer_city"]) for k, r in after.items()} == before
    assert not any(r["synced_to_es"] for r in after.values())
    assert jobs.publish_if_needed(spark, shop) == {"status": "success", "unsynced": 2, "documents": 5}


def test_second_run_changes(spark, shop):
    jobs.run_all(spark, shop)
    put(
        shop,
        customers="customer_id,customer_city,customer_state\nc1,Recife,PE\nc2,Santos,SP\n",
        orders=(
            "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date,"
            "order_estimated_delivery_date\n"
            "o1,c2,returned,2019-01-01 10:00:00,,2018-01-09 00:00:00\n"
            "o3,c1,created,2018-03-01 10:00:00,,\n"
        ),
    )
    jobs.load(spark, shop)
    jobs.transform(spark, shop)
    found = orders(spark, shop)
    first = found["o1"]
    assert (first["customer_id"], first["customer_city"], str(first["order_purchase_timestamp"])) == (
        "c1",
        "Rio",
        "2018-01-01 10:00:00",
    )
    assert str(first["order_estimated_delivery_date"]) == "2018-01-04 00:00:00"
    assert (first["order_status"], first["order_delivered_customer_date"], first["delivery_days"]) == (
        "returned",
        None,
        None,
    )
    # An order the source no longer has stays as it was, and stays published.
    assert found["o2"]["order_status"] == "shipped"
    assert {k for k, r in found.items() if r["synced_to_es"]} == {"o2"}
    assert found["o3"]["customer_city"] == "Recife"
    assert jobs.publish(spark, shop) == 2 + 2 + 1
    assert set(documents(spark, shop, "orders")) == {"o1", "o2", "o3"}


def test_missing_file_empties_its_table(spark, shop):
    jobs.load(spark, shop)
    os.remove(os.path.join(shop.csv_dir, "shop_order_payments_dataset.csv"))
    assert jobs.load(spark, shop) == ROWS_READ - 1
    assert VersionedTable(spark, shop.raw("order_payments")).read().count() == 0


def test_failed_load_is_recorded_and_keeps_the_old_table(spark, shop):
    jobs.load(spark, shop)
    put(shop, order_items="order_id,order_item_id\no1,x\n")
    with pytest.raises(Exception, match="not a valid int"):
        jobs.load(spark, shop, "nightly")
    runs = {r["run_id"]: r for r in ledger.runs(spark, shop).collect()}
    assert (runs[1]["status"], runs[1]["rows_processed"], runs[1]["error_message"]) == ("success", ROWS_READ, None)
    failed = runs[2]
    # Every table that was replaced is counted, and no other.
    replaced = [t for t in (VersionedTable(spark, shop.raw(n)) for n in RAW_TABLES) if t.current() == 2]
    rows = sum(t.read().agg(F.sum("load_copies")).first()[0] or 0 for t in replaced)
    assert (failed["status"], failed["dag_id"], failed["rows_processed"]) == ("failed", "nightly", rows)
    assert 2 <= len(replaced) < len(RAW_TABLES)
    assert "not a valid int" in failed["error_message"]
    assert failed["finished_at"] >= failed["started_at"]
    assert VersionedTable(spark, shop.raw("order_items")).read().count() == 3
    with pytest.raises(ValueError, match="no_recent_failed_runs=1"):
        jobs.require_healthy(spark, shop)


def test_health_of_nothing(spark, settings):
    with pytest.raises(ValueError, match="raw_orders_present=0"):
        jobs.require_healthy(spark, settings)


def test_only_the_last_five_runs_count(spark, settings):
    with pytest.raises(RuntimeError):
        with ledger.tracked_run(spark, settings, "load"):
            raise RuntimeError("first")
    for _ in range(5):
        with ledger.tracked_run(spark, settings, "sync") as run:
            run.rows = 7
    checks = {r["check_name"]: r for r in jobs.health(spark, settings).collect()}
    assert checks["no_recent_failed_runs"]["ok"]
    assert {r["status"] for r in ledger.runs(spark, settings).collect()} == {"failed", "success"}


def test_run_in_progress(spark, settings):
    with ledger.tracked_run(spark, settings, "load", "now"):
        row = ledger.runs(spark, settings).first()
        assert (row["status"], row["finished_at"], row["dag_id"]) == ("running", None, "now")


def test_rejected_documents_stay_unsynced(spark, shop, monkeypatch):
    jobs.load(spark, shop)
    jobs.transform(spark, shop)
    shape = jobs.documents.order_documents

    def spoiled(rows, iso_dates=True):
        bad = F.when(F.col("order_id") == "o2", "many").otherwise(F.col("item_count").cast("string"))
        return shape(rows, iso_dates).withColumn("item_count", bad)

    monkeypatch.setattr(jobs.documents, "order_documents", spoiled)
    assert jobs.publish(spark, shop) == 1 + 2 + 1
    assert {k: r["synced_to_es"] for k, r in orders(spark, shop).items()} == {"o1": True, "o2": False}
    assert set(documents(spark, shop, "orders")) == {"o1"}
    # A second try ends even though it fails again; once mended it goes through.
    assert jobs.publish_if_needed(spark, shop)["unsynced"] == 1
    monkeypatch.setattr(jobs.documents, "order_documents", shape)
    assert jobs.publish_if_needed(spark, shop) == {"status": "success", "unsynced": 1, "documents": 4}
    assert all(r["synced_to_es"] for r in orders(spark, shop).values())


def test_crash_between_publishing_and_marking(spark, shop, monkeypatch):
    jobs.load(spark, shop)
    jobs.transform(spark, shop)
    real = jobs.upsert_documents

    def crash(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "upsert_documents", crash)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.publish(spark, shop)
    monkeypatch.setattr(jobs, "upsert_documents", real)
    assert not any(r["synced_to_es"] for r in orders(spark, shop).values())
    assert jobs.publish(spark, shop) == 5
    assert index_count(spark, shop.index("orders")) == 2


def test_documents_without_id_and_last_write_wins(spark, tmp_path):
    mapping = DOCUMENT_SCHEMAS["products"]
    path = str(tmp_path / "index")
    docs = spark.createDataFrame(
        [("p", "old", 1), ("p", "new", 2), (None, "loose", 1), (None, "loose", 2)], "product_id string, category string, n int"
    )
    result = upsert_documents(spark, docs, path, mapping, "product_id", order=["n"])
    assert (result.indexed, result.errors) == (3, 0)
    rows = index_table(spark, path).read().collect()
    assert sorted(r["category"] for r in rows) == ["loose", "loose", "new"]
    assert len({r["_id"] for r in rows}) == 3
    # Documents without the field altogether are always added.
    upsert_documents(spark, docs.select("category"), path, mapping, "product_id")
    assert index_count(spark, path) == 7


def test_whole_documents_are_replaced(spark, tmp_path):
    mapping, path = DOCUMENT_SCHEMAS["products"], str(tmp_path / "index")
    first = spark.createDataFrame([("p", "a", 5)], "product_id string, category string, total_orders bigint")
    upsert_documents(spark, first, path, mapping, "product_id")
    upsert_documents(spark, first.drop("total_orders"), path, mapping, "product_id")
    assert index_table(spark, path).read().first()["total_orders"] is None


def test_rejects_name_their_fields(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a", "1.5", "x"), ("b", "1.5", "3")], "product_id string, avg_price string, total_orders string"
    )
    result = upsert_documents(spark, docs, str(tmp_path / "i"), DOCUMENT_SCHEMAS["products"], "product_id")
    assert (result.indexed, result.errors) == (1, 1)
    assert [(r["_id"], r["unfit_fields"]) for r in result.rejects.collect()] == [("a", ["total_orders"])]


def test_uncommitted_versions_are_not_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.current() is None and table.read_or_none() is None
    table.write(spark.range(3))
    os.makedirs(f"{table.path}/v=2")  # a write that never finished
    assert table.current() == 1
    assert table.write(spark.range(5)) == 3
    assert table.read().count() == 5
    assert table.read(1).count() == 3
    with pytest.raises(Exception):
        table.write(spark.range(1), 3)


def test_old_versions_expire(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(1, 4):
        table.write(spark.range(n))
    os.makedirs(f"{table.path}/v=9")  # started, not committed
    table.expire(2)
    assert sorted(os.listdir(table.path)) == ["v=2", "v=3", "v=9"]
    assert table.read().count() == 3
    assert table.next_version() == 10


def test_stream_publishes_increments(spark, shop, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        query = publish_orders_stream(spark, shop, checkpoint)
        query.awaitTermination()
        return index_table(spark, shop.index("orders")).current()

    jobs.load(spark, shop)
    jobs.transform(spark, shop)
    first = run()
    assert set(documents(spark, shop, "orders")) == {"o1", "o2"}
    assert run() == first  # nothing new
    put(
        shop,
        orders="order_id,customer_id,order_status\no2,c2,delivered\no9,c1,created\n",
    )
    reload_orders(spark, shop)
    reload_orders(spark, shop)  # two versions at once
    assert run() > first
    docs = documents(spark, shop, "orders")
    assert {k: r["order_status"] for k, r in docs.items()} == {"o1": "delivered", "o2": "delivered", "o9": "created"}
    assert docs["o1"]["_version"] < docs["o2"]["_version"]
    # A replayed batch leaves the same documents.
    again = publish_orders_stream(spark, shop, checkpoint + "-2")
    again.awaitTermination()
    replayed = documents(spark, shop, "orders")
    drop = {"_version"}
    assert {k: {c: v for c, v in r.asDict().items() if c not in drop} for k, r in replayed.items()} == {
        k: {c: v for c, v in r.asDict().items() if c not in drop} for k, r in docs.items()
    }


def reload_orders(spark, settings):
    """Only the orders loaded and derived anew."""
    jobs._load_table(spark, settings, RAW_TABLES["orders"])
    rows = jobs.staging.orders_enriched(jobs.raw_tables(spark, settings))
    jobs._upsert_staging(spark, settings, jobs.ORDERS, rows, jobs.staging.ENRICHED_UPDATES)


def test_stream_sees_committed_versions_only_and_shares_the_state(spark, shop, tmp_path, monkeypatch):
    def run():
        publish_orders_stream(spark, shop, str(tmp_path / "checkpoint")).awaitTermination()
        return {k: r["order_status"] for k, r in documents(spark, shop, "orders").items()}

    jobs.load(spark, shop)
    jobs.transform(spark, shop)
    assert run() == {"o1": "delivered", "o2": "shipped"}
    assert jobs.publish_if_needed(spark, shop)["status"] == "skipped"  # the stream has marked them

    # A version whose rows are there but whose manifest is not.
    table = jobs.staging_table(spark, shop, jobs.ORDERS)
    commit = KeyedTable._commit
    monkeypatch.setattr(KeyedTable, "_commit", lambda *_: None)
    table.merge(table.read().withColumns({"order_status": F.lit("lost"), "row_version": F.lit(2).cast("bigint")}))
    monkeypatch.setattr(KeyedTable, "_commit", commit)
    assert table.current() == 1 and table.next_version() == 3
    assert run() == {"o1": "delivered", "o2": "shipped"}
    assert jobs.unsynced_orders(spark, shop).count() == 0

    # A document rejected in one batch is tried again in the next.
    shape = jobs.documents.order_documents

    def spoiled(rows, iso_dates=True):
        bad = F.when(F.col("order_id") == "o2", "many").otherwise(F.col("item_count").cast("string"))
        return shape(rows, iso_dates).withColumn("item_count", bad)

    put(shop, orders="order_id,customer_id,order_status\no2,c2,returned\no3,c1,created\n")
    reload_orders(spark, shop)
    monkeypatch.setattr(jobs.documents, "order_documents", spoiled)
    assert run() == {"o1": "delivered", "o2": "shipped", "o3": "created"}
    assert [r["_id"] for r in pending_rejects(spark, shop.index("orders")).collect()] == ["o2"]
    monkeypatch.setattr(jobs.documents, "order_documents", shape)
    put(shop, orders="order_id,customer_id,order_status\no4,c1,created\n")
    reload_orders(spark, shop)
    assert run() == {"o1": "delivered", "o2": "returned", "o3": "created", "o4": "created"}
    assert pending_rejects(spark, shop.index("orders")).count() == 0
    assert jobs.unsynced_orders(spark, shop).count() == 0


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet") if "manifest" not in str(p)}


def test_a_changed_key_rewrites_one_bucket(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=8)
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"))
    table.merge(rows)
    assert {p["version"] for p in table.places() if p["bucket"] >= 0} == {1}
    table.merge(spark.createDataFrame([("7", "new")], "k string, v string"))
    assert sorted(p["version"] for p in table.places() if p["bucket"] >= 0) == [1] * 7 + [2]
    assert len([f for f in files(tmp_path / "t") if "/_v=2/" in f]) == 1
    assert table.written(2).count() < 200
    assert table.read(since=1).where("v = 'new'").count() == 1
    found = {r["k"]: r["v"] for r in table.read().collect()}
    assert len(found) == 200 and [k for k, v in found.items() if v == "new"] == ["7"]
    assert {r["v"] for r in table.read(1).collect()} == {"old"}
    # The bucket count is kept by the table.
    assert KeyedTable(spark, table.path, "k", buckets=3).merge(rows.limit(0)) == 3
    assert table.read().count() == 200


def test_unused_buckets_expire(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=2, keep=2)
    for n in range(5):
        table.merge(spark.createDataFrame([("a", n)], "k string, n int"))
    folders = sorted(p.name for p in (tmp_path / "t" / "data").iterdir())
    assert folders == ["_v=4", "_v=5"]
    assert table.read().first()["n"] == 4 and table.read(4).first()["n"] == 3
    assert {p.name for p in (tmp_path / "t" / "data" / "_v=5").iterdir() if p.name.startswith(BUCKET)} != set()


def test_tables_expire_with_each_commit(spark, shop):
    shop = dataclasses.replace(shop, keep=1)
    for _ in range(2):
        with ledger.tracked_run(spark, shop, "load"):
            jobs._load_table(spark, shop, RAW_TABLES["sellers"])
    for path in (shop.raw("sellers"), shop.staging("run_events")):
        assert len(VersionedTable(spark, path).committed()) == shop.keep


def test_repeated_ids_need_an_order(spark, tmp_path):
    docs = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "c")], "product_id string, category string")
    path = str(tmp_path / "i")
    with pytest.raises(Exception, match="several documents with the id p"):
        upsert_documents(spark, docs, path, DOCUMENT_SCHEMAS["products"], "product_id")
    assert index_count(spark, path) == 0
    assert upsert_documents(spark, docs, path, DOCUMENT_SCHEMAS["products"], "product_id", order=["category"]).indexed == 2
    assert {r["category"] for r in index_table(spark, path).read().collect()} == {"b", "c"}


def test_rejects_stay_until_they_are_accepted(spark, tmp_path):
    path, mapping = str(tmp_path / "i"), DOCUMENT_SCHEMAS["products"]

    def publish(*rows):
        docs = spark.createDataFrame(list(rows), "product_id string, total_orders string")
        upsert_documents(spark, docs, path, mapping, "product_id")
        return sorted(r["_id"] for r in pending_rejects(spark, path).collect())

    assert publish(("a", "x"), ("b", "y"), ("c", "1")) == ["a", "b"]
    assert publish(("d", "2")) == ["a", "b"]
    assert publish(("a", "3"), ("b", "z")) == ["b"]


def test_indices_are_read_by_pattern(spark, tmp_path):
    mapping = DOCUMENT_SCHEMAS["products"]
    for name in ("shop_products_1", "shop_products_2", "shop_sellers"):
        docs = spark.createDataFrame([(name, "c")], "product_id string, category string")
        upsert_documents(spark, docs, f"{tmp_path}/{name}", mapping, "product_id")
    found = read_pattern(spark, str(tmp_path), "shop_products*", "_id")
    assert sorted((r["_index"], r["_id"]) for r in found.collect()) == [
        ("shop_products_1", "shop_products_1"),
        ("shop_products_2", "shop_products_2"),
    ]
    assert read_pattern(spark, str(tmp_path), "none*", "_id") is None


def test_settings_from_environment():
    found = Settings.from_env({"CARTFLOW_CSV_DIR": "/c", "CARTFLOW_ROOT": "/r", "CARTFLOW_INDEX_ORDERS": "o"})
    assert found.index("orders") == "/r/documents/o"
    assert found.index("sellers") == "/r/documents/sellers"
    assert (found.batch, found.detect_changes) == (8, False)
    env = {"CARTFLOW_CSV_DIR": "/c", "CARTFLOW_ROOT": "/r", "CARTFLOW_BATCH": "3", "CARTFLOW_DETECT_CHANGES": "true"}
    assert (Settings.from_env(env).batch, Settings.from_env(env).detect_changes) == (3, True)


class StubSession:
    """What the scratch rule asks of a session."""

    def __init__(self, master, shared):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: shared)})()


def test_scratch_lies_under_the_checkpoint_folder():
    assert scratch_path(StubSession("yarn", "hdfs:/shared/"), "x").startswith("hdfs:/shared/x-")
    assert os.path.isdir(os.path.dirname(scratch_path(StubSession("local[2]", None), "x")))
    for master in ("yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(StubSession(master, None), "x")


def test_manifest():
    assert list(RAW_TABLES) == [
        "customers",
        "sellers",
        "products",
        "category_translation",
        "orders",
        "order_items",
        "order_payments",
        "order_reviews",
        "geolocation",
    ]
