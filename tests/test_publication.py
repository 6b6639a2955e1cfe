"""Publication that resumes, retries, withdraws and streams; one evaluation for each commit."""

from __future__ import annotations

import dataclasses
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_jobs import documents, orders, put, shop  # noqa: F401

from cartflow import jobs
from cartflow.operators.changes import ROW_HASH, changed_rows, with_row_hash
from cartflow.operators.upsert import upsert
from cartflow.plans import staging
from cartflow.registry import shop_files
from cartflow.schemas import DOCUMENT_SCHEMAS
from cartflow.sources.csv_files import read_rows
from cartflow.sources.documents import index_table, pending_rejects, rejects_table, upsert_documents
from cartflow.sources.keyed import KeyedTable
from cartflow.sources.star import StarViews
from cartflow.streaming.orders import publish_orders_stream

HEADER = "order_id,customer_id,order_status\n"


def many_orders(n: int, status: str = "created") -> str:
    return HEADER + "".join(f"o{i},c{i % 3},{status}\n" for i in range(n))


def stage(spark, settings, ids, status="created"):
    """Commit orders straight into the staging table; the version they got."""
    table = jobs.staging_table(spark, settings, jobs.ORDERS)
    version = table.next_version()
    columns = {"order_id": F.col("id"), "order_status": F.lit(status), "item_count": F.lit(1)}
    rows = spark.createDataFrame([(i,) for i in ids], "id string").select(
        *[columns.get(c, F.lit(None).cast(kinds.get(c, "string"))).alias(c) for c in staging.ENRICHED_COLUMNS],
        F.lit(version).cast("bigint").alias("row_version"),
    )
    table.merge(rows, version)
    return version


kinds = {f.name: f.dataType for f in DOCUMENT_SCHEMAS["orders"].fields}
IDS = [f"o{i}" for i in range(40)]


def plain(rows):
    """Documents without the version that wrote them."""
    return {k: {c: v for c, v in r.asDict().items() if c != "_version"} for k, r in rows.items()}


@pytest.fixture
def staged(spark, settings):
    """40 orders that wait in three buckets, published one bucket at a time."""
    settings = dataclasses.replace(settings, batch=1)
    stage(spark, settings, IDS)
    return settings


@pytest.fixture
def big_shop(spark, shop):  # noqa: F811
    put(shop, orders=many_orders(40))
    jobs.load(spark, shop)
    return shop


@pytest.mark.parametrize("after", [0, 2])
def test_a_crash_repeats_only_what_is_not_marked(spark, staged, monkeypatch, after):
    big_shop = staged
    real, calls = jobs.upsert_documents, []

    def counted(session, docs, *args, **kwargs):
        calls.append({r["order_id"] for r in docs.select("order_id").collect()})
        if len(calls) == after + 1 and not crashed:
            crashed.append(True)
            raise RuntimeError("lost")
        return real(session, docs, *args, **kwargs)

    crashed: list[bool] = []
    monkeypatch.setattr(jobs, "upsert_documents", counted)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.publish_orders(spark, big_shop)
    done = {k for k, r in orders(spark, big_shop).items() if r["synced_to_es"]}
    assert done == set().union(*calls[:after]) == set(documents(spark, big_shop, "orders"))
    calls.clear()
    assert jobs.publish_orders(spark, big_shop) == 40 - len(done)
    assert len(calls) == 3 - after and not done & set().union(*calls)
    assert all(r["synced_to_es"] for r in orders(spark, big_shop).values())

    # One pass over all buckets leaves the same documents.
    whole = dataclasses.replace(big_shop, root=f"{big_shop.root}-whole", batch=99)
    stage(spark, whole, IDS)
    calls.clear()
    assert jobs.publish_orders(spark, whole) == 40 and len(calls) == 1
    assert plain(documents(spark, whole, "orders")) == plain(documents(spark, big_shop, "orders"))


def spoiled(shape, *ids):
    def documents_of(rows, iso_dates=True):
        bad = F.when(F.col("order_id").isin(*ids), "many").otherwise(F.col("item_count").cast("string"))
        return shape(rows, iso_dates).withColumn("item_count", bad)

    return documents_of


def staging_buckets(rows, settings):
    files = [f for f in rows.inputFiles() if "/staging/" in f]
    return {part for f in files for part in f.split("/") if part.startswith("_bucket=")}


def test_a_rejected_order_costs_its_bucket_only(spark, staged, monkeypatch):
    big_shop = dataclasses.replace(staged, batch=9)
    shape = jobs.documents.order_documents
    monkeypatch.setattr(jobs.documents, "order_documents", spoiled(shape, "o7"))
    assert jobs.publish_orders(spark, big_shop) == 39
    waiting = jobs.unsynced_orders(spark, big_shop)
    assert [r["order_id"] for r in waiting.collect()] == ["o7"]
    table = jobs.staging_table(spark, big_shop, jobs.ORDERS)
    (bucket,) = table.buckets_of(spark.createDataFrame([("o7",)], "order_id string"))
    assert staging_buckets(waiting, big_shop) == {f"_bucket={bucket}"}
    before = index_table(spark, big_shop.index("orders")).places()
    assert jobs.publish_orders(spark, big_shop) == 0  # rejected again; the index is not touched
    assert index_table(spark, big_shop.index("orders")).places() == before
    monkeypatch.setattr(jobs.documents, "order_documents", shape)
    assert jobs.publish_orders(spark, big_shop) == 1
    assert staging_buckets(jobs.unsynced_orders(spark, big_shop), big_shop) == set()


def test_accepted_rejects_go_with_their_bucket(spark, tmp_path):
    path, mapping = str(tmp_path / "i"), DOCUMENT_SCHEMAS["products"]

    def publish(*rows):
        docs = spark.createDataFrame(list(rows), "product_id string, total_orders string")
        upsert_documents(spark, docs, path, mapping, "product_id", buckets=8)
        return sorted(r["_id"] for r in pending_rejects(spark, path).collect())

    ids = [f"p{i}" for i in range(30)]
    assert publish(*[(i, "x") for i in ids]) == sorted(ids)
    table = rejects_table(spark, path)
    before = {p["bucket"]: p["version"] for p in table.places()}
    assert publish(("p3", "5"), ("other", "6")) == sorted(set(ids) - {"p3"})
    after = {p["bucket"]: p["version"] for p in table.places()}
    (bucket,) = table.buckets_of(spark.createDataFrame([("p3",)], "_id string"))
    assert {b for b in after if b >= 0 and after.get(b) != before.get(b)} == {bucket}
    # Nothing rejected and nothing accepted: the rejects are not written at all.
    version = table.current()
    assert publish(("other", "7")) == sorted(set(ids) - {"p3"}) and table.current() == version
    # One id both fit and unfit stays a reject; a publication of rejects only leaves the index as it is.
    index = index_table(spark, path).current()
    assert "q" in publish(("q", "bad"), ("q", "worse")) and index_table(spark, path).current() == index
    assert publish(*[(i, "1") for i in [*ids, "q"]]) == []


@pytest.mark.parametrize("order", [None, ["rank"]])
def test_documents_are_evaluated_once(spark, tmp_path, order):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(60).select(
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("p"), "id")).alias("product_id"),
        F.when(F.col("id") % 7 == 0, "many").otherwise("3").alias("total_orders"),
        F.col("id").alias("rank"),
    )
    for n in (1, 2):
        docs = rows.mapInArrow(counting, rows.schema)
        result = upsert_documents(spark, docs, str(tmp_path / "i"), DOCUMENT_SCHEMAS["products"], "product_id", order=order)
        assert seen.value == 60 * n
        assert (result.indexed, result.errors) == (51, 9)
    found = index_table(spark, str(tmp_path / "i")).read()
    assert found.count() == 41 + 2 * 10  # with ids once, without ids each time


def test_a_merge_evaluates_new_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    for n in (1, 2):
        table.merge(spark.range(50).mapInArrow(counting, "id bigint"))
        assert seen.value == 50 * n
    assert table.read().count() == 50


# --- changes by content ---


def test_an_equal_transform_leaves_nothing_unsynced(spark, big_shop):
    big_shop = dataclasses.replace(big_shop, detect_changes=True)
    assert jobs.transform(spark, big_shop) == 40 + 2 + 1
    jobs.publish(spark, big_shop)
    places = {p["bucket"]: p["version"] for p in jobs.staging_table(spark, big_shop, jobs.ORDERS).places() if p["bucket"] >= 0}
    assert jobs.transform(spark, big_shop) == 0
    assert jobs.unsynced_orders(spark, big_shop).count() == 0
    assert jobs.publish_if_needed(spark, big_shop)["status"] == "skipped"
    again = {p["bucket"]: p["version"] for p in jobs.staging_table(spark, big_shop, jobs.ORDERS).places() if p["bucket"] >= 0}
    assert again == places

    # One changed, one new and one withdrawn order: the first two are written, the third stays.
    put(big_shop, orders=many_orders(39).replace("o5,c2,created", "o5,c2,returned") + "new,c1,created\n")
    jobs.load(spark, big_shop)
    assert jobs.transform(spark, big_shop) == 2
    waiting = {r["order_id"]: r["order_status"] for r in jobs.unsynced_orders(spark, big_shop).collect()}
    assert waiting == {"o5": "returned", "new": "created"}
    assert len(orders(spark, big_shop)) == 41
    # Columns that keep their first value don't count as changes.
    put(big_shop, customers="customer_id,customer_city,customer_state\nc1,Elsewhere,XX\n")
    jobs.load(spark, big_shop)
    assert jobs.transform(spark, big_shop) == 0


def test_change_detection_can_be_switched(spark, big_shop):
    assert jobs.transform(spark, big_shop) == 43  # written without hashes
    detecting = dataclasses.replace(big_shop, detect_changes=True)
    assert jobs.transform(spark, detecting) == 43
    assert jobs.transform(spark, detecting) == 0
    assert jobs.transform(spark, big_shop) == 43


def test_row_hashes_tell_nulls_apart(spark):
    rows = spark.createDataFrame([("a", None, 5), ("b", 5, None), ("c", 5, 5), ("d", None, None), ("e", 5, 5)], "k string, x int, y int")
    hashes = {r["k"]: r[ROW_HASH] for r in with_row_hash(rows, ["x", "y"]).collect()}
    assert hashes["c"] == hashes["e"] and len(set(hashes.values())) == 4
    hashed = with_row_hash(rows, ["x", "y"])
    old = hashed.where("k <> 'a'").withColumn(ROW_HASH, F.when(F.col("k") == "b", 1).when(F.col("k") != "c", F.col(ROW_HASH)))
    assert sorted(r["k"] for r in changed_rows(old, hashed, "k").collect()) == ["a", "b", "c"]
    assert changed_rows(None, hashed, "k").count() == changed_rows(rows, hashed, "k").count() == 5


# --- keyed tables ---


def test_withdrawn_keys_and_unchanged_rows(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", None, 1)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 3, 2), ("c", None, 2), ("d", 4, 2)], "k string, v int, at int")
    gone = spark.createDataFrame([("a",), ("z",)], "k string")
    rows = upsert(old, new, "k", withdrawn=gone, stamps=["at"]).collect()
    assert sorted(tuple(r) for r in rows) == [("b", 3, 2), ("c", None, 1), ("d", 4, 2)]
    rows = upsert(old, new, "k").collect()
    assert sorted(tuple(r) for r in rows) == [("a", 1, 1), ("b", 3, 2), ("c", None, 2), ("d", 4, 2)]


def test_a_bucket_that_loses_its_last_row_goes(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=3)
    table.merge(spark.createDataFrame([("a", 1)], "k string, v int"))
    table.merge(spark.createDataFrame([], "k string, v int"), withdrawn=spark.createDataFrame([("a",)], "k string"))
    assert [p["bucket"] for p in table.places()] == [-1] and table.read().count() == 0


def test_tables_can_be_dealt_anew(spark, staged):
    big_shop = dataclasses.replace(staged, batch=99)
    jobs.publish_orders(spark, big_shop)
    table = jobs.staging_table(spark, big_shop, jobs.ORDERS)
    before = {r["order_id"]: r for r in table.read().collect()}
    table.deal(11)
    assert table.bucket_count() == 11 and {r["order_id"]: r for r in table.read().collect()} == before
    assert len({p["bucket"] for p in table.places()}) > 6
    # Marks of the old buckets don't hold; publishing again leaves the same documents.
    docs = plain(documents(spark, big_shop, "orders"))
    assert jobs.unsynced_orders(spark, big_shop).count() == 40
    jobs.publish_orders(spark, big_shop)
    assert plain(documents(spark, big_shop, "orders")) == docs
    assert jobs.unsynced_orders(spark, big_shop).count() == 0


# --- the stream ---


@pytest.fixture
def streaming(spark, staged, tmp_path, monkeypatch):
    """Runs the stream; returns the order ids of its batches and the last progress."""
    batches: list[dict] = []
    real = jobs.publish_changes

    def seen(session, settings, changed, version):
        rows = changed.select("order_id", "row_version").collect()
        batches.append({r["order_id"]: r["row_version"] for r in rows})
        return real(session, settings, changed, version)

    monkeypatch.setattr(jobs, "publish_changes", seen)

    def run(checkpoint="checkpoint"):
        batches.clear()
        query = publish_orders_stream(spark, staged, str(tmp_path / checkpoint))
        query.awaitTermination()
        return list(batches), query.lastProgress

    return run


def test_stream_carries_what_it_publishes(spark, staged, streaming):
    (batch,), _ = streaming()
    assert batch == {f"o{i}": 1 for i in range(40)}
    assert streaming()[0] == []
    for status in ("paid", "sent", "sent"):
        stage(spark, staged, ["o1", "o2", f"n{status}"], status)
    (batch,), progress = streaming()
    assert batch == {"o1": 4, "o2": 4, "npaid": 2, "nsent": 4}
    docs = documents(spark, staged, "orders")
    newest = max(r["_version"] for r in docs.values())
    assert {k for k, r in docs.items() if r["_version"] == newest} == set(batch)
    assert docs["o1"]["order_status"] == "sent"
    # State grows with the orders, not with their versions.
    before = progress["stateOperators"][0]["numRowsTotal"]
    for status in ("back", "gone"):
        stage(spark, staged, ["o1", "o2", "o3"], status)
    _, progress = streaming()
    assert progress["stateOperators"][0]["numRowsTotal"] == before <= 2 * 42
    assert jobs.publish_if_needed(spark, staged)["status"] == "skipped"


def test_a_replayed_batch_changes_nothing(spark, staged, streaming, monkeypatch):
    streaming()
    stage(spark, staged, ["o1", "o2"], "paid")
    mark = jobs.SyncState.mark

    def lost(*_):
        raise RuntimeError("lost before the mark")

    monkeypatch.setattr(jobs.SyncState, "mark", lost)
    with pytest.raises(Exception, match="lost before the mark"):
        streaming()
    committed = documents(spark, staged, "orders")
    assert committed["o1"]["order_status"] == "paid"
    monkeypatch.setattr(jobs.SyncState, "mark", mark)
    (batch,), _ = streaming()
    assert batch == {"o1": 2, "o2": 2}  # the same batch again
    assert documents(spark, staged, "orders") == committed
    assert jobs.unsynced_orders(spark, staged).count() == 0
    # A new stream finds everything published.
    streaming("another")
    assert documents(spark, staged, "orders") == committed


def test_a_feed_write_that_died_is_done_again(spark, staged, streaming):
    version = jobs.append_changes(spark, staged)
    folder = jobs.changes_table(spark, staged).folder(version)
    os.remove(f"{folder}/_SUCCESS")
    assert jobs.append_changes(spark, staged) == version
    (batch,), _ = streaming()
    assert len(batch) == 40
    # Rows of a feed version that come twice are published once.
    stage(spark, staged, ["o1"], "paid")
    streaming()
    committed = documents(spark, staged, "orders")
    feed = jobs.changes_table(spark, staged)
    twice = spark.read.parquet(feed.folder(2)).unionByName(spark.read.parquet(feed.folder(2)))
    twice.write.mode("append").parquet(feed.folder(2))
    streaming()
    assert documents(spark, staged, "orders") == committed


def test_stream_and_batch_job_share_the_marks(spark, staged, streaming, monkeypatch):
    shape = jobs.documents.order_documents
    monkeypatch.setattr(jobs.documents, "order_documents", spoiled(shape, "o3", "o4"))
    jobs.publish_orders(spark, staged)
    monkeypatch.setattr(jobs.documents, "order_documents", spoiled(shape, "o4"))
    committed = documents(spark, staged, "orders")
    streaming()
    # Of all that the feed brings only the rejected orders are tried; one of them is fit now.
    docs = documents(spark, staged, "orders")
    assert {k for k in docs if docs[k] != committed.get(k)} == {"o3"}
    assert [r["order_id"] for r in jobs.unsynced_orders(spark, staged).collect()] == ["o4"]
    # Published feed versions are dropped but for the last.
    stage(spark, staged, ["o1"], "paid")
    streaming()
    stage(spark, staged, ["o1"], "sent")
    streaming()
    assert jobs.changes_table(spark, staged).committed() == [3]


def test_first_publication_moves_only_keys(spark, settings, monkeypatch):
    hints = []
    frame = type(spark.range(1))
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda rows, name, *of: hints.append(name) or hint(rows, name, *of))
    stage(spark, settings, ["a", "b", "c", "d"])
    hints.clear()
    assert jobs.publish_orders(spark, settings) == 4
    assert hints == []  # they lie in the buckets of the index already
    assert sorted(r["_id"] for r in index_table(spark, settings.index("orders")).read().collect()) == ["a", "b", "c", "d"]
    stage(spark, settings, ["a", "e"], status="shipped")
    hints.clear()
    assert jobs.publish_orders(spark, settings) == 2
    assert "rebalance" in hints
    found = index_table(spark, settings.index("orders")).read().collect()
    assert {r["_id"]: r["order_status"] for r in found} == dict.fromkeys("bcd", "created") | dict.fromkeys("ae", "shipped")


def test_shop_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shop_files, "FILE_ROWS", 500)
    raw = StarViews(spark, SF_SMALL)
    shop_files.write_shop_files(spark, raw, f"{tmp_path}/csv")
    folder = tmp_path / "csv" / "shop_orders_dataset.csv"
    parts = [p for p in folder.iterdir() if p.name.startswith("part-")]
    assert len(parts) > 1 and all(p.name.endswith(".csv.gz") for p in parts)
    assert all(spark.read.csv(str(p), header=True).count() <= 500 for p in parts)
    rows = read_rows(spark, str(folder), line_breaks=False)
    assert rows.count() == raw["orders"].count()
