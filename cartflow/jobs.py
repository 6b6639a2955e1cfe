"""The jobs: load, transform, publish, their chain, the gated publish, health."""

from __future__ import annotations

from collections.abc import Collection
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow import ledger
from cartflow.operators.changes import ROW_HASH, changed_rows, with_row_hash
from cartflow.operators.dedup import COPIES
from cartflow.operators.sync_state import rejected_rows, with_sync_flag
from cartflow.plans import documents, runs, staging
from cartflow.schemas import DOCUMENT_KEYS, DOCUMENT_SCHEMAS, RAW_TABLES, TableSpec
from cartflow.settings import Settings
from cartflow.sources.documents import PublishResult, ensure_index, index_count, index_table, rejects_table, upsert_documents
from cartflow.sources.keyed import BUCKET, KeyedTable
from cartflow.sources.raw_tables import load_table
from cartflow.sources.versioned import VersionedTable, delete_path, path_exists

ORDERS = "orders_enriched"
STAGING_KEYS = {ORDERS: "order_id", "product_revenue": "product_id", "seller_performance": "seller_id"}
LOAD_THREADS = 4


def staging_table(spark: SparkSession, settings: Settings, name: str) -> KeyedTable:
    return KeyedTable(spark, settings.staging(name), STAGING_KEYS[name], settings.buckets, settings.keep)


def raw_tables(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The loaded raw tables."""
    return {
        name: VersionedTable(spark, settings.raw(name)).read().select(*spec.columns)
        for name, spec in RAW_TABLES.items()
    }


def _load_table(spark: SparkSession, settings: Settings, spec: TableSpec) -> int:
    """Replace one raw table; returns the rows read for it."""
    table = VersionedTable(spark, settings.raw(spec.name))
    version = table.write(load_table(spark, spec, f"{settings.csv_dir}/{spec.file_name(settings.prefix)}"))
    table.expire(settings.keep)
    return table.read(version).agg(F.sum(COPIES).alias("n")).first()["n"] or 0


def load(spark: SparkSession, settings: Settings, label: str = "manual") -> int:
    """Replace every raw table by its CSV files; returns the rows read.

    Copies of a key count as read although only the first is kept. Tables load side
    by side, so the many small ones do not queue behind the large ones. If one fails, tables
    not yet begun are left as they are, and the rows of all that were replaced are recorded.
    """
    with ledger.tracked_run(spark, settings, "load", label) as run:
        with ThreadPoolExecutor(LOAD_THREADS) as pool:
            task = inheritable_thread_target(spark)(_load_table)
            loads = [pool.submit(task, spark, settings, spec) for spec in RAW_TABLES.values()]
            wait(loads, return_when=FIRST_EXCEPTION)
            for waiting in loads:
                waiting.cancel()
        ended = [task for task in loads if not task.cancelled()]
        run.rows += sum(task.result() for task in ended if task.exception() is None)
        for task in ended:
            task.result()
    return run.rows


def _upsert_staging(
    spark: SparkSession,
    settings: Settings,
    name: str,
    rows: DataFrame,
    update_columns: Collection[str] | None = None,
) -> int:
    """Commit ``rows`` into a staging table; returns how many rows it wrote or changed.

    Every row written gets the new version, so unchanged rows are published again, unless ``Settings.detect_changes``
    is set: then rows whose hash over the updated columns is that of the committed version are left out, and
    buckets without a changed row are not rewritten.
    """
    table = staging_table(spark, settings, name)
    version = table.next_version()
    now = F.lit(settings.clock()).cast("timestamp") if settings.clock else F.current_timestamp()
    stamps = ["updated_at", "row_version"]
    if settings.detect_changes:
        compared = [c for c in rows.columns if c != table.key and (update_columns is None or c in update_columns)]
        rows = changed_rows(table.read_or_none(), with_row_hash(rows, compared), table.key)
        stamps.append(ROW_HASH)
    stamped = rows.withColumns(
        {"updated_at": now, "row_version": F.lit(version).cast("bigint")}
    )
    if update_columns is not None:
        update_columns = [*update_columns, *stamps]
    table.merge(stamped, version, update_columns)
    return table.written(version).where(F.col("row_version") == version).count()


def transform(spark: SparkSession, settings: Settings, label: str = "manual") -> int:
    """Derive the staging tables from the raw ones, one commit each; returns rows written."""
    with ledger.tracked_run(spark, settings, "transform", label) as run:
        raw = raw_tables(spark, settings)
        run.rows += _upsert_staging(
            spark, settings, ORDERS, staging.orders_enriched(raw), staging.ENRICHED_UPDATES
        )
        run.rows += _upsert_staging(
            spark, settings, "product_revenue", staging.product_revenue(raw)
        )
        run.rows += _upsert_staging(
            spark,
            settings,
            "seller_performance",
            staging.seller_performance(raw),
            staging.SELLER_UPDATES,
        )
    return run.rows


#: The version through which a bucket is published, and how many buckets the staging table had then.
THROUGH = "bucket int, version bigint, buckets int"


def _through_table(spark: SparkSession, settings: Settings) -> VersionedTable:
    return VersionedTable(spark, settings.sync_state("orders_through"))


class SyncState:
    """Up to which staging version each bucket of the orders is published; rejected orders are the index's rejects.

    The state holds one small row for each bucket. If the staging table was dealt into another number of buckets,
    everything waits again: publishing a document twice leaves the index as it is.
    """

    def __init__(self, spark: SparkSession, settings: Settings) -> None:
        self.spark, self.settings = spark, settings
        self.table = staging_table(spark, settings, ORDERS)
        self.places = {p["bucket"]: p["version"] for p in self.table.places() if p["bucket"] >= 0}
        self.buckets = self.table.bucket_count()
        marks = _through_table(spark, settings)
        marked = marks.current()
        rows = [] if marked is None else spark.read.schema(THROUGH).parquet(marks.folder(marked)).collect()
        self.through = {r["bucket"]: r["version"] for r in rows if r["buckets"] == self.buckets}

    def through_column(self) -> Column:
        """The version through which the bucket of a row is published."""
        versions = F.array(*[F.lit(self.through.get(b, 0)).cast("bigint") for b in range(self.buckets)])
        return F.element_at(versions, F.col(BUCKET) + 1)

    def mark(self, buckets: Collection[int], version: int) -> None:
        """Record that these buckets are published through ``version``."""
        self.through |= dict.fromkeys(buckets, version)
        rows = [(b, v, self.buckets) for b, v in self.through.items()]
        state = _through_table(self.spark, self.settings)
        state.write(self.spark.createDataFrame(rows, THROUGH).coalesce(1))
        state.expire(self.settings.keep)

    def rejected(self) -> DataFrame | None:
        """Ids of the orders that were rejected; None if there are none."""
        path = self.settings.index("orders")
        rejects = rejects_table(self.spark, path)
        if rejects.current() is None or all(p["bucket"] < 0 for p in rejects.places()):
            return None
        kind = self.table.read().schema["order_id"].dataType
        return rejects.read().select(F.col("_id").cast(kind).alias("order_id"))

    def fresh(self) -> set[int]:
        """Buckets written since they were published."""
        return {b for b, version in self.places.items() if version > self.through.get(b, 0)}

    def retried(self, rejected: DataFrame | None) -> set[int]:
        """Buckets of rejected orders: nothing else is read to try them again."""
        return set() if rejected is None else self.table.buckets_of(rejected, self.buckets)

    def waiting(self, fresh: Collection[int], retried: Collection[int], rejected: DataFrame | None) -> DataFrame:
        """Waiting orders of these buckets, with their bucket."""
        through = self.through_column()
        rows = self.table.read(buckets=fresh, with_bucket=True).where(F.col("row_version") > through)
        if not retried:
            return rows
        held = self.table.read(buckets=retried, with_bucket=True)
        return rows.unionByName(rejected_rows(held, through, rejected, ["order_id"]))


def orders_table(spark: SparkSession, settings: Settings) -> DataFrame:
    """Enriched orders with ``synced_to_es``."""
    state = SyncState(spark, settings)
    rows = state.table.read(with_bucket=True)
    return with_sync_flag(rows, state.through_column(), state.rejected(), ["order_id"]).drop(BUCKET)


def unsynced_orders(spark: SparkSession, settings: Settings) -> DataFrame:
    """Orders that wait: of buckets written since their publication, and rejected ones."""
    state = SyncState(spark, settings)
    rejected = state.rejected()
    return state.waiting(state.fresh(), state.retried(rejected), rejected).drop(BUCKET)


def publish_orders(spark: SparkSession, settings: Settings) -> int:
    """Publish all waiting orders and mark them; returns documents written.

    ``Settings.batch`` buckets at a time are published and then marked, so a crash repeats one such batch at most,
    and the next call goes on with the rest. The batch job and the stream share this state.
    """
    if staging_table(spark, settings, ORDERS).current() is None:
        return 0
    ensure_index(spark, settings.index("orders"), DOCUMENT_SCHEMAS["orders"], settings.buckets, settings.keep)
    state = SyncState(spark, settings)
    version = state.table.current()
    fresh, retried = state.fresh(), state.retried(state.rejected())
    waiting = sorted(fresh | retried)
    indexed = 0
    for at in range(0, len(waiting), settings.batch):
        batch = set(waiting[at : at + settings.batch])
        # The rejects are read anew, as each batch replaces the files of the ones it accepts.
        rows = state.waiting(fresh & batch, retried & batch, state.rejected() if retried & batch else None)
        indexed += _publish_order_rows(spark, settings, rows, by_bucket=state.buckets == settings.buckets).indexed
        # Marked only after the documents are committed: a crash in between publishes
        # the same documents again, which leaves the index unchanged.
        if batch & fresh:
            state.mark(batch & fresh, version)
    return indexed


def _publish_order_rows(
    spark: SparkSession, settings: Settings, rows: DataFrame, keep_equal: bool = False, by_bucket: bool = False
) -> PublishResult:
    return upsert_documents(
        spark,
        documents.order_documents(rows, iso_dates=False),
        settings.index("orders"),
        DOCUMENT_SCHEMAS["orders"],
        DOCUMENT_KEYS["orders"],
        buckets=settings.buckets,
        keep=settings.keep,
        keep_equal=keep_equal,
        by_bucket=by_bucket,
    )


def changes_table(spark: SparkSession, settings: Settings) -> VersionedTable:
    """The feed of changed orders: the rows that staging versions wrote, under the number of the last of them."""
    return VersionedTable(spark, settings.changes(ORDERS))


def append_changes(spark: SparkSession, settings: Settings) -> int | None:
    """Bring the feed up to the committed staging version, which is returned.

    The feed is written after the commit, so it never holds rows of a failed version. A feed write that died is
    done again; its readers drop what comes twice. Versions that all buckets are published through are dropped.
    """
    committed = staging_table(spark, settings, ORDERS).current()
    if committed is None:
        return None
    feed, state = changes_table(spark, settings), SyncState(spark, settings)
    last = feed.current()
    if last is None or last < committed:
        rows = state.table.read(since=last)
        if path_exists(spark, feed.folder(committed)):
            delete_path(spark, feed.folder(committed))
        feed.write(rows if last is None else rows.where(F.col("row_version") > last), committed)
    published = min((state.through.get(b, 0) for b in state.places), default=0)
    for version in feed.committed():
        if version <= published and version < committed:
            delete_path(spark, feed.folder(version))
    return committed


def publish_changes(spark: SparkSession, settings: Settings, changed: DataFrame, version: int) -> int:
    """Publish one batch of changed orders, one row for each order, and all rejected ones; then mark ``version``.

    Rows that the batch job has published meanwhile are left out, unless they were rejected. Equal documents stay as they are,
    so a batch that comes again changes nothing. ``changed`` is evaluated once.
    """
    ensure_index(spark, settings.index("orders"), DOCUMENT_SCHEMAS["orders"], settings.buckets, settings.keep)
    state = SyncState(spark, settings)
    dealt = changed.withColumn(BUCKET, state.table.bucket_of(F.col("order_id")))
    rows = dealt.where(F.col("row_version") > state.through_column())
    rejected = state.rejected()
    if rejected is not None:
        again = state.table.read(buckets=state.retried(rejected), with_bucket=True)
        rows = rows.unionByName(rejected_rows(again, state.through_column(), rejected, ["order_id"]))
    result = _publish_order_rows(spark, settings, rows, keep_equal=True)
    behind = {b for b in state.places if state.through.get(b, 0) < version}
    if behind:
        state.mark(behind, version)
    return result.indexed


def _publish_all(spark: SparkSession, settings: Settings, kind: str, name: str, shape) -> int:
    rows = staging_table(spark, settings, name).read_or_none()
    if rows is None or rows.isEmpty():
        return 0
    result = upsert_documents(
        spark,
        shape(rows),
        settings.index(kind),
        DOCUMENT_SCHEMAS[kind],
        DOCUMENT_KEYS[kind],
        buckets=settings.buckets,
        keep=settings.keep,
    )
    return result.indexed


def publish(spark: SparkSession, settings: Settings, label: str = "manual") -> int:
    """Publish unsynced orders and all products and sellers; returns documents written."""
    for kind, mapping in DOCUMENT_SCHEMAS.items():
        ensure_index(spark, settings.index(kind), mapping, settings.buckets, settings.keep)
    with ledger.tracked_run(spark, settings, "sync", label) as run:
        run.rows += publish_orders(spark, settings)
        run.rows += _publish_all(
            spark, settings, "products", "product_revenue", documents.product_documents
        )
        run.rows += _publish_all(
            spark, settings, "sellers", "seller_performance", documents.seller_documents
        )
    return run.rows


def publish_if_needed(spark: SparkSession, settings: Settings, label: str = "scheduled") -> dict[str, object]:
    """Publish only if some order is unsynced; otherwise products and sellers wait too."""
    if staging_table(spark, settings, ORDERS).current() is None:
        waiting = 0
    else:
        waiting = unsynced_orders(spark, settings).count()
    if waiting == 0:
        return {"status": "skipped", "unsynced": 0, "documents": 0}
    return {"status": "success", "unsynced": waiting, "documents": publish(spark, settings, label)}


def run_all(spark: SparkSession, settings: Settings, label: str = "full") -> dict[str, int]:
    """Load, transform and publish; the rows of each stage."""
    return {
        "load": load(spark, settings, label),
        "transform": transform(spark, settings, label),
        "sync": publish(spark, settings, label),
    }


def health(spark: SparkSession, settings: Settings) -> DataFrame:
    """Check rows for the data under ``settings.root``."""
    empty = spark.range(0)
    orders = VersionedTable(spark, settings.raw("orders")).read_or_none()
    docs = index_table(spark, settings.index("orders")).read_or_none()
    return runs.health_checks(
        empty if orders is None else orders,
        empty if docs is None else docs,
        ledger.runs(spark, settings),
    )


def require_healthy(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Counted values by check; raises if a check failed."""
    checks = health(spark, settings).collect()  # three rows
    failed = [f"{r['check_name']}={r['value']}" for r in checks if not r["ok"]]
    if failed:
        raise ValueError("health checks failed: " + ", ".join(failed))
    return {r["check_name"]: r["value"] for r in checks}


__all__ = [
    "health",
    "index_count",
    "load",
    "orders_table",
    "publish",
    "publish_if_needed",
    "publish_orders",
    "raw_tables",
    "require_healthy",
    "run_all",
    "staging_table",
    "transform",
    "unsynced_orders",
]
