"""Keyed document tables: whole documents replaced by id, unfit ones set aside."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.operators.conform import check_mapping
from cartflow.operators.dedup import last_per_key, repeated_key
from cartflow.settings import scratch_path
from cartflow.sources.keyed import BUCKETS, KEEP, KeyedTable
from cartflow.sources.versioned import COMPRESSION, delete_path


@dataclass(frozen=True)
class PublishResult:
    """Outcome of one publication; ``rejects`` holds ``_id`` and the unfit fields."""

    indexed: int
    errors: int
    rejects: DataFrame


#: Documents that did not fit, keyed by id; ``_version`` is the version of this table that rejected them.
REJECTS = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("unfit_fields", T.ArrayType(T.StringType())),
        T.StructField("_version", T.LongType()),
    ]
)


def index_schema(mapping: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("_id", T.StringType()), *mapping.fields, T.StructField("_version", T.LongType())]
    )


def index_table(spark: SparkSession, path: str, buckets: int = BUCKETS, keep: int = KEEP) -> KeyedTable:
    return KeyedTable(spark, path, "_id", buckets, keep)


def ensure_index(
    spark: SparkSession, path: str, mapping: T.StructType, buckets: int = BUCKETS, keep: int = KEEP
) -> KeyedTable:
    """The index at ``path``, created empty if it does not exist."""
    index = index_table(spark, path, buckets, keep)
    index.create(index_schema(mapping))
    return index


def index_count(spark: SparkSession, path: str) -> int:
    """Documents in the index; 0 if there is none or it cannot be read."""
    try:
        return index_table(spark, path).read().count()
    except Exception:
        return 0


def rejects_table(spark: SparkSession, path: str, buckets: int = BUCKETS, keep: int = KEEP) -> KeyedTable:
    """The rejects of the index at ``path``; they lie in a folder of their own within it."""
    return KeyedTable(spark, f"{path}/rejects", "_id", buckets, keep)


def pending_rejects(spark: SparkSession, path: str) -> DataFrame | None:
    """Documents rejected by any publication and not accepted since; None if there never was one."""
    return rejects_table(spark, path).read_or_none()


def identified(docs: DataFrame, mapping: T.StructType, key: str | None) -> DataFrame:
    """Documents cast to ``mapping`` with their ``_id`` (NULL if they bring none) and the names of ``_unfit`` fields."""
    checked = check_mapping(docs, mapping)
    has_key = key is not None and key in docs.columns
    doc_id = (F.col(key) if has_key else F.lit(None)).cast("string").alias("_id")
    return checked.select(doc_id, *mapping.fieldNames(), "_unfit")


def _fit(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_unfit") == 0).drop("_unfit")


def _unfit(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("_unfit") > 0).select("_id", F.col("_unfit").alias("unfit_fields"))


def split_documents(docs: DataFrame, mapping: T.StructType, key: str | None) -> tuple[DataFrame, DataFrame]:
    """Fit documents with their ``_id`` (NULL if they bring none), and the rejects."""
    checked = identified(docs, mapping, key)
    return _fit(checked), _unfit(checked)


def upsert_documents(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    mapping: T.StructType,
    key: str | None,
    order: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    keep: int = KEEP,
    keep_equal: bool = False,
    by_bucket: bool = False,
) -> PublishResult:
    """Write ``docs`` into the index at ``path``; unfit ones go to its rejects table.

    Of several documents with one id the last in ``order`` wins; without an order such ids fail the publication
    before anything is committed. Documents without an id get a random one. Writing the same documents again
    leaves the index as it is, but for ``_version``, which stays too with ``keep_equal``. The rejects table keeps the
    rejects of earlier publications until their ids are accepted. ``by_bucket`` says that ``docs`` are read from a table keyed
    by the same ids: if the index has as many buckets and no rows yet, they are written as they lie.

    The plan of ``docs`` is evaluated once: its checked documents are written down, and ids, counts, buckets,
    rejects and the merge are derived from that file. So no retried task makes other random ids or counts twice.
    """
    if order is not None and key is None:
        raise ValueError("an order needs a key")
    index, rejects = index_table(spark, path, buckets, keep), rejects_table(spark, path, buckets, keep)
    version = index.next_version()
    ranked = docs if order is None else docs.withColumn("_order", F.struct(*order))
    fields = mapping if order is None else T.StructType([*mapping.fields, ranked.schema["_order"]])
    staged_path = scratch_path(spark, "documents")
    checked = identified(ranked, fields, key)
    checked.withColumn("_id", F.coalesce("_id", F.uuid())).write.parquet(staged_path, compression=COMPRESSION)
    staged = spark.read.schema(checked.schema).parquet(staged_path)
    states = staged.select("_id", (F.size("_unfit") > 0).alias("unfit"))
    if order is not None:
        ranked_states = staged.select("_id", (F.size("_unfit") > 0).alias("unfit"), "_order")
        states = ranked_states.groupBy("_id").agg(F.max_by("unfit", "_order").alias("unfit"))
        staged = last_per_key(staged, ["_id"], ["_order"]).drop("_order")

    # At most two numbers for each bucket.
    counted = states.groupBy(index.bucket_of(F.col("_id")), "unfit").count().collect()
    indexed = sum(r["count"] for r in counted if not r["unfit"])
    errors = sum(r["count"] for r in counted if r["unfit"])
    good = _fit(staged).withColumn("_version", F.lit(version).cast("bigint"))
    if indexed:
        repeated = repeated_key(good, "_id") if order is None else None
        if repeated is not None:
            delete_path(spark, staged_path)
            raise ValueError(f"{path}: several documents with the id {repeated}")
        touched = {r[0] for r in counted if not r["unfit"]}
        stamps = ["_version"] if keep_equal else ()
        index.merge(good, version, touched=touched, stamps=stamps, by_bucket=by_bucket)
    else:
        index.create(index_schema(mapping))
    rejected = _record_rejects(spark, rejects, good.select("_id"), _unfit(staged) if errors else None)
    delete_path(spark, staged_path)
    return PublishResult(indexed, errors, rejected)


def _record_rejects(spark: SparkSession, rejects: KeyedTable, accepted: DataFrame, bad: DataFrame | None) -> DataFrame:
    """Add rejects and withdraw those accepted now: only buckets with one of either are rewritten. Returns the new ones."""
    version, withdrawn = rejects.next_version(), None
    if rejects.current() is not None and any(p["bucket"] >= 0 for p in rejects.places()):
        withdrawn = rejects.read().select("_id").join(accepted, "_id", "left_semi")
        if bad is not None:
            withdrawn = withdrawn.join(bad.select("_id"), "_id", "left_anti")
        if withdrawn.isEmpty():
            withdrawn = None
    if bad is None and withdrawn is None:
        return spark.createDataFrame([], REJECTS).drop("_version")
    if bad is None:
        rows = spark.createDataFrame([], REJECTS)
    else:
        # Several unfit documents of one id are one reject.
        once = bad.groupBy("_id").agg(F.min("unfit_fields").alias("unfit_fields"))
        rows = once.withColumn("_version", F.lit(version).cast("bigint"))
    rejects.merge(rows, version, withdrawn=withdrawn)
    return rejects.read(version).where(F.col("_version") == version).select("_id", "unfit_fields")
