"""Keyed Parquet tables that rewrite only the buckets a merge touches.

Rows lie in buckets by the hash of their key: ``data/_v=N/_bucket=B`` holds bucket ``B`` as version ``N`` wrote it. A version's
manifest names the version that holds each bucket, so untouched buckets are carried by reference. The manifest is
a ``VersionedTable`` and is written last: a version counts once its manifest is committed, and a failed write is never seen.

The number of buckets is set when a table is created. It bounds the rows of the manifest and what a small
merge rewrites (one bucket for one key); it is no limit on the data, as a bucket may hold any number of files.
``deal`` gives a table another number. Keys are dealt by their text, so tables that hold one key as a number and as
text (a staging table and its document index) have it in the same bucket if they have the same number of buckets.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartflow.operators.upsert import upsert
from cartflow.settings import scratch_path
from cartflow.sources.versioned import COMPRESSION, VersionedTable, child_names, delete_path

BUCKETS = 16
MANIFEST = "bucket int, version bigint, buckets int, schema string"
BUCKET = "_bucket"
#: Committed versions that stay readable.
KEEP = 3


class KeyedTable:
    """The table under ``path`` with unique values of ``key``; its writer must be the only one."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS, keep: int = KEEP) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets, self.keep = buckets, keep
        self.manifest = VersionedTable(spark, f"{self.path}/manifest")
        self._places: dict[int, list[T.Row]] = {}  # of committed versions, which never change

    # --- reading ---

    def current(self) -> int | None:
        """Highest committed version."""
        return self.manifest.current()

    def next_version(self) -> int:
        """A number above every version ever started, failed ones included."""
        started = [int(n[3:]) for n in child_names(self.spark, f"{self.path}/data") if n.startswith("_v=")]
        return max([self.manifest.next_version() - 1, *started]) + 1

    def places(self, version: int | None = None) -> list[T.Row]:
        """``bucket``, ``version``, ``buckets`` and ``schema`` of every bucket: at most as many rows as buckets."""
        chosen = self.current() if version is None else version
        if chosen is None:
            raise FileNotFoundError(f"no committed version of {self.path}")
        if chosen not in self._places:
            rows = self.spark.read.schema(MANIFEST).parquet(self.manifest.folder(chosen)).collect()
            self._places[chosen] = sorted(rows, key=lambda r: r["bucket"])
        return self._places[chosen]

    def _rows(self, places: list[T.Row], schema: T.StructType, with_bucket: bool = False) -> DataFrame:
        if not places:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(BUCKET, F.lit(0)) if with_bucket else empty
        folders = [f"{self.path}/data/_v={p['version']}/{BUCKET}={p['bucket']}" for p in places]
        rows = self.spark.read.option("basePath", f"{self.path}/data").schema(schema).parquet(*folders)
        return rows.select(*schema.fieldNames(), *([BUCKET] if with_bucket else []))

    def read(
        self,
        version: int | None = None,
        since: int | None = None,
        buckets: Collection[int] | None = None,
        with_bucket: bool = False,
    ) -> DataFrame:
        """All rows of a version, or those of some buckets only; ``since`` names those written after that version."""
        places = self.places(version)
        schema = T.StructType.fromJson(_json(places[0]["schema"]))
        chosen = [
            p
            for p in places
            if p["bucket"] >= 0 and (since is None or p["version"] > since) and (buckets is None or p["bucket"] in buckets)
        ]
        return self._rows(chosen, schema, with_bucket)

    def read_or_none(self) -> DataFrame | None:
        chosen = self.current()
        return None if chosen is None else self.read(chosen)

    def written(self, version: int) -> DataFrame:
        """All rows of the buckets that ``version`` wrote."""
        places = self.places(version)
        schema = T.StructType.fromJson(_json(places[0]["schema"]))
        return self._rows([p for p in places if p["version"] == version and p["bucket"] >= 0], schema)

    def bucket_count(self) -> int:
        """Buckets of the committed table, or those a first commit will have."""
        committed = self.current()
        return self.buckets if committed is None else self.places(committed)[0]["buckets"]

    def bucket_of(self, key: Column) -> Column:
        """The bucket of a key of this table."""
        return _bucket_of(key, self.bucket_count())

    # --- writing ---

    def _commit(self, version: int, places: dict[int, int], buckets: int, schema: T.StructType) -> None:
        # Bucket -1 holds no rows; it keeps the schema of a table without any.
        rows = [(b, v, buckets, schema.json()) for b, v in {-1: version, **places}.items()]
        manifest = self.spark.createDataFrame(rows, MANIFEST)
        self.manifest.write(manifest.coalesce(1), version)
        place = T.Row("bucket", "version", "buckets", "schema")
        self._places[version] = sorted((place(*row) for row in rows), key=lambda r: r["bucket"])
        self.expire()

    def create(self, schema: T.StructType) -> None:
        """Commit an empty version unless the table has one."""
        if self.current() is None:
            self._commit(self.next_version(), {}, self.buckets, schema)

    def _write(self, rows: DataFrame, version: int, buckets: int, by_bucket: bool = False) -> dict[int, int]:
        """Write rows into their buckets; the version of each bucket that got any.

        ``by_bucket`` says that the tasks find the rows of a bucket together, so that they need not be moved.
        """
        folder = f"{self.path}/data/_v={version}"
        dealt = rows.withColumn(BUCKET, _bucket_of(F.col(self.key), buckets))
        # Large buckets become several files, small ones a file each.
        placed = dealt if by_bucket else dealt.hint("rebalance", BUCKET)
        placed.write.mode("error").partitionBy(BUCKET).parquet(folder, compression=COMPRESSION)
        names = (n for n in child_names(self.spark, folder) if n.startswith(f"{BUCKET}="))
        return {int(n.split("=")[1]): version for n in names}

    def merge(
        self,
        new: DataFrame,
        version: int | None = None,
        update_columns: Collection[str] | None = None,
        withdrawn: DataFrame | None = None,
        stamps: Collection[str] = (),
        touched: Collection[int] | None = None,
        by_bucket: bool = False,
    ) -> int:
        """Commit ``new`` merged into the table (see ``upsert``); only the buckets of its keys are read and rewritten.

        The plan of ``new`` is evaluated once: unless the table is still empty, its rows are written down first. A caller
        that reads them from a file anyway names their buckets in ``touched``, and says with ``by_bucket`` if the file holds the
        rows of a bucket together. ``withdrawn`` holds keys that leave the table.
        """
        version = self.next_version() if version is None else version
        committed = self.current()
        held = self.places(committed) if committed is not None else []
        buckets = held[0]["buckets"] if held else self.buckets
        places = {p["bucket"]: p["version"] for p in held if p["bucket"] >= 0}
        staged, old = None, None
        if places:
            if touched is None:
                staged = scratch_path(self.spark, "merge")
                new.write.parquet(staged, compression=COMPRESSION)
                new = self.spark.read.schema(new.schema).parquet(staged)
                touched = self.buckets_of(new, buckets)
            if withdrawn is not None:
                touched = {*touched, *self.buckets_of(withdrawn, buckets)}
            known = T.StructType.fromJson(_json(held[0]["schema"]))
            # Columns that the table does not have yet are NULL in its old rows.
            schema = T.StructType([*known.fields, *[f for f in new.schema.fields if f.name not in known.names]])
            rewritten = [p for p in held if p["bucket"] in touched]
            old = self._rows(rewritten, schema) if rewritten else None
        merged = upsert(old, new, self.key, update_columns, withdrawn, stamps)
        # A join with rows of the table moves the new ones anyway.
        found = self._write(merged, version, buckets, by_bucket and old is None)
        untouched = {b: v for b, v in places.items() if b not in touched}
        self._commit(version, {**untouched, **found}, buckets, merged.schema)
        if staged is not None:
            delete_path(self.spark, staged)
        return version

    def buckets_of(self, rows: DataFrame, buckets: int | None = None) -> set[int]:
        """The buckets of the keys of ``rows``: at most as many numbers as there are buckets."""
        count = self.bucket_count() if buckets is None else buckets
        return {r[0] for r in rows.select(_bucket_of(F.col(self.key), count)).distinct().collect()}

    def deal(self, buckets: int) -> int:
        """Commit all rows in another number of buckets, which the table keeps from then on."""
        version, rows = self.next_version(), self.read()
        self._commit(version, self._write(rows, version, buckets), buckets, rows.schema)
        return version

    def expire(self) -> None:
        """Drop old manifests and the folders of buckets that the kept versions do not use."""
        if len(self.manifest.committed()) <= self.keep:
            return
        self.manifest.expire(self.keep)
        kept = self.manifest.committed()
        unread = [v for v in kept if v not in self._places]
        manifests = [p for v in kept if v in self._places for p in self._places[v]]
        if unread:
            manifests += self.spark.read.schema(MANIFEST).parquet(*[self.manifest.folder(v) for v in unread]).collect()
        used = {(p["version"], p["bucket"]) for p in manifests}
        newest = max(kept)
        for folder in child_names(self.spark, f"{self.path}/data"):
            if not folder.startswith("_v=") or int(folder[3:]) > newest:
                continue
            version = int(folder[3:])
            buckets = {b for v, b in used if v == version}
            if not buckets - {-1}:
                delete_path(self.spark, f"{self.path}/data/{folder}")
                continue
            for child in child_names(self.spark, f"{self.path}/data/{folder}"):
                if child.startswith(f"{BUCKET}=") and int(child.split("=")[1]) not in buckets:
                    delete_path(self.spark, f"{self.path}/data/{folder}/{child}")


def _bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int").alias(BUCKET)


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def read_pattern(spark: SparkSession, folder: str, pattern: str, key: str) -> DataFrame | None:
    """All rows of the tables below ``folder`` whose names match ``pattern`` (``*`` for any text), with ``_index``.

    A column that a table does not have is NULL there. None if no table matches.
    """
    from fnmatch import fnmatchcase

    rows = None
    for name in child_names(spark, folder):
        if not fnmatchcase(name, pattern):
            continue
        table = KeyedTable(spark, f"{folder}/{name}", key)
        if table.current() is None:
            continue
        own = table.read().withColumn("_index", F.lit(name))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    return rows
