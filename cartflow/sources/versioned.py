"""Parquet tables that are replaced as a whole, one folder per version.

A version is committed when its write has left a ``_SUCCESS`` marker, which
Spark's committer writes last. Readers take the highest committed version, so a
failed or running write is never seen, and no job overwrites what it reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Takes about a quarter less room than Spark's default.
COMPRESSION = "zstd"

_VERSION = re.compile(r"^v=(\d+)$")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below ``path``; empty if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class VersionedTable:
    """One table under ``path``; the writer of a table must be the only one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def _started(self) -> list[int]:
        names = (_VERSION.match(n) for n in child_names(self.spark, self.path))
        return sorted((int(m.group(1)) for m in names if m), reverse=True)

    def current(self) -> int | None:
        """Highest committed version."""
        for version in self._started():
            if path_exists(self.spark, f"{self.folder(version)}/_SUCCESS"):
                return version
        return None

    def committed(self) -> list[int]:
        """All committed versions, the newest first."""
        return [v for v in self._started() if path_exists(self.spark, f"{self.folder(v)}/_SUCCESS")]

    def next_version(self) -> int:
        """A number above every version ever started, failed ones included."""
        return max(self._started(), default=0) + 1

    def read(self, version: int | None = None) -> DataFrame:
        chosen = self.current() if version is None else version
        if chosen is None:
            raise FileNotFoundError(f"no committed version of {self.path}")
        return self.spark.read.parquet(self.folder(chosen))

    def read_or_none(self) -> DataFrame | None:
        chosen = self.current()
        return None if chosen is None else self.read(chosen)

    def write(self, rows: DataFrame, version: int | None = None) -> int:
        chosen = self.next_version() if version is None else version
        (
            rows.write.mode("error")
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
            .parquet(self.folder(chosen), compression=COMPRESSION)
        )
        return chosen

    def expire(self, keep: int) -> None:
        """Delete all but the last ``keep`` committed versions and what was started before them."""
        committed = self.committed()
        if keep < 1 or len(committed) <= keep:
            return
        for version in self._started():
            if version < committed[keep - 1]:
                delete_path(self.spark, self.folder(version))

    def create(self, schema: T.StructType) -> None:
        """Commit an empty version unless the table has one."""
        if self.current() is None:
            self.write(self.spark.createDataFrame([], schema))
