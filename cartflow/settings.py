"""Run settings, the session used by local runs, and the scratch folder rule."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import SparkSession

#: Join and sizing settings every job relies on; a cluster may override them.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call sites of every column cost several gateway calls each while a plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


@dataclass(frozen=True)
class Settings:
    """Where data lies and what the document indices are called."""

    csv_dir: str
    root: str
    indices: dict[str, str] = field(
        default_factory=lambda: {"orders": "orders", "products": "products", "sellers": "sellers"}
    )
    #: What file names start with; only these exact names are loaded.
    prefix: str = "shop"
    #: Buckets of a new keyed table: what one changed key rewrites is the table's size divided by them. Take one
    #: for each 1 to 4 GB of Parquet that the table will hold; ``KeyedTable.deal`` gives a grown table more.
    buckets: int = 16
    #: Buckets of orders that are published and marked together: a crash repeats as many at most.
    batch: int = 8
    #: Whether a transform leaves rows alone that it derives just as they are; by default it writes all of them.
    detect_changes: bool = False
    #: What time it is, for recorded times; the clock of the machines if not given.
    clock: Callable[[], datetime] | None = None
    #: Committed versions that stay readable; older ones are dropped after each commit.
    keep: int = 3

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        return cls(
            csv_dir=env["CARTFLOW_CSV_DIR"],
            root=env["CARTFLOW_ROOT"],
            indices={
                "orders": env.get("CARTFLOW_INDEX_ORDERS", "orders"),
                "products": env.get("CARTFLOW_INDEX_PRODUCTS", "products"),
                "sellers": env.get("CARTFLOW_INDEX_SELLERS", "sellers"),
            },
            prefix=env.get("CARTFLOW_CSV_PREFIX", "shop"),
            buckets=int(env.get("CARTFLOW_BUCKETS", "16")),
            batch=int(env.get("CARTFLOW_BATCH", "8")),
            detect_changes=env.get("CARTFLOW_DETECT_CHANGES", "").lower() in ("1", "true", "yes"),
            keep=int(env.get("CARTFLOW_KEEP_VERSIONS", "3")),
        )

    def raw(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    def staging(self, table: str) -> str:
        return f"{self.root}/staging/{table}"

    def index(self, kind: str) -> str:
        return f"{self.root}/documents/{self.indices[kind]}"

    def sync_state(self, name: str) -> str:
        return f"{self.root}/sync/{name}"

    def changes(self, table: str) -> str:
        return f"{self.root}/changes/{table}"


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cartflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach.

    Lies under ``spark.checkpoint.dir``. Only a local session may go without that
    setting: a machine-local folder would be invisible to other executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        # local-cluster has executors of its own, which do not share the driver's folders.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="cartflow-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
