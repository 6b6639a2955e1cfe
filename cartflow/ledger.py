"""Run ledger: a table of start and finish events.

It holds a few rows for each run, so every event writes it anew as one small file and drops old versions; the
number of files does not grow with the runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.plans.runs import run_state
from cartflow.schemas import RUN_EVENTS
from cartflow.settings import Settings
from cartflow.sources.versioned import VersionedTable


@dataclass
class Run:
    """A run in progress; ``rows`` is what gets recorded when it ends."""

    run_id: int
    rows: int = 0


def _table(spark: SparkSession, settings: Settings) -> VersionedTable:
    return VersionedTable(spark, settings.staging("run_events"))


def events(spark: SparkSession, settings: Settings) -> DataFrame:
    found = _table(spark, settings).read_or_none()
    return spark.createDataFrame([], RUN_EVENTS) if found is None else found


def runs(spark: SparkSession, settings: Settings) -> DataFrame:
    """Present state of every run."""
    return run_state(events(spark, settings))


def _append(spark: SparkSession, settings: Settings, *event: object) -> None:
    table = _table(spark, settings)
    table.write(events(spark, settings).unionByName(spark.createDataFrame([event], RUN_EVENTS)).coalesce(1))
    table.expire(settings.keep)


def _now(settings: Settings) -> datetime:
    return settings.clock() if settings.clock else datetime.now(timezone.utc).replace(tzinfo=None)


@contextmanager
def tracked_run(spark: SparkSession, settings: Settings, run_type: str, label: str = "manual") -> Iterator[Run]:
    """Record the start and the end of a stage; a failure is recorded and raised again.

    Run numbers count up from the highest one; jobs of one root run one at a time.
    """
    last = events(spark, settings).agg(F.max("run_id").alias("id")).first()["id"]
    run = Run((last or 0) + 1)
    _append(spark, settings, run.run_id, label, run_type, 0, "running", 0, _now(settings), None)
    try:
        yield run
    except Exception as error:
        _append(spark, settings, run.run_id, label, run_type, 1, "failed", run.rows, _now(settings), str(error))
        raise
    _append(spark, settings, run.run_id, label, run_type, 1, "success", run.rows, _now(settings), None)
