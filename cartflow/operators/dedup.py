"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "load_copies"


def first_per_key(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """First row of every key in ``order``, with the number of copies in ``load_copies``.

    ``columns`` (default: all) are kept. An aggregate rather than a ranking window: copies of a key meet in the map
    tasks first, so a key holding most of the rows sends one row per map task.
    """
    kept = rows.columns if columns is None else columns
    rest = [c for c in kept if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    if not rest:
        return rows.groupBy(*keys).agg(F.count("*").alias(COPIES))
    picked = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), rank).alias("_first"),
        F.count("*").alias(COPIES),
    )
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in kept], COPIES
    )


def repeated_key(rows: DataFrame, key: str) -> object | None:
    """A value of ``key`` that stands twice; None if there is none. Only keys are shuffled, the rows stay where they are."""
    found = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).agg(F.min(key).alias("key")).first()
    return found["key"]


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Last row of every key in ``order``: the last write wins."""
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_last"))
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns]
    )
