"""Keyed merge of a new set of rows into an old one."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    old: DataFrame | None,
    new: DataFrame,
    key: str,
    update_columns: Collection[str] | None = None,
    withdrawn: DataFrame | None = None,
    stamps: Collection[str] = (),
) -> DataFrame:
    """Rows of ``old`` overwritten by ``new`` on ``key``; unmatched rows of both are kept.

    On a match only ``update_columns`` (default: all) take the new value, NULLs
    included; the other columns keep the value of their first insert. Rows of ``old`` whose key is in ``withdrawn`` go.
    Columns in ``stamps`` say when a row was written: a match that changes nothing else leaves the row as it was.
    All inputs must hold a key at most once, and no key may be both new and withdrawn.
    """
    if old is None:
        return new
    updated = set(new.columns if update_columns is None else update_columns)
    before = old.select(F.struct(*new.columns).alias("o"), F.col(key))
    after = new.select(F.struct(*new.columns).alias("n"), F.col(key), F.lit(False).alias("w"))
    if withdrawn is not None:
        nothing = F.lit(None).cast(after.schema["n"].dataType).alias("n")
        after = after.unionByName(withdrawn.select(nothing, F.col(key), F.lit(True).alias("w")))
    merged = before.join(after, key, "full_outer").where(~F.coalesce("w", F.lit(False)))
    had, got = F.col("o").isNotNull(), F.col("n").isNotNull()
    if stamps:
        compared = [c for c in new.columns if c in updated and c not in stamps and c != key]
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in compared]
        changed = ~F.array_min(F.array(*same)) if same else F.lit(False)
        got = got & (~had | changed)
    result = [F.col(key)]
    for name in new.columns:
        if name == key:
            continue
        was, now = F.col(f"o.{name}"), F.col(f"n.{name}")
        value = F.when(got, now).otherwise(was) if name in updated else F.when(had, was).otherwise(now)
        result.append(value.alias(name))
    return merged.select(*result).select(*new.columns)
