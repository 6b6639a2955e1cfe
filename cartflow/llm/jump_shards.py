"""Sharding by jump consistent hashing, in built-in expressions only.

Keys are bigints; the mapping needs no table, and with one more shard a row either stays or moves
into the new shard. NULL keys hash like the key 0 and so lie together; rows with equal keys share a
shard, and slots tell them apart. Only the key and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartflow.llm.common import materialize, table

#: Multiplier of the generator of Lamping and Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm" (fixed value).
MULTIPLIER = 2862933555777941757
SHARDS = 24
ROW_OVERHEAD = 8
_LOW = (1 << 22) - 1


def _next_key(key: Column) -> Column:
    """``key * MULTIPLIER + 1`` modulo 2**64, in limbs of 22 bits so that no product overflows."""
    a = [key.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, 22).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, 44)]
    c = [F.lit((MULTIPLIER >> s) & _LOW).cast("bigint") for s in (0, 22, 44)]
    low = a[0] * c[0] + F.lit(1)
    mid = a[0] * c[1] + a[1] * c[0] + F.shiftrightunsigned(low, 22)
    high = a[0] * c[2] + a[1] * c[1] + a[2] * c[0] + F.shiftrightunsigned(mid, 22)
    return (
        low.bitwiseAND(F.lit(_LOW))
        .bitwiseOR(F.shiftleft(mid.bitwiseAND(F.lit(_LOW)), 22))
        .bitwiseOR(F.shiftleft(high, 44))
    )


def _jumps(key: Column, shards: int, steps: int) -> Column:
    """State after ``steps`` jumps: ``shard`` below ``shards``, ``grown`` below ``shards + 1``, next ``jump``, ``key``.

    Both shard counts draw the same jumps, so one run serves them.
    """

    def step(state: Column, _: Column) -> Column:
        key = _next_key(state["key"])
        draw = F.shiftrightunsigned(key, 33) + F.lit(1)
        jump = F.floor((state["jump"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double")))
        moved = F.struct(
            F.when(state["jump"] < shards, state["jump"]).otherwise(state["shard"]).alias("shard"),
            state["jump"].alias("grown"),
            jump.cast("bigint").alias("jump"),
            key.alias("key"),
        )
        return F.when(state["jump"] > shards, state).otherwise(moved)

    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.lit(-1).cast("bigint").alias("shard"), F.lit(-1).cast("bigint").alias("grown"), zero.alias("jump"), key.alias("key")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def jump_shard(key: Column, shards: int) -> Column:
    """Struct of ``shard`` (of ``shards``) and ``grown`` (of one more) for a bigint key.

    A key needs about ln(shards) jumps and never more than ``shards + 2``. Keys that are not done after
    64 jumps, if any, are run again with that bound, so the result is exact for any number of shards.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    short = _jumps(key, shards, min(64, shards + 2))
    if shards + 2 <= 64:
        done = short
    else:
        done = F.get(
            F.transform(
                F.array(short), lambda s: F.when(s["jump"] > shards, s).otherwise(_jumps(key, shards, shards + 2))
            ),
            F.lit(0),
        )
    return done


def with_slots(spark: SparkSession, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``: their place within ``group`` in ``order``, gapless from 0.

    A group may hold any number of rows: ranges over (group, order) split it among tasks, each task
    numbers its own rows, and a table of one count for each range and group gives the rows before
    them. Rows equal in everything are interchangeable; their scan place only splits them.
    """
    tie = "__place"
    ranged = (
        rows.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(group, *order, tie)
        .withColumn("__range", F.spark_partition_id())
    )
    ranged = materialize(spark, ranged, "slots")
    counts = ranged.groupBy("__range", group).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(
        F.sum("__n").over(Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    counts = counts.select("__range", group, before.alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range", group).orderBy(*order, tie))
    return (
        ranged.withColumn("__own", own)
        .join(counts, ["__range", group])
        .withColumn("slot", (F.col("__before") + F.col("__own") - 1).cast("bigint"))
        .drop("__range", "__own", "__before", tie)
    )


def sharded(
    spark: SparkSession, docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard, slot and shard after growth of every row; a NULL text has no bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        jump_shard(F.col(id_col), shards).alias("jump"),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("jump.shard").cast("int").alias("shard"),
        F.col("jump.grown").cast("int").alias("grown_shard"),
    )
    return with_slots(spark, rows, "shard", ["doc_id", "text_crc32", "size"])


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards."""
    found = sharded(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
