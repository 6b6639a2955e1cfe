"""Connected components of a graph of long ids, by contraction, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm.common import materialize


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the smallest node it is connected with.

    A round points every node at its smallest neighbour, follows these pointers twice and puts
    the pointers' targets into the edges; edges inside one target vanish. The targets of a round are
    fewer than its nodes, so the rounds end. Smallest neighbours are an aggregate with a map-side
    step, and look-ups of a hot target are plain joins, which AQE splits; no task holds a component.
    """
    left = materialize(
        spark,
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(),
        f"{name}-edges",
    )
    found = spark.createDataFrame([], "node bigint, root bigint")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("v"))
        for _ in range(2):
            near = materialize(spark, near, f"{name}-near")
            near = near.join(near.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").select(
                "u", F.col("w").alias("v")
            )
        near = materialize(spark, near, f"{name}-near")
        new = near.select(F.col("u").alias("node"), F.col("v").alias("root"))
        moved = found.join(near, found.root == near.u, "left").select("node", F.coalesce("v", "root").alias("root"))
        found = materialize(
            spark, moved.unionByName(new.join(found, "node", "left_anti")), f"{name}-found"
        )
        ends = left.join(near, left.a == near.u).select(F.col("v").alias("p"), "b")
        ends = ends.join(near, ends.b == near.u).select("p", F.col("v").alias("q"))
        left = materialize(
            spark,
            ends.filter("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(),
            f"{name}-edges",
        )
    return found
