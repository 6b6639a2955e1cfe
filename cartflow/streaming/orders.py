"""The order publication as a stream of changed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartflow import jobs
from cartflow.settings import Settings


def changed_orders(spark: SparkSession, settings: Settings) -> DataFrame:
    """Stream of the feed of changed orders: the rows that committed staging versions wrote.

    The feed may bring a row twice, after a feed write that died half-way.
    """
    feed = jobs.changes_table(spark, settings)
    stream = spark.readStream.schema(feed.read().schema)
    # Feed versions are dropped once they are published; the sync state covers their rows.
    return stream.option("ignoreMissingFiles", "true").parquet(f"{feed.path}/v=*")


def newest_by_order(changes: DataFrame) -> DataFrame:
    """The newest row of each order that a batch brings something for.

    Keyed state: one row for each order, however many versions have written it, and none for versions or batches.
    An older row that comes late or again brings the newest one once more.
    """
    rest = [c for c in changes.columns if c != "order_id"]
    newest = changes.groupBy("order_id").agg(F.max_by(F.struct(*rest), "row_version").alias("_row"))
    return newest.select("order_id", *[f"_row.{c}" for c in rest])


def publish_orders_stream(spark: SparkSession, settings: Settings, checkpoint: str) -> StreamingQuery:
    """Publish what has been committed since the last call, then stop.

    Progress and state of the stream lie in ``checkpoint``; what is published lies in the sync state, which the batch
    publication shares. So neither publishes again what the other has published, rejected orders are tried
    again with each batch, and a batch that is repeated after a crash leaves documents and their versions as they are.
    """
    version = jobs.append_changes(spark, settings)

    def write(batch: DataFrame, _: int) -> None:
        jobs.publish_changes(batch.sparkSession, settings, batch, version)

    return (
        newest_by_order(changed_orders(spark, settings))
        .writeStream.outputMode("update")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
