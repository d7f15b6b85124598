"""JRN-13: running journey metrics over an event stream.

``groupBy(journey, provider)`` in update mode keeps one state row per pair;
each micro-batch upserts the changed pairs and their journeys into two bucketed
tables that are committed together, so a batch rewrites the buckets it touches
and no others.  A journey's provider count is the number of its providers among
the pairs, which is exact.  With a watermark the pairs are kept per day and the state of
days that the watermark has passed is dropped.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.operators.merge import merge_upsert
from claimlake.operators.store import Batch, TableSet

KEEP_VERSIONS = 3  # manifests whose files stay when old versions are deleted
VACUUM_EVERY = 20  # batches


def provider_metrics_stream(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Running metrics of each (journey, provider); events without a provider are a pair of their own.

    ``watermark`` (e.g. "30 days") bounds the state: metrics are kept per day,
    and events later than that are dropped, as Spark does behind a watermark.
    """
    keys = ["journey_id", "provider_id"]
    if watermark is not None:
        events = events.withColumn("__at", F.col("event_date").cast("timestamp")).withWatermark("__at", watermark)
        keys = [*keys, F.window("__at", "1 day").alias("__day")]
    out = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("cost").alias("total_cost"),
        F.min("event_date").alias("first_event"), F.max("event_date").alias("last_event"))
    return out if watermark is None else out.withColumn("day", F.col("__day.start").cast("date")).drop("__day")


def journey_metrics(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("journey_id").agg(
        F.sum("event_count").alias("event_count"), F.sum("total_cost").cast("decimal(28,2)").alias("total_cost"),
        F.countDistinct("provider_id").alias("provider_count"),
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


def upsert_batch(store: TableSet, batch: DataFrame, batch_id: str, buckets: int = 64) -> bool:
    """One micro-batch: pairs and journeys of the touched buckets, in one commit. A repeated batch changes nothing."""
    keys = [c for c in ("journey_id", "provider_id", "day") if c in batch.columns]

    def build(b: Batch) -> None:
        batch.persist()
        try:
            touched = b.upsert("pairs", batch, ["journey_id"], buckets, lambda old, new: merge_upsert(old, new, keys))
            changed = batch.select("journey_id").distinct()
            pairs = b.read_buckets("pairs", touched)
            both = pairs.join(changed.withColumnRenamed("journey_id", "__j"), F.col("journey_id").eqNullSafe(F.col("__j")), "left_semi")
            b.upsert("journeys", journey_metrics(both), ["journey_id"], buckets)
        finally:
            batch.unpersist()
    return store.run(batch_id, build)


def read_journeys(spark: SparkSession, table_root: str) -> DataFrame:
    return TableSet(spark, table_root).read("journeys")


def stream_journey_metrics(spark: SparkSession, events: DataFrame, table_root: str, checkpoint: str,
                           available_now: bool = True, buckets: int = 64, watermark: str | None = None):
    agg = provider_metrics_stream(events, watermark)
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]  # batch numbers begin anew with a checkpoint

    def upsert(batch: DataFrame, batch_id: int) -> None:
        store = TableSet(batch.sparkSession, table_root)
        upsert_batch(store, batch, f"{run}-{batch_id}", buckets)
        if batch_id % VACUUM_EVERY == VACUUM_EVERY - 1:
            store.vacuum(KEEP_VERSIONS)

    w = agg.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
