"""Tumbling buckets over event time, for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_buckets(events: DataFrame, width: str = "6 hours", lateness: str = "1 day") -> DataFrame:
    """(bucket, event_type, n, least, most): events(ts, event_type, value) in buckets of `width`.

    On a stream, state is dropped and a bucket is final once the watermark, `lateness` behind the newest event, has passed it.
    """
    if events.isStreaming:
        events = events.withWatermark("ts", lateness)
    by = events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    return by.select(F.col("w.start").alias("bucket"), "event_type", "n", "least", "most")


def stream_events(spark: SparkSession, folder: str, schema: str = "event_id long, ts timestamp, user_id long, event_type string, value double, props string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def run_to_end(buckets: DataFrame, path: str, checkpoint: str) -> None:
    """Write final buckets as Parquet until the source has no more to give; a rerun with the same checkpoint goes on from there."""
    buckets.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
