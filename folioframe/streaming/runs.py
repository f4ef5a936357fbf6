"""Recurring runs over a stream: the gap-tolerant runs of the survey as session windows with late data bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def recurring_runs(events: DataFrame, gap: str = "3 days", late: str = "1 day", least: int = 8) -> DataFrame:
    """(user_id, event_type, first, last, n): runs of events whose neighbours lie within ``gap``, once they can no longer
    grow. State is one open session per key and run, and goes when the watermark passes it."""
    runs = events.withWatermark("ts", late).groupBy("user_id", "event_type", F.session_window("ts", gap).alias("w")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    return runs.where(F.col("n") >= least).drop("w")
