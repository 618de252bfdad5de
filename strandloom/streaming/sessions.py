"""Streaming counterparts of the batch clustering: extensions beyond finite inputs.

The functions take any frame, streaming or not; on a stream the watermark bounds state, and late
rows beyond it are dropped by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """The event files of ``folder`` as a stream; the schema is that of the files there now."""
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of a user's events no more than ``gap`` apart: first and last time and number."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    grouped = timed.groupBy("user_id", F.session_window("ts", gap).alias("w"))
    return grouped.agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")).drop("w")


def tiles(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Events and their value sum by type and fixed window."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    grouped = timed.groupBy("event_type", F.window("ts", width).alias("w"))
    return grouped.agg(F.count("*").alias("n")).select("event_type", F.col("w.start").alias("start"), "n")
