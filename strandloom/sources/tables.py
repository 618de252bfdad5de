"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` under ``folder``; columns and filters are pushed into the scan later."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
