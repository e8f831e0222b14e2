"""What the operators share: reading a table, and broadcasts of a small measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.scale import broadcast_if_small

BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(df: DataFrame) -> DataFrame:
    """Broadcast hint if the frame measures 32 MB at most; otherwise the planner shuffles."""
    return broadcast_if_small(df, BROADCAST_BYTES)
