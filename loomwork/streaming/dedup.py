"""Streaming: exact deduplication of segments as they arrive, and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import text_hash


def dedup_stream(df: DataFrame, text: str, time: str, delay: str = "1 day") -> DataFrame:
    """The first of each normalised text within the watermark; state older than ``delay`` is dropped."""
    return df.withColumn("segment_hash", text_hash(text)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["segment_hash"])


def counts_by_window(df: DataFrame, time: str, key: str, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Rows by window and key; late rows beyond ``delay`` are dropped."""
    return df.withWatermark(time, delay).groupBy(F.window(time, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
