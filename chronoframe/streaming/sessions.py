"""Streaming counterparts (an extension: the batch operators are the reference semantics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(stream: DataFrame, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Sessions per key that close after a gap; rows later than the watermark are dropped by the engine."""
    return stream.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("lo"), F.col("w.end").alias("hi"), "n")
