"""From recorded files to segments: the passes in order, each a table from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import frames, sequences
from ..sources import ser


def light_curve(spark: SparkSession, path: str, rows: int = 24) -> DataFrame:
    """Brightness samples of all frames of a folder; reads only ``rows`` rows of each."""
    return frames.light_curve(ser.read(spark, path, rows=str(rows)))


def segments(curve: DataFrame, shortest: int, blown: float = 0.5) -> DataFrame:
    """Light curve to merged segments with kinds."""
    cut = sequences.segments(curve.withColumn("frame", F.col("i").cast("long")), ["file"], "frame", "med")
    return sequences.merge_short(cut, ["file"], shortest, blown)
