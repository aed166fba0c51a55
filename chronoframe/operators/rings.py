"""Runs on a circle of bins: the longest lit run, across zero too, and its edges between samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def longest_ring_run(df: DataFrame, keys: Sequence[str], place: str, bins: int, lit: Column) -> DataFrame:
    """(keys, start, length): the longest run of lit bins of each ring, the smaller start on ties; a ring without a lit bin has no row.

    Bins without a row are dark; a bin with several rows is lit if one of them is. The bins are laid out twice, so that a run across
    zero is a run like any other; a window holds a ring's bins, not its samples.
    """
    one = df.where(lit & F.col(place).between(0, bins - 1)).groupBy(*keys, F.col(place).cast("int").alias("__b")).agg(F.lit(1).alias("__one"))
    twice = one.select(*keys, F.explode(F.array(F.col("__b"), F.col("__b") + bins)).alias("__b"))
    run = F.col("__b") - F.row_number().over(Window.partitionBy(*keys).orderBy("__b"))
    runs = twice.withColumn("__run", run).groupBy(*keys, "__run").agg(F.min("__b").alias("start"), F.count("*").alias("length"))
    # a run that begins in the second round is a copy, but for one that was cut by the end of the first
    best = runs.withColumn("length", F.least(F.col("length"), F.lit(bins))).where(F.col("start") < bins)
    return best.groupBy(*keys).agg(F.min_by(F.struct("start", "length"), F.struct(-F.col("length"), "start")).alias("r")).select(*keys, F.col("r.start").alias("start"), F.col("r.length").cast("int").alias("length"))


def ring_edges(df: DataFrame, runs: DataFrame, keys: Sequence[str], place: str, value: str, bins: int, threshold: Column) -> DataFrame:
    """``runs`` with first, last and middle: angles at which the value crosses the threshold just outside a run, and of its middle.

    A crossing lies between the last dark sample and the first lit one by their values; a bin without a row has the value 0. ``threshold`` may
    use columns of ``runs``. Rings that are lit all around have no edges.
    """
    turn = 2 * math.pi / bins
    peak = df.groupBy(*keys, F.col(place).cast("int").alias("__b")).agg(F.max(value).alias("__v"))
    ends = runs.withColumn("__thr", threshold).select("*", F.explode(F.array(*(F.struct(F.lit(n).alias("which"), F.pmod(e, F.lit(bins)).alias("b")) for n, e in (("a0", F.col("start") - 1), ("a1", F.col("start")), ("b1", F.col("start") + F.col("length") - 1), ("b0", F.col("start") + F.col("length")))))).alias("__e"))
    met = ends.select("*", F.col("__e.b").alias("__b"), F.col("__e.which").alias("__w")).join(peak, [*keys, "__b"], "left")
    at = {w: F.max(F.when(F.col("__w") == w, F.coalesce("__v", F.lit(0.0)))).alias(w) for w in ("a0", "a1", "b1", "b0")}
    wide = met.groupBy(*keys, "start", "length").agg(F.first("__thr").alias("__thr"), *at.values())

    def share(dark: str, bright: str):
        return F.when(F.col(bright) == F.col(dark), 0.0).otherwise(F.least(F.greatest(F.try_divide(F.col("__thr") - F.col(dark), F.col(bright) - F.col(dark)), F.lit(0.0)), F.lit(1.0)))

    part = F.col("length") < bins
    first = F.pmod(F.col("start") - 1, F.lit(bins)) * turn + turn * share("a0", "a1")
    last = F.pmod(F.col("start") + F.col("length"), F.lit(bins)) * turn - turn * share("b0", "b1")
    middle = F.pmod(F.col("start") + (F.col("length") - 1) / 2, F.lit(float(bins))) * turn
    return wide.select(*keys, "start", "length", F.when(part, first).alias("first"), F.when(part, last).alias("last"), middle.alias("middle"))
