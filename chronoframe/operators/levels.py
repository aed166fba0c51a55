"""Exposure levels as tables of pixels: relations between levels, and brightness against the distance from a centre.

A table has a row for each pixel: keys (image, or level), a tile, a place in it, and a value. No image is held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import selected

#: A pixel is well exposed between these shares of full scale, in the shorter and in the longer exposure.
SHORT_RANGE, LONG_RANGE = (0.0020, 0.90), (0.0050, 0.85)
#: Log2 brightness of the histogram's ends, and its bins.
LOG_RANGE, BINS = (-20.0, 2.0), 2048


def neighbours(levels: DataFrame, level: str, value: str, place: Sequence[str]) -> DataFrame:
    """(lower, level, place, short, long): each pixel of a level beside that of the next lower level. Levels are few: their list is one small task."""
    known = levels.select(level).where(F.col(level).isNotNull()).distinct()
    pairs = known.withColumn("lower", F.lag(level).over(Window.orderBy(level))).where(F.col("lower").isNotNull())
    long = levels.join(F.broadcast(pairs), level).select("lower", level, *place, F.col(value).alias("long"))
    return long.join(levels.select(F.col(level).alias("lower"), *place, F.col(value).alias("short")), ["lower", *place])


def fit_affine(pairs: DataFrame, keys: Sequence[str], short: str, long: str, least: int = 100, span: float = 3.0) -> DataFrame:
    """(keys, a, b, n, span): long = a short + b over pixels that both expose well, refitted without those beyond 3 medians of the residuals.

    a and b are 0 with fewer than ``least`` pixels or where short spans less than ``span`` times its least value. Two passes of sums
    by key, and one exact median found by a sketch and counts; rows move only to be counted.
    """
    x, y = F.col(short), F.col(long)
    well = pairs.where((x > SHORT_RANGE[0]) & (x < SHORT_RANGE[1]) & (y > LONG_RANGE[0]) & (y < LONG_RANGE[1])).select(*keys, x.cast("double").alias("__x"), y.cast("double").alias("__y"))
    line = {"a": F.regr_slope("__y", "__x"), "b": F.regr_intercept("__y", "__x")}
    first = well.groupBy(*keys).agg(*(e.alias(c) for c, e in line.items()), F.count("*").alias("n"), F.min("__x").alias("lo"), F.max("__x").alias("hi"))
    first = first.withColumn("ok", (F.col("n") >= least) & (F.col("hi") > F.col("lo") * span) & F.col("a").isNotNull())
    first = first.select(*keys, "n", (F.col("hi") / F.col("lo")).alias("span"), "ok", *(F.when(F.col("ok"), F.col(c)).otherwise(0.0).alias(c) for c in line))
    judged = well.join(F.broadcast(first.where("ok and a > 0")), list(keys)).withColumn("__r", F.abs(F.col("__y") - (F.col("a") * F.col("__x") + F.col("b"))))
    median = selected(judged, keys, "__r", {"__m": 0.5})
    kept = judged.join(F.broadcast(median), list(keys)).where(F.col("__r") <= 3 * F.col("__m") + 1e-9)
    second = kept.groupBy(*keys).agg(*(e.alias(f"{c}2") for c, e in line.items()), F.count("*").alias("n2"))
    better = F.coalesce(F.col("n2") >= least, F.lit(False)) & F.col("a2").isNotNull()
    return first.join(second, list(keys), "left").select(*keys, *(F.when(better, F.col(f"{c}2")).otherwise(F.col(c)).alias(c) for c in line), "n", "span")


def level_chain(fits: DataFrame, level: str, a: str = "a", b: str = "b") -> DataFrame:
    """(level, scale, offset): each level's line down to the lowest one. Rows are the levels; a level without a usable line (a <= 0) ends the chain."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(level).alias("level"), F.col(a).alias("a"), F.col(b).alias("b"))))
    step = lambda acc, r: F.when(
        (F.element_at(acc, -1)["scale"] > 0) & (r["a"] > 0),
        F.array_append(acc, F.struct(r["level"].alias("level"), (F.element_at(acc, -1)["scale"] * r["a"]).alias("scale"), (r["a"] * F.element_at(acc, -1)["offset"] + r["b"]).alias("offset"))),
    ).otherwise(F.array_append(acc, F.struct(r["level"].alias("level"), F.lit(0.0).alias("scale"), F.lit(0.0).alias("offset"))))
    kind = dict(fits.dtypes)[level]
    start = F.array(F.struct(F.lit(None).cast(kind).alias("level"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("offset")))
    told = fits.agg(F.aggregate(rows, start, step).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return told.where(F.col("level").isNotNull()).withColumnRenamed("level", level)


def with_artefacts(segments: DataFrame, artefacts: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    """Segments that have an artefact; ``reference`` marks the one of the lowest level (none counts as the highest), the first on ties."""
    kept = segments.join(artefacts.select(*keys).distinct(), list(keys), "left_semi")
    order = F.struct(F.coalesce(F.col(level).cast("double"), F.lit(1e9)).alias("level"), *keys)
    least = kept.agg(F.min(order).alias("__least"))
    return kept.join(F.broadcast(least)).withColumn("reference", F.coalesce(order == F.col("__least"), F.lit(False))).drop("__least")


# ---------------------------------------------------------------- brightness by radius


def radial_sketch(pixels: DataFrame, keys: Sequence[str], radius: Column, value: Column, rmax: Column) -> DataFrame:
    """(keys, r, bin, n): histograms of log2 brightness by integer radius. Sketches of parts of an image add up by (keys, r, bin)."""
    lo, hi = LOG_RANGE
    logged = F.when(value > 0, F.log2(F.greatest(value, F.lit(1e-300)))).otherwise(F.lit(lo))
    at = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((logged - lo) / (hi - lo) * (BINS - 1) + 0.5)))
    r = F.floor(radius + 0.5)
    return pixels.where(r <= rmax).groupBy(*keys, r.cast("int").alias("r"), at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def radial_medians(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, r, n, bin): each radius' pixels, and the bin behind the one that holds their median: the profile's rule."""
    w = Window.partitionBy(*keys, "r")
    running = sketch.withColumns({"total": F.sum("n").over(w), "upto": F.sum("n").over(w.orderBy("bin"))})
    return running.where(F.col("upto") >= F.floor(F.col("total") / 2)).groupBy(*keys, "r").agg(F.max("total").alias("n"), F.least(F.lit(BINS - 1), F.min("bin") + 1).alias("bin"))


def radial_gain(medians: DataFrame, frames: DataFrame, keys: Sequence[str], least: int = 2000, reach: int = 9, restore: float = 0.45) -> DataFrame:
    """(keys, r, profile, gain) for each radius up to ``rmax``. ``frames`` has keys, rmax and limb, the Moon's radius.

    A radius without pixels takes the profile of the one inside it. From the first radius beyond the limb with fewer than ``least``
    pixels on, the profile is frozen; within the limb it is that of the limb. It is smoothed by a box of ``reach`` to either side.
    The gain divides it out, but for a share ``restore``. Windows hold an image's radii, not its pixels.
    """
    lo, hi = LOG_RANGE
    inner = F.greatest(F.lit(1), F.floor(F.col("limb") * 0.99 + 0.5)).cast("int")
    rows = frames.select(*keys, "limb", inner.alias("inner"), F.explode(F.sequence(F.lit(0), F.col("rmax").cast("int"))).alias("r")).join(medians, [*keys, "r"], "left")
    image = Window.partitionBy(*keys)
    by = image.orderBy("r")
    own = F.when(F.col("n") > 0, F.pow(F.lit(2.0), lo + F.col("bin") / (BINS - 1) * (hi - lo)))
    beyond = F.min(F.when((F.col("r") >= F.greatest(F.lit(1), F.ceil("limb"))) & (F.coalesce("n", F.lit(0)) < least), F.col("r"))).over(image)
    rows = rows.withColumns({"own": own, "stop": beyond - 1})
    held = F.coalesce(F.last("own", True).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(1e-6))
    rows = rows.withColumn("p", held)
    frozen = F.max(F.when(F.col("r") == F.col("stop"), F.col("p"))).over(image)
    rows = rows.withColumn("p", F.when(F.col("r") > F.col("stop"), frozen).otherwise(F.col("p")))
    limb = F.max(F.when(F.col("r") == F.col("inner"), F.col("p"))).over(image)
    rows = rows.withColumn("p", F.when(F.col("r") < F.col("inner"), F.coalesce(limb, F.col("p"))).otherwise(F.col("p")))
    rows = rows.withColumn("smooth", F.avg("p").over(by.rowsBetween(-reach, reach)))
    reference = F.coalesce(F.max(F.when((F.col("r") == F.col("inner")) & (F.col("smooth") > 0), F.col("smooth"))).over(image), F.lit(1e-6))
    rows = rows.withColumns({"reference": reference, "safe": F.when(F.col("smooth") > 0, F.col("smooth")).otherwise(1e-6)})
    return rows.select(*keys, "r", F.col("smooth").alias("profile"), F.pow(F.col("reference") / F.col("safe"), 1 - restore).alias("gain"))


def flatten(pixels: DataFrame, frames: DataFrame, keys: Sequence[str], x: str, y: str, value: str, least: int = 2000, restore: float = 0.45) -> DataFrame:
    """``pixels`` with ``r`` and ``flat``, the value without its image's radial brightness. ``frames``: keys, cx, cy, width, height, limb.

    Pixels are read twice: for the sketch, counted within tasks first, and to be divided. A frame's row goes to its pixels by
    a join; the gains have as many rows as there are radii.
    """
    cx, cy, w, h = (F.col(c) for c in ("cx", "cy", "width", "height"))
    framed = frames.withColumn("rmax", F.ceil(F.hypot(F.greatest(cx, w - cx), F.greatest(cy, h - cy))).cast("int"))
    placed = pixels.join(framed.select(*keys, "cx", "cy", "rmax"), list(keys)).withColumn("__d", F.hypot(F.col(x) - F.col("cx"), F.col(y) - F.col("cy")))
    sketch = radial_sketch(placed, keys, F.col("__d"), F.col(value), F.col("rmax"))
    gains = radial_gain(radial_medians(sketch, keys), framed, keys, least, restore=restore)
    r = F.least(F.floor(F.col("__d") + 0.5).cast("int"), F.col("rmax"))
    return placed.withColumn("r", r).join(gains.select(*keys, "r", "gain"), [*keys, "r"]).withColumn("flat", F.col(value) * F.col("gain")).drop("cx", "cy", "rmax", "__d", "gain")
