"""Joins of detections, samples, segments and intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import around


def last_wins(left: DataFrame, right: DataFrame, keys: Sequence[str], order: str, how: str = "left") -> DataFrame:
    """Join on keys; of several right rows with a key, the one last in ``order``."""
    rest = [c for c in right.columns if c not in keys]
    one = right.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*")
    return left.join(one, list(keys), how)


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], ok: Column) -> DataFrame:
    """Rows with what was measured for them, where that is ``ok``; the engine picks the side to send by its size."""
    return left.join(right.where(ok), list(keys), "left")


def range_join(points: DataFrame, ranges: DataFrame, key: str, i: str, start: str = "start", count: str = "count", bin: int = 1024) -> DataFrame:
    """Points within half-open ranges of the same key: both meet in bins of the index, so a key's points and ranges are not all paired."""
    bins = F.sequence(F.floor(F.col(start) / bin), F.floor((F.col(start) + F.col(count) - 1) / bin))
    dealt = ranges.where(F.col(count) > 0).withColumn("__bin", F.explode(bins)).withColumnRenamed(key, "__key")
    binned = points.withColumn("__at", F.floor(F.col(i) / bin))
    met = (F.col(key) == F.col("__key")) & (F.col("__at") == F.col("__bin")) & (F.col(i) >= F.col(start)) & (F.col(i) < F.col(start) + F.col(count))
    return binned.join(dealt, met).drop("__key", "__bin", "__at")


def nearest(probes: DataFrame, samples: DataFrame, key: str, i: str, value: str) -> DataFrame:
    """Each probe with the sample nearest to it, the lower one on ties: an as-of join to both sides, by two sorts of each key."""
    s = F.struct(F.col(i).alias("i"), F.col(value).alias("v"))
    extra = [c for c in probes.columns if c not in (key, i)]
    both = samples.select(key, i, s.alias("s"), F.lit(0).alias("probe"), *(F.lit(None).alias(c) for c in extra)).unionByName(probes.select(key, i, F.lit(None).alias("s"), F.lit(1).alias("probe"), *extra))
    found = around(both, [key], [i, "probe"], F.col("s"), "p", "q").where("probe = 1")
    below = F.col("q").isNull() | (F.col("p").isNotNull() & (F.col(i) - F.col("p.i") <= F.col("q.i") - F.col(i)))
    return found.select(key, *extra, i, F.when(below, F.col("p.i")).otherwise(F.col("q.i")).alias("near_i"), F.when(below, F.col("p.v")).otherwise(F.col("q.v")).alias(value))


def intersect_intervals(segs: DataFrame, windows: DataFrame, key: str, least: int) -> DataFrame:
    """Segment [start, start + count) and window [lo, hi] of a key: their common part, if at least so long."""
    lo, hi = F.greatest("start", "lo"), F.least(F.col("start") + F.col("count"), F.col("hi") + 1)
    return segs.join(windows, key).withColumns({"from": lo, "to": hi}).where(F.col("to") - F.col("from") >= least)


def within_any(points: DataFrame, spans: DataFrame, t: str, lo: str = "lo", hi: str = "hi", bin: float = 10000.0) -> DataFrame:
    """Points that lie in any of the spans: both meet in bins of the time, neither side is sent to all."""
    dealt = spans.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(lo) / bin), F.floor(F.col(hi) / bin)))).select("__bin", F.col(lo).alias("__lo"), F.col(hi).alias("__hi"))
    met = (F.floor(F.col(t) / bin) == F.col("__bin")) & (F.col(t) >= F.col("__lo")) & (F.col(t) <= F.col("__hi"))
    return points.join(dealt, met, "left_semi")


def differs_nearby(df: DataFrame, keys: Sequence[str], order: str, state: str, reach: int, always: Column | None = None) -> DataFrame:
    """``near``: some row within ``reach`` rows has another state, or ``always`` holds."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-reach, reach)
    near = F.min(state).over(w) != F.max(state).over(w)
    return df.withColumn("near", near if always is None else near | F.coalesce(always, F.lit(False)))


def first_other_state(df: DataFrame, keys: Sequence[str], order: str, state: str, reach: int, more: Sequence[str] = ()) -> DataFrame:
    """``other``: (state, more) of the first row, from ``reach`` before to ``reach`` behind, whose state differs from a row's own."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-reach, reach)
    around = F.filter(F.collect_list(F.struct(state, *more)).over(w), lambda r: r[state] != F.col(state))
    return df.withColumn("other", F.try_element_at(around, F.lit(1)))


def unstack_near_contacts(df: DataFrame, keys: Sequence[str], order: str, state: str, stack: str, reach: int, beads: str | None = None, dense: str | None = None) -> DataFrame:
    """Depth 1 beside a contact: a change of state within ``reach`` where either side has beads (any change if ``beads`` is not known). Dense rows stay."""
    found = first_other_state(df, keys, order, state, reach, [beads] if beads else [])
    contact = F.col("other").isNotNull()
    if beads:
        contact &= F.coalesce(F.col(beads), F.lit(False)) | F.coalesce(F.col("other")[beads], F.lit(False))
    if dense:
        contact &= ~F.coalesce(F.col(dense), F.lit(False))
    return found.withColumn(stack, F.when(contact, F.lit(1)).otherwise(F.col(stack)))


def widest_pair(df: DataFrame, key: str, t: str, name: str) -> DataFrame:
    """Earliest and latest row of each key, and their distance in time."""
    g = df.groupBy(key).agg(F.min_by(name, t).alias("first"), F.max_by(name, t).alias("last"), (F.max(t) - F.min(t)).alias("gap"), F.count("*").alias("n"))
    return g.where("n > 1").drop("n")


def not_done(frames: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Frames without a complete output."""
    return frames.join(outputs, key, "left_anti")


def greedy_boxes(df: DataFrame, keys: Sequence[str], rank: Column, half: str, share: float = 0.35) -> DataFrame:
    """Boxes (x, y, half) kept greedily by rank: one goes if it overlaps a kept one by more than ``share`` of the smaller."""
    kinds = dict(df.dtypes)
    item = F.struct(rank.alias("rank"), F.col("id").alias("id"), F.col("x").alias("x"), F.col("y").alias("y"), F.col(half).alias("h"))
    packed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("a"))

    def hit(k, r):
        side = lambda c: F.greatest(F.lit(0.0), F.least(k[c] + k["h"], r[c] + r["h"]) - F.greatest(k[c] - k["h"], r[c] - r["h"]))
        small = F.least(k["h"], r["h"])
        return side("x") * side("y") > share * 4 * small * small

    kept = F.aggregate("a", F.expr("filter(a, z -> false)"), lambda acc, r: F.when(F.exists(acc, lambda k: hit(k, r)), acc).otherwise(F.concat(acc, F.array(r))))
    assert "id" in kinds
    return packed.select(*keys, F.explode(kept).alias("k")).select(*keys, "k.id", "k.rank")


def nearest_before(features: DataFrame, keys: Sequence[str], clip: str, name: str, x: str, y: str, label: str, held: str) -> DataFrame:
    """(keys, clip, name, held, far): for each feature, what the nearest of the same label in the clip before holds, and how far that is.

    The clip before is the last lower one that the key has. Of equally near ones the first by ``name`` counts; a feature without one has
    nulls. Rows of the same key, clip and label meet: as many as a picture has places for panels.
    """
    clips = features.select(*keys, clip).distinct().withColumn("__before", F.lag(clip).over(Window.partitionBy(*keys).orderBy(clip)))
    now = features.join(clips, [*keys, clip]).select(*keys, clip, name, label, F.col(x).alias("__x"), F.col(y).alias("__y"), "__before")
    was = features.select(*keys, F.col(clip).alias("__before"), label, F.struct(F.col(name).alias("n"), F.col(x).alias("x"), F.col(y).alias("y"), F.col(held).alias("h")).alias("__p"))
    met = now.join(was, [*keys, "__before", label], "left").withColumn("__far", F.hypot(F.col("__p.x") - F.col("__x"), F.col("__p.y") - F.col("__y")))
    best = F.min_by(F.struct(F.col("__p.h").alias("h"), F.col("__far").alias("f")), F.when(F.col("__far").isNotNull(), F.struct("__far", F.col("__p.n").alias("n"))))
    return met.groupBy(*keys, clip, name).agg(best.alias("__b")).select(*keys, clip, name, F.col("__b.h").alias(held), F.col("__b.f").alias("far"))
