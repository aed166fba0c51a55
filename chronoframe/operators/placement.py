"""Where frames are placed: which captures are followed, which fits stay, gains through totality, boundaries to the frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fits, sequences
from .stats import lag1, selected, upper_median


def follow_decision(df: DataFrame, keys: Sequence[str], order: str, x: str, y: str, line_x: Column, line_y: Column, centroid: Column, left_out: Column, may_follow: Column, excursion: float = 15.0, step: float = 8.0, least: int = 12) -> DataFrame:
    """(keys, follow): a group is followed if all its fits are centroids, or if it departs from its line while its steps stay small.

    Rows ``left_out`` count only where a group has no others. ``may_follow`` has to hold for the group, of at least ``least`` rows.
    """
    every = Window.partitionBy(*keys)
    rows = df.withColumns({"__all": F.min(centroid.cast("int")).over(every) == 1, "__n": F.count("*").over(every), "__may": F.min(may_follow.cast("int")).over(every) == 1, "__out": left_out & (F.min(left_out.cast("int")).over(every) == 0)})
    groups = rows.groupBy(*keys).agg(F.first("__all").alias("__all"), ((F.first("__n") >= least) & F.first("__may")).alias("__may"))
    used = rows.where(~F.col("__out"))
    w = Window.partitionBy(*keys).orderBy(order)
    dev = F.hypot(F.col(x) - line_x, F.col(y) - line_y)
    stepped = used.withColumns({"__dev": dev, "__step": F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w))})
    far = stepped.groupBy(*keys).agg((F.max("__dev") > excursion).alias("__far"))
    median = upper_median(stepped.where(F.col("__step").isNotNull()), keys, "__step", "__med")
    joined = groups.join(far, list(keys)).join(median, list(keys), "left")
    return joined.select(*keys, (F.col("__all") | (F.col("__may") & F.col("__far") & F.coalesce(F.col("__med") < step, F.lit(False)))).alias("follow"))


def place_partials(df: DataFrame, x: str, y: str, line_x: Column, line_y: Column, accepted: Column, most: float = 40.0) -> DataFrame:
    """Rows placed by their own fit: accepted ones within ``most`` of the group's line; the others are cut."""
    return df.where(accepted & (F.hypot(F.col(x) - line_x, F.col(y) - line_y) <= most))


def inherit_position(df: DataFrame, keys: Sequence[str], order: str, x: str, centre: float) -> DataFrame:
    """A row without a position takes the one before it, else the frame's centre."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(x, F.coalesce(F.last(x, True).over(w), F.lit(centre)))


def lit_area_agrees(measured: Column, expected: Column, tolerance: float = 0.35) -> Column:
    """Gate on a fitted disc: the lit area fits its separation."""
    return F.abs(measured - expected) <= tolerance


def totality_gains(segs: DataFrame, keys: Sequence[str], start: str, kind: str, chain: str, p99: str, entry: str, totality: Column, target: float, full: float, resolve: Column | None = None) -> DataFrame:
    """``gain`` of each segment, ``anchor`` of transitions, ``slow``: the stable one with the largest gain, the first on ties, and ``corona``: the other stable ones that are no ``resolve`` segments.

    Levels count as at least 1/65535. In totality a stable segment is brought to the target directly, and a transition is anchored to the next stable one.
    """
    stable = F.col(kind) == "stable"
    lit = lambda c: F.greatest(c, F.lit(1 / 65535))
    direct = target * full / lit(F.col(p99))
    w = Window.partitionBy(*keys).orderBy(F.col(start).desc()).rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(stable, F.struct(direct.alias("g"), F.col(entry).alias("e"))), True).over(w)
    gained = segs.withColumns({"gain": F.when(totality & stable, direct).otherwise(F.col(chain)), "__next": following})
    anchor = F.when(totality & ~stable & F.col("__next").isNotNull(), F.col("__next.g") * F.col("__next.e") / lit(F.col(entry))).otherwise(F.col("gain"))
    rank = F.when(totality & stable, F.struct(F.col("gain"), (-F.col(start)).alias("first")))
    best = F.max_by(F.when(totality & stable, F.col(start)), rank).over(Window.partitionBy(*keys))
    return gained.withColumn("anchor", anchor).withColumn("slow", F.coalesce(F.col(start) == best, F.lit(False))).drop("__next").withColumn("corona", totality & stable & ~F.col("slow") & ~F.coalesce(F.lit(False) if resolve is None else resolve, F.lit(False)))


def ramp_gain(anchor: Column, entry: Column, level: Column, p99: Column, target: float, full: float, ceiling: float) -> Column:
    """Gain of a row of a transition: it follows the level, never brighter than the ceiling on the row's own p99."""
    return F.least(anchor * entry / F.greatest(level, F.lit(1 / 65535)), ceiling * target * full / F.greatest(p99, F.lit(1 / 65535)))


def refine_boundaries(edges: DataFrame, frames: DataFrame, key: str, i: str, x: str) -> DataFrame:
    """(key, lo, hi, frame): the frame where the level crosses the middle of both sides' logarithms, by bisection between lo and hi.

    ``edges`` has key, lo, hi, lo_med, hi_med. The frames between lo and hi meet the edge by a join; the bisection goes by few of them and
    keeps to what they say, also where the level is not monotone. It takes as many turns as the edge is wide.
    """
    log2s = lambda c: F.log2(F.greatest(c, F.lit(1 / 65535)))
    dealt = edges.withColumn(i, F.explode(F.sequence("lo", "hi")))
    level = dealt.join(frames.select(key, i, log2s(F.col(x)).alias("__l")), [key, i]).groupBy(key, "lo", "hi", "lo_med", "hi_med").agg(F.map_from_entries(F.collect_list(F.struct(i, "__l"))).alias("__m"))
    target, rising = (log2s(F.col("lo_med")) + log2s(F.col("hi_med"))) / 2, F.col("hi_med") > F.col("lo_med")

    def halve(s, _):
        mid = F.floor((s["a"] + s["b"]) / 2).cast("long")
        there = (F.element_at("__m", mid) >= target) == rising
        open_ = s["b"] - s["a"] > 1
        return F.struct(F.when(open_ & ~there, mid).otherwise(s["a"]).alias("a"), F.when(open_ & there, mid).otherwise(s["b"]).alias("b"))

    turns = F.greatest(F.lit(1), F.ceil(F.log2((F.col("hi") - F.col("lo")).cast("double"))) + 1).cast("int")
    found = F.aggregate(F.sequence(F.lit(1), turns), F.struct(F.col("lo").cast("long").alias("a"), F.col("hi").cast("long").alias("b")), halve)
    return level.select(key, "lo", "hi", found["b"].alias("frame"))


def bead_windows(measured: DataFrame, contacts: dict[str, float | None], half: float = 2.0) -> DataFrame:
    """(lo, hi) of measured spans, their ends in order; where none is whole, ``half`` seconds about the inner contacts."""
    spans = measured.where(F.col("lo").isNotNull() & F.col("hi").isNotNull()).select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
    near = [(c - half, c + half) for c in (contacts["c2"], contacts["c3"]) if c is not None]
    if not near or not spans.isEmpty():
        return spans
    return measured.sparkSession.createDataFrame(near, "lo double, hi double")


def search_window(span: tuple[float, float], separations: tuple[float, float], r_sun: float, r_moon: float) -> tuple[float, float]:
    """Where contacts are looked for: as long as the outer ones are away at the mean rate of approach, twice over, never less than the span."""
    lo, hi = span
    rate = max(abs(separations[1] - separations[0]) / max(hi - lo, 1e-6), 1e-9)
    reach = 2 * (r_sun + r_moon) / rate
    return min(lo, lo - reach), max(hi, hi + reach)


def shared_drift(df: DataFrame, keys: Sequence[str], t: str, x: str, y: str, accepted: Column, filtered: Column, least: int = 20, span: float = 200.0) -> DataFrame:
    """One row (drift_x, drift_y, groups): the upper median, by axis, of the robust slopes of groups; zeros where none qualifies.

    A group qualifies with ``least`` accepted rows whose t span more than ``span``. One shuffle by group and axis, then a step over one row a group.
    """
    every = Window.partitionBy(*keys)
    good = df.where(accepted & filtered).withColumns({"__n": F.count("*").over(every), "__span": F.max(t).over(every) - F.min(t).over(every)}).where((F.col("__n") >= least) & (F.col("__span") > span))
    axes = good.select(*keys, t, F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.col(x).alias("at")), F.struct(F.lit("y").alias("axis"), F.col(y).alias("at")))).alias("a")).select(*keys, t, "a.axis", "a.at")
    slopes = fits.robust_line(axes, [*keys, "axis"], t, "at").groupBy(*keys).pivot("axis", ["x", "y"]).agg(F.first("slope"))
    medians = [selected(slopes, [], axis, {f"drift_{axis}": 0.5}) for axis in ("x", "y")]
    groups = slopes.agg(F.count("*").alias("groups"))
    return medians[0].join(medians[1]).join(groups).select(*(F.coalesce(f"drift_{axis}", F.lit(0.0)).alias(f"drift_{axis}") for axis in ("x", "y")), "groups")


def shared_intercepts(df: DataFrame, drift: DataFrame, keys: Sequence[str], t: str, x: str, y: str, accepted: Column) -> DataFrame:
    """(keys, drift_x, drift_y, at_x, at_y): each group's place under the shared drift, the upper median of what is left of its accepted rows."""
    rest = df.where(accepted).join(F.broadcast(drift))  # one row
    rest = rest.withColumns({"__x": F.col(x) - F.col("drift_x") * F.col(t), "__y": F.col(y) - F.col("drift_y") * F.col(t)})
    return upper_median(rest, [*keys, "drift_x", "drift_y"], "__x", "at_x").join(upper_median(rest, [*keys, "drift_x", "drift_y"], "__y", "at_y"), [*keys, "drift_x", "drift_y"])


def place_totality(
    df: DataFrame, keys: Sequence[str], file: str, order: str, t: str, line: Sequence[str], residual: Sequence[str], shift: Sequence[str], level: str, ring: Column, offset: Sequence[Column],
    least: int = 8, smooth: float = 1.5, follow: float = 0.55, level_rows: int = 4, level_most: float = 12.0,
) -> DataFrame:
    """(keys, order, x, y, placed): where each frame of totality belongs.

    A file with at least ``least`` measured shifts (null where there is none) is placed by them, smoothed over ``smooth`` seconds and
    moved so that their mean meets the line's. Other frames ride the line; where fits are no ring searches and their residuals
    are motion (lag-1 of an axis at least ``follow``) also the smoothed residual, and without the mean residual of their file and
    level (of ``level_rows`` rows at least), held to ``level_most``. Those are measured on the Moon: ``offset``, the Moon's from the Sun, is taken off.
    ``order`` numbers the frames of a group. Windows are by group, or by file.
    """
    rows = df.select(*keys, file, order, t, level, *line, *residual, *shift, ring.alias("__ring"), *(o.alias(f"__o{k}") for k, o in enumerate(offset)))
    own = [*keys, file]
    shifted = rows.where(F.col(shift[0]).isNotNull() & F.col(shift[1]).isNotNull()).withColumn("__n", F.count("*").over(Window.partitionBy(*own))).where(F.col("__n") >= least)
    for k in (0, 1):
        shifted = sequences.time_smooth(shifted, own, t, shift[k], smooth, f"__s{k}")
    whole = Window.partitionBy(*own)
    corona = shifted.select(*keys, order, *((F.col(f"__s{k}") + F.avg(line[k]).over(whole) - F.avg(f"__s{k}").over(whole)).alias(f"__c{k}") for k in (0, 1)))
    smoothed, moving = [], []
    for k in (0, 1):
        filled = sequences.fill_gaps(rows.select(*keys, order, residual[k]), keys, order, residual[k])
        smoothed.append(sequences.smooth_series(filled, keys, order, "filled").withColumnRenamed("smooth", f"__r{k}"))
        moving.append(lag1(rows.where(F.col(residual[k]).isNotNull()), keys, order, residual[k]).withColumnRenamed("lag1", f"__l{k}"))
    tracked = rows.groupBy(*keys).agg(F.min(F.col("__ring").cast("int")).alias("__ring"))
    for m in moving:
        tracked = tracked.join(m, list(keys), "left")
    tracked = tracked.select(*keys, ((F.col("__ring") == 0) & (F.coalesce(F.greatest("__l0", "__l1"), F.lit(0.0)) >= follow)).alias("__tracked"))
    means = rows.where(F.col(residual[0]).isNotNull() & F.col(residual[1]).isNotNull()).groupBy(*own, level).agg(F.count("*").alias("__n"), *(F.avg(residual[k]).alias(f"__m{k}") for k in (0, 1))).where(F.col("__n") >= level_rows)
    group = Window.partitionBy(*keys)
    means = means.select(*own, level, *((F.col(f"__m{k}") - F.avg(f"__m{k}").over(group)).alias(f"__m{k}") for k in (0, 1)))
    held = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.lit(level_most), F.hypot("__m0", "__m1")), F.lit(1.0)))
    bias = means.select(*own, level, *((F.col(f"__m{k}") * held).alias(f"__b{k}") for k in (0, 1)))
    out = rows.drop("__ring").join(corona, [*keys, order], "left").join(tracked, list(keys), "left").join(bias, [*own, level], "left")
    for s in smoothed:
        out = out.join(s, [*keys, order], "left")
    by_shift = F.col("__c0").isNotNull()
    at = []
    for k in (0, 1):
        follows = F.when(F.col("__tracked"), F.coalesce(f"__r{k}", F.lit(0.0))).otherwise(0.0)
        step = F.when(F.col("__tracked"), F.coalesce(f"__b{k}", F.lit(0.0))).otherwise(0.0)
        at.append(F.when(by_shift, F.col(f"__c{k}") + step).otherwise(F.col(line[k]) + follows + step - F.col(f"__o{k}")))
    return out.select(*keys, order, at[0].alias("x"), at[1].alias("y"), F.when(by_shift, "corona").when(F.col("__tracked"), "tracked").otherwise("line").alias("placed"))


def output_window(df: DataFrame, keys: Sequence[str], x: str, y: str, width: float, height: float, radius: float, widest: float = 2.2, narrowest: float = 1.6, most: float = 0.35, step: int = 20, aspect: float = 4 / 3) -> DataFrame:
    """(keys, window_w, window_h, padded): the widest window about the subject that reaches past an edge in at most a share ``most`` of the rows.

    Widths go down in steps until that holds or the window is as narrow as it may be. One pass over the rows: each says at
    how many of the widths it is padded, which are the widest ones; their counts, one a width, are then summed up.
    """
    widths = [round(2 * widest * radius / step) * step]
    while widths[-1] > 2 * narrowest * radius:
        widths.append(widths[-1] - step)
    heights = [round(w / aspect / step) * step for w in widths]
    past = lambda sizes, c, edge: F.size(F.filter(F.array(*map(F.lit, map(float, sizes))), lambda s: (c - s / 2 < 0) | (c + s / 2 > edge)))
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    counts = rows.groupBy(*keys, F.greatest(past(widths, F.col(x), width), past(heights, F.col(y), height)).alias("__k")).agg(F.count("*").alias("__m"))
    sizes = F.explode(F.array(*(F.struct(F.lit(j).alias("j"), F.lit(w).alias("w"), F.lit(h).alias("h")) for j, (w, h) in enumerate(zip(widths, heights, strict=True)))))
    shares = counts.select(*keys, "__k", "__m", sizes.alias("s")).groupBy(*keys, "s").agg((F.sum(F.when(F.col("__k") > F.col("s.j"), F.col("__m")).otherwise(0)) / F.sum("__m")).alias("padded"))
    good = shares.where((F.col("padded") <= most) | (F.col("s.j") == len(widths) - 1))
    return good.groupBy(*keys).agg(F.min_by(F.struct("s", "padded"), F.col("s.j")).alias("r")).select(*keys, F.col("r.s.w").alias("window_w"), F.col("r.s.h").alias("window_h"), F.col("r.padded").alias("padded"))
