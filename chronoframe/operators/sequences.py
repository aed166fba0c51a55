"""Ordered-sequence operators: change points, runs, sessions, shards, resampling, smoothing, gates."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .fits import loose
from .stats import upper_median, with_mad, with_upper_median


def _by(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def around(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, before: str, behind: str) -> DataFrame:
    """The last value that is not null up to each row, and the first from it on. Both windows grow with the rows, so a key costs two sorts."""
    up, down = (Window.partitionBy(*keys).orderBy(*(F.col(c) if asc else F.col(c).desc() for c in order)).rowsBetween(Window.unboundedPreceding, 0) for asc in (True, False))
    return df.withColumns({before: F.last(value, True).over(up), behind: F.last(value, True).over(down)})


def islands(df: DataFrame, keys: Sequence[str], order: str, starts: Column, name: str = "island") -> DataFrame:
    """Number the runs that begin where ``starts`` is true."""
    w = _by(keys, order)
    flagged = df.withColumn("__s", F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0))
    return flagged.withColumn(name, F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__s")


def steps(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """``df`` with ``step``, the change of log2 from the row before, and ``edge``: it is larger than max(0.35, 6 MAD of the steps); none under three points."""
    w = _by(keys, order)
    logged = F.log2(F.greatest(F.col(x), F.lit(1 / 65535)))
    stepped = df.withColumn("__l", logged).withColumn("step", F.abs(F.col("__l") - F.lag("__l").over(w))).withColumn("__n", F.count("*").over(Window.partitionBy(*keys)))
    spread = with_mad(stepped, keys, F.col("step"), "__mad")
    edge = (F.col("__n") >= 3) & (F.col("step") > F.greatest(F.lit(0.35), 6 * F.col("__mad")))
    return spread.withColumn("edge", F.coalesce(edge, F.lit(False))).drop("__l", "__n", "__mad", "__med")


def boundaries(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """Change points: the rows at an edge, with their step."""
    return steps(df, keys, order, x).where("edge").drop("edge")


def segments(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """Half-open ranges [start, start + count) between change points with the upper median and maximum of x: one scan, one exchange by key."""
    own = [*keys, "segment"]
    marked = islands(steps(df.select(*keys, order, x), keys, order, x), keys, order, F.col("edge"), "segment")
    med = with_upper_median(marked, own, F.col(x), "med")
    return med.groupBy(*own).agg(F.min(order).alias("start"), F.count("*").alias("count"), F.max(x).alias("max"), F.first("med").alias("med"))


def capture_segments(points: DataFrame, frames: DataFrame, totals: DataFrame, key: str, i: str, x: str, values: Sequence[str]) -> DataFrame:
    """(key, start, count, values): segments of whole captures from sampled points, their edges refined to the frame.

    ``points`` are samples, ``frames`` has (key, i, x) of the frames between them, ``totals`` (key, total). A segment has the upper median of
    each of ``values`` over its points; one without points has those of the point nearest to its start, the earlier on ties.
    Captures of fewer than three points, or without an edge, are one segment. Windows are by capture.
    """
    from .placement import refine_boundaries

    w = _by([key], i)
    told = steps(points, [key], i, x).withColumns({"__lo": F.lag(i).over(w), "__lo_med": F.lag(x).over(w)})
    edges = told.where("edge").select(key, F.col("__lo").alias("lo"), F.col(i).alias("hi"), F.col("__lo_med").alias("lo_med"), F.col(x).alias("hi_med"))
    exact = refine_boundaries(edges, frames, key, i, x).select(key, F.col("frame").cast("long").alias("start"))
    starts = exact.unionByName(totals.select(key, F.lit(0).cast("long").alias("start"))).distinct().join(totals, key).where(F.col("start") < F.col("total"))
    ranges = starts.withColumn("count", F.coalesce(F.lead("start").over(_by([key], "start")), F.col("total")) - F.col("start"))
    sample = F.struct(F.col(i).cast("long").alias("at"), *values)
    both = ranges.select(key, F.col("start").alias("__i"), F.lit(0).alias("__kind"), "start", "count", F.lit(None).cast(points.select(sample.alias("s")).schema["s"].dataType).alias("s"))
    both = both.unionByName(points.select(key, F.col(i).cast("long").alias("__i"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("count"), sample.alias("s")))
    at = Window.partitionBy(key).orderBy("__i", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = around(both, [key], ["__i", "__kind"], F.col("s"), "__p", "__q").withColumns({"start": F.last("start", True).over(at), "count": F.last("count", True).over(at)})
    for v in values:
        placed = with_upper_median(placed, [key, "start"], F.col(f"s.{v}"), f"__{v}")
    rows = placed.where("__kind = 0 and count > 0")
    later = F.col("__p").isNull() | (F.col("__q").isNotNull() & (F.col("__q.at") - F.col("start") < F.col("start") - F.col("__p.at")))
    near = F.when(later, F.col("__q")).otherwise(F.col("__p"))
    return rows.select(key, "start", "count", *(F.coalesce(f"__{v}", near[v]).alias(v) for v in values))


#: Names of the levels where there are three of them.
THREE_LEVELS = ("short", "mid", "long")


def classify(segs: DataFrame, order: Sequence[str], gap: float = 0.5) -> DataFrame:
    """Segments with ``state``, ``level`` and ``level_name``: unfiltered from the first blown one to the last, in ``order``; levels among the stable ones of these.

    Without a blown segment all are filtered. The span, and the highest level, are one row each that goes to all.
    """
    at = F.struct(*order)
    span = segs.where("kind = 'blown'").agg(F.min(at).alias("__first"), F.max(at).alias("__last"))
    told = segs.join(F.broadcast(span)).withColumn("state", F.when((at >= F.col("__first")) & (at <= F.col("__last")), "unfiltered").otherwise("filtered")).drop("__first", "__last")
    corona = exposure_levels(told.where("state = 'unfiltered' and kind = 'stable'"), gap)
    most = F.broadcast(corona.agg(F.max("level").alias("__most")))
    three = F.element_at(F.array(*map(F.lit, THREE_LEVELS)), F.col("level").cast("int") + 1)
    named = corona.join(most).withColumn("level_name", F.when(F.col("__most") == 2, three).otherwise(F.concat(F.lit("L"), F.col("level").cast("string")))).drop("__most")
    others = told.where("not (state = 'unfiltered' and kind = 'stable')")
    return named.unionByName(others.withColumns({"level": F.lit(None).cast(corona.schema["level"].dataType), "level_name": F.lit(None).cast("string")}))


def merge_short(segs: DataFrame, keys: Sequence[str], shortest: int, blown: float) -> DataFrame:
    """Neighbouring short segments that are not blown become one transition."""
    short = (F.col("count") < shortest) & (F.col("med") < blown)
    marked = segs.withColumn("short", short)
    runs = islands(marked, keys, "start", ~(F.col("short") & F.lag("short").over(_by(keys, "start"))), "run")
    return runs.groupBy(*keys, "run").agg(F.min("start").alias("start"), F.sum("count").alias("count"), F.max("med").alias("med"), F.min_by("max", "start").alias("first_max"), F.when(F.bool_and("short"), "transition").when(F.bool_or(F.col("med") >= blown), "blown").otherwise("stable").alias("kind"))


def exposure_levels(segs: DataFrame, gap: float = 0.5) -> DataFrame:
    """Levels over all segments: a new one where log2 of the sorted medians jumps by more than ``gap``.

    No jump is within a bin of width ``gap``, so only the ends of the occupied bins are ordered: as many rows as the
    range of brightness has bins.
    """
    logged = segs.withColumn("__l", F.log2(F.greatest("med", F.lit(1 / 65535)))).withColumn("__bin", F.floor(F.col("__l") / gap))
    w = Window.orderBy("__bin")
    ends = logged.groupBy("__bin").agg(F.min("__l").alias("lo"), F.max("__l").alias("hi"))
    levels = ends.withColumn("level", F.sum(F.when(F.col("lo") - F.lag("hi").over(w) > gap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return logged.join(levels.select("__bin", "level"), "__bin").drop("__l", "__bin")


def sessions(df: DataFrame, keys: Sequence[str], order: str, gap: float) -> DataFrame:
    """Sessions of rows not more than ``gap`` apart."""
    far = F.col(order) - F.lag(order).over(_by(keys, order)) > gap
    return islands(df, keys, order, F.coalesce(far, F.lit(True)), "session").groupBy(*keys, "session").agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count("*").alias("n"))


def longest(df: DataFrame, keys: Sequence[str], size: Column, start: str) -> DataFrame:
    """The row with the largest size per key, the first on ties."""
    w = Window.partitionBy(*keys).orderBy(size.desc(), F.col(start))
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def runs_where(df: DataFrame, keys: Sequence[str], order: str, pred: Column) -> DataFrame:
    """(start, count) of the runs of rows that satisfy a predicate."""
    w = _by(keys, order)
    marked = df.withColumn("__p", F.coalesce(pred, F.lit(False))).withColumn("__n", F.row_number().over(w))
    marked = marked.where("__p").withColumn("__g", F.col("__n") - F.row_number().over(w))
    return marked.groupBy(*keys, "__g").agg(F.min(order).alias("start"), F.count("*").alias("count")).drop("__g")


def shard_spans(df: DataFrame, keys: Sequence[str], seq: str, workers: int) -> DataFrame:
    """Contiguous spans, cut every ceil(n / workers) rows and at every gap."""
    w = _by(keys, seq)
    n = F.count("*").over(Window.partitionBy(*keys))
    block = F.floor((F.row_number().over(w) - 1) / F.ceil(n / workers))
    marked = df.withColumn("__b", block)
    cut = islands(marked, keys, seq, (F.col(seq) - F.lag(seq).over(w) != 1) | (F.col("__b") != F.lag("__b").over(w)), "shard")
    return cut.groupBy(*keys, "shard").agg(F.min(seq).alias("lo"), F.max(seq).alias("hi"))


def gain_chain(df: DataFrame, keys: Sequence[str], order: str, entry: str, leave: str, anchor_size: str) -> DataFrame:
    """Gains that join neighbours' levels (at least 1/65535), relative to the longest row of each key (first on ties)."""
    w = _by(keys, order)
    lit = lambda c: F.greatest(c, F.lit(1 / 65535))
    ratio = F.log(lit(F.lag(leave).over(w)) / lit(F.col(entry)))
    ratio = F.when(F.lag(leave).over(w).isNotNull() & F.col(entry).isNotNull(), ratio)
    summed = df.withColumn("__r", F.coalesce(ratio, F.lit(0.0))).withColumn("__c", F.sum("__r").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    anchor = F.first("__c").over(Window.partitionBy(*keys).orderBy(F.col(anchor_size).desc(), order))
    return summed.withColumn("gain", F.exp(F.col("__c") - anchor)).drop("__r", "__c")


def stack_depth(df: DataFrame, keys: Sequence[str], index: str, most: int, end: str, dense: Column | None = None, bead: Column | None = None, resolve: Column | None = None, bead_most: int = 3) -> DataFrame:
    """Frames that may be stacked, at least 1 and never past the segment's ``end``.

    Bead frames: ``bead_most``. Resolve frames: 1. Dense ones: ``most``, their groups overlap. Others: up to the next row's.
    """
    yes = lambda c: F.lit(False) if c is None else F.coalesce(c, F.lit(False))
    left = F.col(end) - F.col(index)
    gap = F.coalesce(F.lead(index).over(_by(keys, index)) - F.col(index), F.lit(most))
    depth = F.when(yes(bead), F.least(F.lit(bead_most), left)).when(yes(resolve), F.lit(1)).when(yes(dense), F.least(F.lit(most), left)).otherwise(F.least(F.lit(most), gap, left))
    return df.withColumn("stack", F.greatest(F.lit(1), depth))


def resample(df: DataFrame, keys: Sequence[str], index: str, values: Sequence[str], want: int) -> DataFrame:
    """``want`` rows per key at lo + floor(j (hi - lo) / want), interpolated between the samples around."""
    spans = df.groupBy(*keys).agg(F.min(index).alias("lo"), F.max(index).alias("hi"))
    grid = spans.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(want - 1))).alias("j"), "lo", "hi").withColumn(index, F.col("lo") + F.floor(F.col("j") * (F.col("hi") - F.col("lo")) / want))
    return interpolate(df, grid.select(*keys, "j", index), keys, index, values)


def interpolate(df: DataFrame, probes: DataFrame, keys: Sequence[str], index: str, values: Sequence[str]) -> DataFrame:
    """Probes with each value interpolated between the last sample at or before and the next one after, clamped."""
    extra = [c for c in probes.columns if c not in keys and c != index]
    sample = F.struct(F.col(index).alias("i"), *values)
    both = df.select(*keys, index, sample.alias("s"), F.lit(0).alias("probe"), *(F.lit(None).alias(c) for c in extra)).unionByName(probes.select(*keys, index, F.lit(None).alias("s"), F.lit(1).alias("probe"), *extra))
    met = around(both, keys, [index, "probe"], F.col("s"), "p", "q").where("probe = 1")
    p, q = F.coalesce("p", "q"), F.coalesce("q", "p")
    met = met.withColumns({"p": p, "q": q})
    share = F.when(F.col("q.i") == F.col("p.i"), 0.0).otherwise((F.col(index) - F.col("p.i")) / (F.col("q.i") - F.col("p.i")))
    return met.select(*keys, *extra, index, *((F.col(f"p.{v}") + (F.col(f"q.{v}") - F.col(f"p.{v}")) * share).alias(v) for v in values))


def fill_gaps(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """Forward fill, then backward fill, then 0."""
    return around(df, keys, [order], F.col(x), "__p", "__q").withColumn("filled", F.coalesce("__p", "__q", F.lit(0.0))).drop("__p", "__q")


def _upper(a: Column) -> Column:
    s = F.sort_array(a)
    return F.element_at(s, (F.floor(F.size(s) / 2) + 1).cast("int"))


def rolling_median(df: DataFrame, keys: Sequence[str], order: str, x: str, width: int, name: str) -> DataFrame:
    """Centred rolling upper median; the window is clipped at the ends."""
    half = width // 2
    return df.withColumn(name, _upper(F.collect_list(x).over(_by(keys, order).rowsBetween(-half, half))))


def time_smooth(df: DataFrame, keys: Sequence[str], t: str, x: str, half: float, name: str) -> DataFrame:
    """Median, then mean, over ``half`` seconds to either side, both ends included."""
    reach = round(half * 1_000_000)
    w = Window.partitionBy(*keys).orderBy(F.round(F.col(t) * 1_000_000).cast("long")).rangeBetween(-reach, reach)
    return df.withColumn("__m", _upper(F.collect_list(x).over(w))).withColumn(name, F.avg("__m").over(w)).drop("__m")


def slew_limit(df: DataFrame, keys: Sequence[str], order: str, x: str, most: float, name: str) -> DataFrame:
    """Each value follows the one before by at most ``most`` a step. Rows stream through in their order; a task holds one value."""
    kinds = dict(df.dtypes)
    rows = df.select(F.struct(*keys).alias("k"), order, F.col(x).cast("double").alias(x))
    sorted_rows = rows.repartition("k").sortWithinPartitions("k", order)

    def run(batches):
        key, at = None, 0.0
        for batch in batches:
            out = []
            for k, value in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at = value if k != key else at + max(-most, min(most, value - at))
                key = k
                out.append(at)
            yield pa.RecordBatch.from_arrays([loose(batch.column(0)), batch.column(1), pa.array(out, pa.float64())], names=["k", order, name])

    return sorted_rows.mapInArrow(run, f"k {dict(rows.dtypes)['k']}, `{order}` {kinds[order]}, `{name}` double").select("k.*", order, name)


def smooth_series(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """Rolling median of 7, mean of 9, then at most 1 a step."""
    med = rolling_median(df, keys, order, x, 7, "__med")
    mean = med.withColumn("__mean", F.avg("__med").over(_by(keys, order).rowsBetween(-4, 4)))
    return slew_limit(mean, keys, order, "__mean", 1.0, "smooth")


def longest_steady_run(df: DataFrame, keys: Sequence[str], order: str, x: str, thrash: float) -> DataFrame:
    """Of the runs whose steps to both neighbours stay within ``thrash``, the longest."""
    w = _by(keys, order)
    ok = F.greatest(F.coalesce(F.abs(F.col(x) - F.lag(x).over(w)), F.lit(0.0)), F.coalesce(F.abs(F.lead(x).over(w) - F.col(x)), F.lit(0.0))) <= thrash
    return longest(runs_where(df.withColumn("__ok", ok), keys, order, F.col("__ok")), keys, F.col("count"), "start")


def trust_gate(df: DataFrame, keys: Sequence[str], x: str, floor: float) -> DataFrame:
    """``trusted``: not farther from the upper median than max(6 times the upper median deviation, floor)."""
    told = with_mad(df, keys, F.col(x), "__d", "__m")
    return told.withColumn("trusted", F.abs(F.col(x) - F.col("__m")) <= F.greatest(6 * F.col("__d"), F.lit(floor))).drop("__m", "__d")


def drop_failed_groups(df: DataFrame, keys: Sequence[str], x: str, spread: float, measurable: float) -> DataFrame:
    """Rows to keep: trusted ones; all of a mostly untrusted group if its spread is small and enough is measurable."""
    dev = df.join(upper_median(df, keys, x, "__m"), list(keys)).withColumn("__dev", F.abs(F.col(x) - F.col("__m")))
    g = dev.groupBy(*keys).agg(F.avg((~F.col("trusted")).cast("int")).alias("__bad"), F.avg(F.col(x).isNotNull().cast("int")).alias("__some"))
    p90 = ranked_p90(dev, keys)
    whole = (F.col("__p90") <= spread) & (F.col("__some") >= measurable)
    return df.join(g, list(keys)).join(p90, list(keys)).where(F.when(F.col("__bad") > 0.5, whole).otherwise(F.col("trusted"))).drop("__bad", "__some", "__p90")


def ranked_p90(dev: DataFrame, keys: Sequence[str]) -> DataFrame:
    from .stats import nearest_rank

    return nearest_rank(dev, keys, "__dev", {"__p90": 0.9})


def discontinuities(df: DataFrame, keys: Sequence[str], order: str, gap: int, ratio: float, blend: int) -> DataFrame:
    """``blend_left``: rows of a dissolve still to come after a jump in index or gain. No gain, or one of 0, counts as 1."""
    w = _by(keys, order)
    own = F.when(F.coalesce(F.col("gain"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("gain"))
    before = F.lag(own).over(w)
    cut = (F.col("index") - F.lag("index").over(w) > gap) | (F.greatest(own / before, before / own) > ratio)
    n = F.row_number().over(w)
    marked = df.withColumns({"__n": n, "cut": F.coalesce(cut, F.lit(False))})
    last = F.last(F.when(F.col("cut"), F.col("__n")), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("blend_left", F.greatest(F.lit(0), F.coalesce(F.lit(blend) - (F.col("__n") - last), F.lit(0)))).drop("__n")


def unwrap(df: DataFrame, keys: Sequence[str], order: str, a: str) -> DataFrame:
    """Angles with full turns added so that no step is larger than half a turn."""
    w = _by(keys, order)
    turns = F.coalesce(F.floor((F.col(a) - F.lag(a).over(w)) / (2 * F.pi()) + 0.5), F.lit(0))
    return df.withColumn("__t", turns).withColumn("unwrapped", F.col(a) - 2 * F.pi() * F.sum("__t").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__t")


def leading_prefix(df: DataFrame, keys: Sequence[str], order: str, pred: Column) -> DataFrame:
    """Rows before the first that fails the predicate."""
    run = F.min(pred.cast("int")).over(_by(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__ok", run).where("__ok = 1").drop("__ok")


def flatten_levels(df: DataFrame, keys: Sequence[str], order: str, x: str, gain: str, measurable: Column, most: float = 2.0, least: int = 3) -> DataFrame:
    """``gain`` times a correction that holds the rendered level (x times gain) at its key's upper median, within x``most`` and its inverse.

    Rows that are not measurable take the correction of the nearest one that is, the earlier on ties; a key with fewer than ``least`` keeps its gains.
    """
    w = _by(keys, order)
    level = df.withColumns({"__l": F.col(x) * F.col(gain), "__ok": F.coalesce(measurable, F.lit(False)), "__n": F.row_number().over(w)})
    good = level.where("__ok")
    many = good.groupBy(*keys).agg(F.count("*").alias("__many")).where(F.col("__many") >= least)
    target = upper_median(good, keys, "__l", "__target").join(many, list(keys)).drop("__many")
    g = F.when(F.col("__l") > 0, F.least(F.greatest(F.col("__target") / F.col("__l"), F.lit(1 / most)), F.lit(most))).otherwise(1.0)
    own = F.when(F.col("__ok") & F.col("__target").isNotNull(), F.struct(F.col("__n").alias("n"), g.alias("g")))
    met = around(level.join(target, list(keys), "left"), keys, [order], own, "__p", "__q")
    later = F.col("__p").isNull() | (F.col("__q").isNotNull() & (F.col("__q.n") - F.col("__n") < F.col("__n") - F.col("__p.n")))
    correction = F.coalesce(F.when(later, F.col("__q.g")).otherwise(F.col("__p.g")), F.lit(1.0))
    return met.withColumn("correction", correction).withColumn("flattened", F.when(F.col("__target").isNull(), F.col(gain)).otherwise(F.round(F.col(gain) * F.col("correction"), 8))).drop("__l", "__ok", "__n", "__target", "__p", "__q")


def settle(df: DataFrame, keys: Sequence[str], order: str, level: str, gain: str, measurable: Column) -> DataFrame:
    """``settled``: gains of measurable rows, brought down to what holds the level that the first of them is rendered with."""
    ok = F.coalesce(measurable, F.lit(False))
    anchor = df.where(ok).groupBy(*keys).agg(F.min_by(F.col(level) * F.col(gain), order).alias("__anchor"))
    want = F.col("__anchor") / F.col(level)
    return df.join(anchor, list(keys), "left").withColumn("settled", F.when(ok & (want < F.col(gain)), F.round(want, 8)).otherwise(F.col(gain))).drop("__anchor")
