"""Tracks through ordered frames: a centre carried from frame to frame, and smooth tracks by local polynomials."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .fits import loose
from .stats import with_upper_median

# ---------------------------------------------------------------- a centre carried along

#: A fit with less arc (degrees) or fewer points than these is searched for anew in the whole frame.
REACQUIRE_ARC, REACQUIRE_N = 100, 60


def follow(candidates: DataFrame, keys: Sequence[str], order: str, window: float, arc: int = REACQUIRE_ARC, n: int = REACQUIRE_N) -> DataFrame:
    """(keys, order, x, y, n, arc, method): each frame's centre, sought where the frame before left it.

    ``candidates`` has a row for each fit of a frame: keys, order, x, y, n, arc, score. The fit nearest to the last centre, within
    ``window``, is taken if its arc and points suffice; else the fit of the best score takes its place if that has more arc
    or more points, or if none was near. The first frame of a key, and all until one has a fit, take the best score.
    Ties go to the better score, then the smaller x, y, n and arc. A frame whose only row has no x has no centre, and the last one holds.

    A key's frames stream through one task in their order; it holds one centre and the fits of one frame.
    """
    kinds = dict(candidates.dtypes)
    rows = candidates.select(F.struct(*keys).alias("k"), F.col(order).alias("o"), *(F.col(c).cast("double").alias(c) for c in ("x", "y", "n", "arc", "score")))
    dealt = rows.repartition("k").sortWithinPartitions("k", "o", F.col("score").desc_nulls_last(), "x", "y", F.col("n").asc_nulls_last(), F.col("arc").asc_nulls_last())
    far = window * window

    def choose(fits: list[tuple], last: tuple | None) -> tuple:
        """(x, y, n, arc, method) of one frame; fits are in order of their score."""
        fits = [f for f in fits if f[0] is not None and f[1] is not None]
        if not fits:
            return None, None, None, None, "none"
        best = fits[0]
        if last is None:
            return *best[:4], "best"
        near = min(fits, key=lambda f: (f[0] - last[0]) ** 2 + (f[1] - last[1]) ** 2)  # the first of equals has the better score
        if (near[0] - last[0]) ** 2 + (near[1] - last[1]) ** 2 > far:
            return *best[:4], "best"
        a, b = near[3] or 0, near[2] or 0
        if (a < arc or b < n) and ((best[3] or 0) > a or (best[2] or 0) > b):
            return *best[:4], "best"
        return *near[:4], "near"

    def run(batches):
        now, fits, last = None, [], None
        kinds_of: list[pa.DataType] = []

        def packed(out):
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kinds_of[0]), pa.array(columns[1], kinds_of[1]), *(pa.array(c, pa.float64()) for c in columns[2:6]), pa.array(columns[6], pa.string())], names=["k", "o", "x", "y", "n", "arc", "method"])

        for batch in batches:
            kinds_of[:] = [loose(batch.column(0)).type, batch.schema.field(1).type]
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                frame = (row[0], row[1])
                if frame != now:
                    if now is not None:
                        told = choose(fits, last)
                        out.append((*now, *told))
                        last = told[:2] if told[0] is not None else last
                        if frame[0] != now[0]:
                            last = None
                    now, fits = frame, []
                fits.append(row[2:])
            if out:
                yield packed(out)
        if now is not None:
            yield packed([(*now, *choose(fits, last))])

    schema = f"k {dict(rows.dtypes)['k']}, o {kinds[order]}, x double, y double, n double, arc double, method string"
    return dealt.mapInArrow(run, schema).select("k.*", F.col("o").alias(order), "x", "y", "n", "arc", "method")


def first_radius(fits: DataFrame, order: Sequence[str], radius: str, arc: str, searched: str, least: int = 120) -> DataFrame:
    """One row: the radius of the first fit in ``order``, or what a search found (``searched``) if its arc is below ``least``."""
    told = F.when(F.col(arc) >= least, F.col(radius)).otherwise(F.coalesce(F.col(searched), F.col(radius)))
    return fits.where(F.col(radius).isNotNull()).agg(F.min_by(told, F.struct(*order)).alias("radius"))


# ---------------------------------------------------------------- local polynomials

#: Least points of a window, and how many sigma its residuals may have.
LEAST_WINDOW, SIGMAS = 9, 2.5
#: Numbers held at once by a fit of many windows.
HELD = 1 << 20


def second_difference_noise(x: np.ndarray) -> float:
    """Scatter of a smooth series, from its second differences."""
    if len(x) < 3:
        return 0.0
    d = np.sort(np.abs(x[:-2] - 2 * x[1:-1] + x[2:]))
    return float(d[len(d) // 2] / 0.6745 / math.sqrt(6))


def _upper_medians(values: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Upper median of each row's kept values."""
    ordered = np.sort(np.where(keep, values, np.inf), axis=1)
    return ordered[np.arange(len(values)), keep.sum(axis=1) // 2]


def _fit_spans(t: np.ndarray, x: np.ndarray, starts: np.ndarray, width: int, degree: int, passes: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, middle, half) of the polynomial of each span, refitted without outliers; in powers of (t - middle) / half."""
    at = starts[:, None] + np.arange(width)
    tt, xx = t[at], x[at]
    middle, half = (tt[:, 0] + tt[:, -1]) / 2, np.maximum((tt[:, -1] - tt[:, 0]) / 2, 1e-12)
    u = ((tt - middle[:, None]) / half[:, None])[:, :, None] ** np.arange(degree + 1)
    keep = np.ones(at.shape, bool)
    c = np.zeros((len(starts), degree + 1))
    for _ in range(passes):
        w = u * keep[:, :, None]
        c = np.linalg.solve(np.einsum("swi,swj->sij", w, u) + 1e-15 * np.eye(degree + 1), np.einsum("swi,sw->si", w, xx)[:, :, None])[:, :, 0]
        r = np.abs(xx - np.einsum("swi,si->sw", u, c))
        new = keep & (r <= np.maximum(2.5 * _upper_medians(r, keep), 1e-4)[:, None])
        enough = new.sum(axis=1) >= np.maximum(degree + 2, 0.4 * keep.sum(axis=1))
        if not (enough & (new != keep).any(axis=1)).any():
            break
        keep = np.where(enough[:, None], new, keep)
    return c, middle, half


def smooth_track(t: np.ndarray, x: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(fitted, window) at each point: the widest of the halved windows that reproduces the middle of itself within the scatter.

    None if there are fewer than degree + 2 points. A window near an end of the series is moved inwards, not cut.
    """
    n = len(x)
    least = min(n, max(degree + 2, LEAST_WINDOW))
    if n < degree + 2:
        return None
    tolerance = max(SIGMAS * second_difference_noise(x), 1e-4)
    widths, w = [], n
    while w > least:
        widths.append(w)
        w = max(least, w // 2)
    widths.append(least)
    fitted, used = np.empty(n), np.zeros(n, np.int64)
    todo = np.arange(n)
    for width in widths:
        lo = np.clip(todo - width // 2, 0, n - width)
        q = max(1, width // 4)
        passed = np.zeros(len(todo), bool)
        block = max(1, HELD // (width * (degree + 1)))
        for i in range(0, len(todo), block):
            point, start = todo[i : i + block], lo[i : i + block]
            spans, which = np.unique(start, return_inverse=True)
            c, middle, half = (a[which] for a in _fit_spans(t, x, spans, width, degree))
            at = point[:, None] + np.arange(-q, q + 1)
            inside = (at >= start[:, None]) & (at < start[:, None] + width)
            at = np.clip(at, 0, n - 1)
            value = lambda s: np.einsum("pwi,pi->pw", ((s - middle[:, None]) / half[:, None])[:, :, None] ** np.arange(degree + 1), c)  # noqa: B023, E731
            far = _upper_medians(np.abs(x[at] - value(t[at])), inside)
            fitted[point] = value(t[point][:, None])[:, 0]
            used[point] = width
            passed[i : i + block] = far <= tolerance
        todo = todo[~passed]
        if not len(todo):
            break
    return fitted, used


def unwrapped(x: np.ndarray) -> np.ndarray:
    """Angles that follow each other without jumps of more than half a turn."""
    if not len(x):
        return x
    d = np.diff(x)
    return x - 2 * math.pi * np.append(0, np.cumsum(np.ceil((np.abs(d) - math.pi) / (2 * math.pi)).clip(0) * np.sign(d)))


def local_polynomials(df: DataFrame, keys: Sequence[str], t: str, x: str, degree: int = 2, angles: bool = False) -> DataFrame:
    """(keys, t, value, fitted, width): each key's series smoothed by ``smooth_track``; ``angles`` are unwrapped first.

    Rows without t or x are left out; a key of too few rows has null fits. A task holds three numbers a row of one key, and time
    grows with the square of a key's rows where windows are wide, for each point has a window of its own.
    """
    narrow = df.where(F.col(t).isNotNull() & F.col(x).isNotNull()).select(F.struct(*keys).alias("k"), F.col(t).cast("double").alias("t"), F.col(x).cast("double").alias("x"))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("x", "ascending")])
        at, value = table.column("t").to_numpy(), table.column("x").to_numpy()
        value = unwrapped(value) if angles else value
        told = smooth_track(at - at.mean(), value, degree)
        n = len(at)
        fits = [pa.nulls(n, pa.float64()), pa.nulls(n, pa.int64())] if told is None else [pa.array(told[0]), pa.array(told[1])]
        return pa.table([loose(table.column("k")), pa.array(at), pa.array(value), *fits], names=["k", "t", "value", "fitted", "width"])

    found = narrow.groupBy("k").applyInArrow(fit, f"k {dict(narrow.dtypes)['k']}, t double, value double, fitted double, width long")
    return found.select("k.*", F.col("t").alias(t), "value", "fitted", "width")


def cusp_track(df: DataFrame, keys: Sequence[str], t: str, cusps: Sequence[str], degree: int = 2) -> DataFrame:
    """(keys, t, cusp, value, fitted, width): the angle of each cusp as a smooth function of time, apart from the other's."""
    long = df.select(*keys, t, F.explode(F.array(*(F.struct(F.lit(c).alias("cusp"), F.col(c).cast("double").alias("angle")) for c in cusps))).alias("c")).select(*keys, t, "c.cusp", "c.angle")
    return local_polynomials(long, [*keys, "cusp"], t, "angle", degree, True)


# ---------------------------------------------------------------- discs of a known radius in all frames at once


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder ``spark.checkpoint.dir``; a folder of our own only in local mode where that is unset."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = f"file://{tempfile.mkdtemp(prefix='chronoframe-')}"
        context.setCheckpointDir(base)
    return df.checkpoint()


def fixed_radius_fits(points: DataFrame, keys: Sequence[str], x: str, y: str, seeds: DataFrame, radius: float, rounds: int = 8, wide: float = 40.0, narrow: float = 14.0) -> DataFrame:
    """(keys, cx, cy, n): a circle of known radius through each frame's points, all frames solved at once by Gauss-Newton.

    ``seeds`` has keys, cx, cy. Each round sums the 2 x 2 normal matrices of the points within a tolerance that closes from ``wide`` to
    ``narrow``: one aggregation by frame, combined before the shuffle. A frame with fewer than 3 such points, or whose matrix
    has no inverse, keeps its centre of the round before. A round's centres, one row a frame, are checkpointed.
    """
    centres = seeds.select(*keys, F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy"), F.lit(0).cast("long").alias("n"))
    for k in range(rounds):
        tolerance = wide + (narrow - wide) * k / max(1, rounds - 1)
        dx, dy = F.col(x) - F.col("cx"), F.col(y) - F.col("cy")
        j = points.join(centres.select(*keys, "cx", "cy"), list(keys)).withColumn("__d", F.hypot(dx, dy)).where((F.abs(F.col("__d") - radius) <= tolerance) & (F.col("__d") > 0))
        u, v, r = dx / F.col("__d"), dy / F.col("__d"), F.col("__d") - radius
        sums = j.groupBy(*keys).agg(F.sum(u * u).alias("uu"), F.sum(u * v).alias("uv"), F.sum(v * v).alias("vv"), F.sum(u * r).alias("ur"), F.sum(v * r).alias("vr"), F.count("*").alias("m"))
        det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
        ok = (F.col("m") >= 3) & (F.abs(det) > 1e-9)
        centres = centres.join(sums, list(keys), "left").select(
            *keys,
            (F.col("cx") + F.coalesce(F.when(ok, F.try_divide(F.col("ur") * F.col("vv") - F.col("vr") * F.col("uv"), det)), F.lit(0.0))).alias("cx"),
            (F.col("cy") + F.coalesce(F.when(ok, F.try_divide(F.col("vr") * F.col("uu") - F.col("ur") * F.col("uv"), det)), F.lit(0.0))).alias("cy"),
            F.coalesce("m", F.lit(0)).alias("n"),
        )
        centres = cut_lineage(centres)
    return centres


def linear_track(offsets: DataFrame, t: str, x: str, y: str, least: int = 3) -> DataFrame:
    """One row: ax, bx, ay, by, n, so that x = ax t + bx; all null with fewer than ``least`` rows."""
    f = offsets.where(F.col(t).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        *(e.alias(c) for c, e in {"ax": F.regr_slope(x, t), "bx": F.regr_intercept(x, t), "ay": F.regr_slope(y, t), "by": F.regr_intercept(y, t), "n": F.count("*")}.items())
    )
    return f.select(*(F.when(F.col("n") >= least, F.col(c)).alias(c) for c in ("ax", "bx", "ay", "by")), "n")


def validated_track(track: DataFrame, gap: float, observed: Column, within: float = 0.25) -> DataFrame:
    """``track`` with ``predicted``, the time it keeps its distance below ``gap``, and ``valid``: that is within a share of what was observed."""
    a = F.col("ax") ** 2 + F.col("ay") ** 2
    b = 2 * (F.col("ax") * F.col("bx") + F.col("ay") * F.col("by"))
    d = b * b - 4 * a * (F.col("bx") ** 2 + F.col("by") ** 2 - F.lit(gap * gap))
    told = track.withColumn("predicted", F.when((a > 0) & (d >= 0), F.try_divide(F.sqrt(F.greatest(d, F.lit(0.0))), a)))
    return told.withColumn("valid", F.coalesce(F.abs(F.col("predicted") - observed) <= within * observed, F.lit(False)))


# ---------------------------------------------------------------- runs with a box of one size

# A run's box is so many times the median extent, within these bounds.
BEAD_BOX, BEAD_LEAST, BEAD_MOST = 1.35, 45.0, 80.0
CUSP_BOX, CUSP_LEAST, CUSP_MOST = 1.3, 40.0, 46.0


def bead_runs(df: DataFrame, keys: Sequence[str], order: str, x: str, y: str, extent: str, near: Column, gap: int = 4, quadratic: int = 25) -> DataFrame:
    """(keys, order, run, n, x, y, half) of the measured rows of runs that touch a contact: modelled centres, one box size a run.

    Rows with a null x, y or extent are not measured and do not link. Measured rows at most ``gap`` apart in ``order`` are a run; it
    stays if ``near`` holds on any of its measured rows. Centres are the least-squares polynomial of a run in ``order``:
    a parabola from ``quadratic`` rows on, else a line; a run at a single place of ``order`` has its mean, one at two places a line.
    All of it is windows over one exchange by key.
    """
    by = Window.partitionBy(*keys).orderBy("__o")
    run = Window.partitionBy(*keys, "run")
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(extent).isNotNull()).select(*keys, F.col(order).alias("__o"), F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"), F.col(extent).cast("double").alias("__e"), F.coalesce(near, F.lit(False)).alias("__near"))
    rows = rows.withColumn("__new", F.coalesce(F.col("__o") - F.lag("__o").over(by) > gap, F.lit(True)).cast("long"))
    rows = rows.withColumn("run", F.sum("__new").over(by.rangeBetween(Window.unboundedPreceding, 0)) - 1)
    rows = rows.withColumns({"n": F.count("*").over(run), "__kept": F.max("__near").over(run), "__t": F.col("__o") - F.avg("__o").over(run), "__rank": F.row_number().over(run.orderBy("__e")) - 1})
    rows = rows.where("__kept").withColumn("__med", F.max(F.when(F.col("__rank") == F.floor(F.col("n") / 2), F.col("__e"))).over(run))
    t = F.col("__t")
    rows = rows.withColumns({f"__s{p}": F.sum(F.pow(t, F.lit(p))).over(run) for p in (2, 3, 4)})
    n, s2, s3, s4 = (F.col(c) for c in ("n", "__s2", "__s3", "__s4"))

    def modelled(v: str) -> Column:
        """Normal equations of centred places: their first moment is zero, so they fall apart."""
        s, st, stt = (F.sum(F.col(v) * F.pow(t, F.lit(p))).over(run) for p in range(3))
        line = F.coalesce(F.try_divide(st, s2), F.lit(0.0))
        left = s4 - s2 * s2 / n - F.coalesce(F.try_divide(s3 * s3, s2), F.lit(0.0))
        bend = F.try_divide(stt - s2 * s / n - F.try_divide(s3 * st, s2), F.when(left > 1e-9 * s4, left))
        bend = F.when(n >= quadratic, F.coalesce(bend, F.lit(0.0))).otherwise(0.0)
        return s / n + (line - bend * F.coalesce(F.try_divide(s3, s2), F.lit(0.0))) * t + bend * (t * t - s2 / n)

    half = F.least(F.greatest(BEAD_BOX * F.col("__med"), F.lit(BEAD_LEAST)), F.lit(BEAD_MOST))
    return rows.select(*keys, F.col("__o").alias(order), "run", "n", modelled("__x").alias("x"), modelled("__y").alias("y"), half.alias("half"))


def cusp_boxes(df: DataFrame, keys: Sequence[str], opening: str, least: int = 10, quadratic: int = 25) -> DataFrame:
    """(keys, n, degree, half) of each key with at least ``least`` openings: the degree its track may have and its box's half-width. Null openings do not count."""
    med = with_upper_median(df.where(F.col(opening).isNotNull()), keys, F.col(opening).cast("double"), "__m")
    half = F.least(F.greatest(CUSP_BOX * F.max("__m"), F.lit(CUSP_LEAST)), F.lit(CUSP_MOST))
    return med.groupBy(*keys).agg(F.count("*").alias("n"), half.alias("half")).where(F.col("n") >= least).withColumn("degree", F.when(F.col("n") >= quadratic, 2).otherwise(1))
