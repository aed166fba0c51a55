"""Robust fits: lines, polynomials and circles; phases and contacts of a linear track."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def robust_fit(t: np.ndarray, x: np.ndarray, passes: int = 3) -> tuple[float, float, int]:
    """(slope, intercept, rows kept): each pass keeps rows within max(2.5 upper median residuals, 0.5), if that is enough of those it had."""
    slope = intercept = 0.0
    for _ in range(passes):
        n = len(t)
        if n < 2:
            break
        dt = t - t.mean()
        spread = float((dt * dt).sum())
        if n * spread < 1e-9:
            slope, intercept = 0.0, float(x.mean())
            break
        slope = float((dt * x).sum() / spread)
        intercept = float(x.mean() - slope * t.mean())
        r = np.abs(x - (slope * t + intercept))
        keep = r <= max(2.5 * np.partition(r, n // 2)[n // 2], 0.5)
        if keep.sum() < max(4, 0.3 * n):
            break
        t, x = t[keep], x[keep]
    return slope, intercept, len(t)


def loose(k: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A struct column whose fields may be null, as Spark declares the columns that a task returns."""
    if isinstance(k, pa.ChunkedArray):
        k = k.combine_chunks()
    return pa.StructArray.from_arrays(k.flatten(), fields=[pa.field(f.name, f.type) for f in k.type])


def robust_line(df: DataFrame, keys: Sequence[str], t: str, x: str, passes: int = 3) -> DataFrame:
    """``robust_fit`` of each key: one shuffle by key; a task holds two numbers a row of one key."""
    narrow = df.where(F.col(t).isNotNull() & F.col(x).isNotNull()).select(F.struct(*keys).alias("k"), F.col(t).cast("double").alias("t"), F.col(x).cast("double").alias("x"))

    def fit(table: pa.Table) -> pa.Table:
        slope, intercept, n = robust_fit(table.column("t").to_numpy(), table.column("x").to_numpy(), passes)
        return pa.table({"k": loose(table.column("k").slice(0, 1)), "slope": [slope], "intercept": [intercept], "n": pa.array([n], pa.int64())})

    found = narrow.groupBy("k").applyInArrow(fit, f"k {dict(narrow.dtypes)['k']}, slope double, intercept double, n long")
    return found.select("k.*", "slope", "intercept", "n")


def circle_fit(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Algebraic circle through points, from the sums of its normal equations (about the points' mean)."""
    m = df.groupBy(*keys).agg(F.avg(x).alias("mx"), F.avg(y).alias("my"))
    u, v = F.col(x) - F.col("mx"), F.col(y) - F.col("my")
    z = u * u + v * v
    s = df.join(m, list(keys)).groupBy(*keys).agg(*(F.sum(e).alias(n) for n, e in {"suu": u * u, "svv": v * v, "suv": u * v, "suz": u * z, "svz": v * z, "sz": z}.items()), F.count("*").alias("n"), F.first("mx").alias("mx"), F.first("my").alias("my"))
    det = F.col("suu") * F.col("svv") - F.col("suv") * F.col("suv")
    cu = (F.col("suz") * F.col("svv") - F.col("svz") * F.col("suv")) / (2 * det)
    cv = (F.col("svz") * F.col("suu") - F.col("suz") * F.col("suv")) / (2 * det)
    return s.where(F.abs(det) > 1e-12).select(*keys, "n", (F.col("mx") + cu).alias("cx"), (F.col("my") + cv).alias("cy"), F.sqrt(cu * cu + cv * cv + F.col("sz") / F.col("n")).alias("r"))


def circle_quality(df: DataFrame, fit: DataFrame, keys: Sequence[str], x: str, y: str, tol: float = 8.0) -> DataFrame:
    """Inliers within ``tol``, their RMS, and the arc: ten degrees for each of 36 bins that has one."""
    j = df.join(fit, list(keys))
    d = F.sqrt((F.col(x) - F.col("cx")) ** 2 + (F.col(y) - F.col("cy")) ** 2) - F.col("r")
    turn = F.atan2(F.col(y) - F.col("cy"), F.col(x) - F.col("cx"))
    j = j.withColumns({"__d": d, "__b": F.pmod(F.floor((turn + math.pi) / (2 * math.pi) * 36), F.lit(36))}).where(F.abs("__d") <= tol)
    return j.groupBy(*keys).agg(F.count("*").alias("inliers"), F.sqrt(F.avg(F.col("__d") * F.col("__d"))).alias("rms"), (F.countDistinct("__b") * 10).alias("arc"))


def accepted(method: Column, arc: Column, n: Column, rms: Column, resolve: Column) -> Column:
    """Gate on detections."""
    return ~F.coalesce(resolve, F.lit(False)) & ((method == "ring") | ((arc >= 100) & (n >= 60) & (rms <= 8)))


def robust_polynomial(t: np.ndarray, x: np.ndarray, degree: int, passes: int = 4) -> np.ndarray:
    """Polynomial fit, cut at 2.5 upper median residuals while enough points stay."""
    keep = np.arange(len(t))
    p = np.polyfit(t, x, degree)
    for _ in range(passes - 1):
        r = np.abs(x - np.polyval(p, t))
        cut = 2.5 * np.sort(r[keep])[len(keep) // 2]
        new = np.flatnonzero(r <= max(cut, 1e-12))
        if len(new) < max(degree + 2, 0.4 * len(t)) or len(new) == len(keep):
            break
        keep, p = new, np.polyfit(t[new], x[new], degree)
    return p


def fixed_radius_centre(points: np.ndarray, cx: float, cy: float, radius: float, rounds: int = 8) -> tuple[float, float]:
    """Centre of a circle of known radius, the tolerance closing from 40 to 14."""
    for k in range(rounds):
        d = points - (cx, cy)
        dist = np.hypot(d[:, 0], d[:, 1])
        near = np.abs(dist - radius) <= 40 + (14 - 40) * k / (rounds - 1)
        if near.sum() < 3:
            break
        u = d[near] / dist[near, None]
        step, *_ = np.linalg.lstsq(u, dist[near] - radius, rcond=None)
        cx, cy = cx + step[0], cy + step[1]
    return float(cx), float(cy)


def closest_approach(dx: Sequence[float], dy: Sequence[float]) -> float:
    """Time of least separation of a linear track."""
    a = dx[0] ** 2 + dy[0] ** 2
    return 0.0 if a == 0 else -(dx[0] * dx[1] + dy[0] * dy[1]) / a


def crossings(dx: Sequence[float], dy: Sequence[float], distance: float) -> tuple[float, float] | None:
    """The two times at which a linear track is at a distance, or None."""
    a, b = dx[0] ** 2 + dy[0] ** 2, 2 * (dx[0] * dx[1] + dy[0] * dy[1])
    c = dx[1] ** 2 + dy[1] ** 2 - distance**2
    d = b * b - 4 * a * c
    if a == 0 or d < 0:
        return None
    return (-b - math.sqrt(d)) / (2 * a), (-b + math.sqrt(d)) / (2 * a)


def contacts(dx: Sequence[float], dy: Sequence[float], r_sun: float, r_moon: float, t0: float = -math.inf, t1: float = math.inf) -> dict[str, float | None]:
    """c1..c4 within [t0, t1]: the outer ones at the sum of the radii; the inner ones, where the Moon is the larger, at their difference."""
    outer = crossings(dx, dy, r_sun + r_moon)
    inner = crossings(dx, dy, r_moon - r_sun) if r_moon > r_sun else None
    found = {"c1": outer and outer[0], "c2": inner and inner[0], "c3": inner and inner[1], "c4": outer and outer[1]}
    return {k: v if v is not None and t0 <= v <= t1 else None for k, v in found.items()}


def phase(t: Column, sep: Column, beads: Column, c: dict[str, float | None], r_sun: float, r_moon: float) -> Column:
    """Beads, then totality (between c2 and c3, or by the separation where these are not known), partial, before c1, or after c4."""
    out = F.when(beads, "baily's beads")
    if c["c2"] is not None and c["c3"] is not None:
        out = out.when((t >= c["c2"]) & (t <= c["c3"]), "totality")
    elif r_moon > r_sun:
        out = out.when(sep <= r_moon - r_sun, "totality")
    out = out.when(sep < r_sun + r_moon, "partial")
    return (out if c["c1"] is None else out.when(t < c["c1"], "before first contact")).otherwise("after fourth contact")


def radial_flatten(df: DataFrame, keys: Sequence[str], radius: Column, x: str) -> DataFrame:
    """Values over the mean of their integer radius, minus 1."""
    rows = df.withColumn("rad", F.floor(radius + 0.5))
    mean = rows.groupBy(*keys, "rad").agg(F.avg(x).alias("__mean"))
    return rows.join(mean, [*keys, "rad"]).withColumn("flat", F.col(x) / F.col("__mean") - 1).drop("__mean")
