"""Scalar expressions on brightness, geometry and layout, all as engine columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOOR = 1 / 65535


def sample_step(n: Column, requested: int) -> Column:
    """Step of systematic sampling: at least 60 samples where there are so many frames."""
    per = F.floor(n / 60)
    return F.greatest(F.lit(1), F.least(F.lit(requested), F.when(per == 0, 1).otherwise(per))).cast("long")


def row_index(height: Column, rows: int) -> Column:
    """Evenly spaced row numbers of a frame."""
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.floor(r * height / rows).cast("long"))


def log2_floored(v: Column) -> Column:
    return F.log2(F.greatest(v, F.lit(FLOOR)))


def level(med: Column, black: Column) -> Column:
    return F.greatest(med - black, F.lit(FLOOR))


def shoulder_scale(knee: float, ceil: float, amplitude: float) -> float:
    """Scale s with knee + a log1p((1 - knee) / s) = ceil, by bisection."""
    lo, hi = 1e-9, 1e9
    for _ in range(120):
        mid = math.sqrt(lo * hi)
        if amplitude * math.log1p((1 - knee) / mid) > ceil - knee:
            lo = mid
        else:
            hi = mid
    return math.sqrt(lo * hi)


def apply_gain(v: Column, gain, pedestal, knee: float, amplitude: float, scale: float, ceil: float) -> Column:
    """Pedestal off, times gain, a logarithmic shoulder above the knee, clipped to [0, ceil]."""
    x = F.greatest((v - pedestal) * gain, F.lit(0.0))
    return F.least(F.when(x > knee, knee + amplitude * F.log1p((x - knee) / scale)).otherwise(x), F.lit(ceil))


def panel_gain(full: Column, gain: Column, strength: float) -> Column:
    return F.least(gain * F.pow(full / gain, F.lit(strength)), gain)


def ramp(v: Column, lo: float, hi: float) -> Column:
    """Smoothstep between lo and hi."""
    t = F.least(F.greatest((v - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))
    return t * t * (3 - 2 * t)


def asinh_scale(ref: Column, target: Column, beta: float) -> Column:
    """k with asinh(ref k beta) / asinh(beta) = target."""
    return F.sinh(target * math.asinh(beta)) / (ref * beta)


def overlap_area(r1: Column, r2: Column, d: Column) -> Column:
    """Area that two circles share."""
    clip = lambda c: F.least(F.greatest(c, F.lit(-1.0)), F.lit(1.0))
    small = F.least(r1, r2)
    a1 = F.acos(clip((d * d + r1 * r1 - r2 * r2) / (2 * d * r1)))
    a2 = F.acos(clip((d * d + r2 * r2 - r1 * r1) / (2 * d * r2)))
    kite = F.sqrt(F.greatest((-d + r1 + r2) * (d + r1 - r2) * (d - r1 + r2) * (d + r1 + r2), F.lit(0.0))) / 2
    return F.when(d >= r1 + r2, 0.0).when(d <= F.abs(r1 - r2), math.pi * small * small).otherwise(r1 * r1 * a1 + r2 * r2 * a2 - kite)


def lit_fraction(r_sun: Column, r_moon: Column, d: Column) -> Column:
    return 1 - overlap_area(r_sun, r_moon, d) / (math.pi * r_sun * r_sun)


def panel_scale(panel: Column, other: Column, drizzle: int) -> Column:
    return panel / (2.0 * drizzle * other)


def polynomial(coefficients: Column, t: Column) -> Column:
    """Value at t; highest power first."""
    return F.aggregate(coefficients, F.lit(0.0), lambda a, c: a * t + c)


def separation(dx: Column, dy: Column, t: Column) -> Column:
    x, y = polynomial(dx, t), polynomial(dy, t)
    return F.sqrt(x * x + y * y)


def drift_ceiling(r_moon: Column) -> Column:
    """Highest plausible drift in pixels a second: 1.4 x 0.51 arc seconds at a radius of 990 arc seconds."""
    return 1.4 * 0.51 * r_moon / 990


def round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def seconds_since(index: Column, fps: Column, start: Column, epoch: Column) -> Column:
    """Linear-rate time of a frame; null without an index or a known capture."""
    return (start - epoch) + index / fps


def natural_key(name: Column) -> Column:
    """Sort key: digit runs as numbers, the rest lower-cased."""
    return F.array_join(F.transform(F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1)), lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 20, "0")).otherwise(F.lower(p))), "\u0001")


def ticks_to_micros(ticks: Column) -> Column:
    """Microseconds of the epoch from 100 ns ticks since year 1."""
    return (F.floor(ticks / 10) - 62135596800000000).cast("long")
