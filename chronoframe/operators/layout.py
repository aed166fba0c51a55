"""Where a clip's panels go: slots that leave the disc clear, features on the limb, and the cheapest assignment of features to slots."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache, lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fits import loose

# A slot's place as shares of the frame's width and height, by number.
SLOTS = ((0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.5), (1.0, 0.5), (0.5, 0.0), (0.5, 1.0))
# The features that belong on the limb, and how far off it (in radii) they may lie.
LIMB_FEATURES = ("prominence", "baily's beads", "lunar limb", "upper cusp", "lower cusp")
LIMB_BAND = 0.35


@dataclass(frozen=True)
class Costs:
    """Fixed values, in pixels but for ``spread``, which is a pixel count per radian."""

    crossing: float = 10000.0  # a leader over the disc, or two leaders that cross
    clearance: float = 2.0  # gained for each pixel between slot and limb
    moved: float = 2000.0  # for not keeping the slot of the clip before
    most_extra: float = 250.0  # a kept slot may be farther than the nearest by this
    spread: float = 500.0  # gained for each radian of the smallest gap between slots


def on_limb(label: Column, x: Column, y: Column, cx: Column, cy: Column, radius: Column) -> Column:
    """False for a limb feature off the limb by more than the band; true for all other features. Null places are kept."""
    off = F.abs(F.hypot(x - cx, y - cy) / radius - 1) > LIMB_BAND
    return ~F.coalesce(label.isin(*LIMB_FEATURES) & off, F.lit(False))


def clear_slots(frames: DataFrame, keys: Sequence[str], width: Column, height: Column, radius: Column, panel: float, margin: float, least: float = 0.15, floor: int = 6) -> DataFrame:
    """A row per row of ``frames``: keys, cx, cy, radius, slots; at most eight slots, in their order around the disc.

    A slot stays if its panel is at least ``least`` radii away from the limb. If fewer than ``floor`` do, the ``floor`` with
    the most room stay (ties: smaller number). A slot has slot, x, y, angle and clear (pixels between panel and limb).
    """
    w, h, r = width.cast("double"), height.cast("double"), radius.cast("double")

    def slot(k: int, fx: float, fy: float) -> Column:
        gap = [F.greatest(F.abs((size - panel - 2 * margin) * (share - 0.5)) - panel / 2, F.lit(0.0)) for size, share in ((w, fx), (h, fy))]
        return F.struct(F.atan2(h * (fy - 0.5), w * (fx - 0.5)).alias("angle"), F.lit(k).alias("slot"), (w * fx).alias("x"), (h * fy).alias("y"), (F.hypot(*gap) - r).alias("clear"))

    every = F.array(*(slot(k, *place) for k, place in enumerate(SLOTS)))
    roomy = F.filter("every", lambda s: s["clear"] >= least * F.col("radius"))
    by_room = F.sort_array(F.transform("every", lambda s: F.struct((-s["clear"]).alias("tight"), s["slot"].alias("k"), s.alias("s"))))
    most = F.transform(F.slice(by_room, 1, min(8, max(1, floor))), lambda s: s["s"])
    told = frames.select(*keys, (w / 2).alias("cx"), (h / 2).alias("cy"), r.alias("radius"), every.alias("every"))
    return told.select(*keys, "cx", "cy", "radius", F.sort_array(F.when(F.size(roomy) < min(8, max(1, floor)), most).otherwise(roomy)).alias("slots"))


@cache
def _orders(slots: int, features: int) -> np.ndarray:
    return np.array(list(permutations(range(slots), features)), np.int8)


def _side(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


@lru_cache(64)
def _smallest_gaps(angles: tuple[float, ...]) -> np.ndarray:
    """The smallest gap between the slots of each set, by the set's bits; angles ascend."""
    angle = np.array(angles)
    out = np.full(1 << len(angle), math.pi)
    for bits in range(len(out)):
        a = angle[[k for k in range(len(angle)) if bits >> k & 1]]
        if len(a) > 1:
            out[bits] = min(np.diff(a).min(), a[0] + 2 * math.pi - a[-1])
    return out


def cheapest(x: np.ndarray, y: np.ndarray, slots: dict[str, np.ndarray], disc: tuple[float, float, float], want: Sequence[int], costs: Costs = Costs()) -> np.ndarray:
    """The slot (place in ``slots``) of each feature: the cheapest of all assignments without a shared slot, first in order on ties.

    Costs are compared at six decimals. Every assignment is weighed, at most 8! of them: all at once, from tables by feature
    and slot and by pairs of both.
    """
    n, m = len(x), len(slots["x"])
    cx, cy, r = disc
    dx, dy = slots["x"][None] - x[:, None], slots["y"][None] - y[:, None]
    length = dx * dx + dy * dy
    t = np.clip(((cx - x[:, None]) * dx + (cy - y[:, None]) * dy) / np.where(length == 0, 1, length), 0, 1)
    over = np.hypot(x[:, None] + t * dx - cx, y[:, None] + t * dy - cy) < r
    single = np.sqrt(length) + costs.crossing * over - costs.clearance * slots["clear"][None]
    for i, k in enumerate(want):
        if k >= 0:
            single[i, np.arange(m) != k] += costs.moved
    orders = _orders(m, n)
    total = sum(single[i, orders[:, i]] for i in range(n))
    sx, sy = slots["x"], slots["y"]
    for a in range(n):
        for b in range(a + 1, n):
            s, q = (sx[:, None], sy[:, None]), (sx[None], sy[None])  # a's slot by rows, b's by columns
            first = (_side(x[b], y[b], *q, x[a], y[a]) > 0) != (_side(x[b], y[b], *q, *s) > 0)
            second = (_side(x[a], y[a], *s, x[b], y[b]) > 0) != (_side(x[a], y[a], *s, *q) > 0)
            total = total + costs.crossing * (first & second)[orders[:, a], orders[:, b]]
    bits = (1 << orders.astype(np.int64)).sum(axis=1)
    total = total - costs.spread * _smallest_gaps(tuple(slots["angle"].tolist()))[bits]
    return orders[np.round(total, 6).argmin()]


def _wanted(feature: tuple, before: list[tuple], slots: dict[str, np.ndarray], costs: Costs) -> int:
    """The place of the slot that the nearest feature of the label held in the clip before; -1 if there is none worth keeping."""
    label, x, y = feature
    same = [p for p in before if p[0] == label]
    if not same:
        return -1
    held = min(same, key=lambda p: math.hypot(x - p[1], y - p[2]))[3]
    at = np.flatnonzero(slots["slot"] == held)
    far = np.hypot(slots["x"] - x, slots["y"] - y)
    return int(at[0]) if len(at) and far[at[0]] - far.min() <= costs.most_extra else -1


def assign_slots(features: DataFrame, slots: DataFrame, keys: Sequence[str], clip: str, name: str, label: str, x: str, y: str, costs: Costs = Costs()) -> DataFrame:
    """(keys, clip, name, slot, moved): each feature's panel slot; clips of a key in order, each keeps what it can of the one before.

    ``slots`` is ``clear_slots`` by the same keys, one row a key. A clip's features take slots in order of ``name``; ``moved``
    is true where a slot worth keeping was not kept. Features without a place, of a key without slots, or beyond the number
    of slots, have a null slot, and the clip after does not see them. A null label is a label of its own.

    A key's clips stream through one task in their order; it holds one clip's features and the slots of the clip before.
    """
    kinds = dict(features.dtypes)
    rows = features.select(F.struct(*keys).alias("k"), F.col(clip).alias("clip"), F.col(name).alias("name"), F.col(label).alias("label"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    by_key = slots.select(F.struct(*keys).alias("of"), "cx", "cy", "radius", "slots")
    dealt = rows.join(by_key, F.col("k").eqNullSafe(F.col("of")), "left").drop("of").repartition("k").sortWithinPartitions("k", "clip", "name", "label", "x", "y")

    def run(batches):
        now, key, held, place, before = None, None, [], None, []

        def settle():
            nonlocal before
            if place is None or not held:
                before = []
                return [(*now, *f[:1], None, None) for f in held]
            disc, table = place
            want = [_wanted(f[1:], before, table, costs) for f in held]
            told = cheapest(np.array([f[2] for f in held]), np.array([f[3] for f in held]), table, disc, want, costs)
            before = [(*f[1:], int(table["slot"][k])) for f, k in zip(held, told, strict=True)]
            return [(*now, f[0], int(table["slot"][k]), w >= 0 and w != k) for f, k, w in zip(held, told, want, strict=True)]

        kind = []

        def packed(out):
            c = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c[0], kind[0]), pa.array(c[1], kind[1]), pa.array(c[2], kind[2]), pa.array(c[3], pa.int32()), pa.array(c[4], pa.bool_())], names=["k", "clip", "name", "slot", "moved"])

        for batch in batches:
            kind[:] = [loose(batch.column(0)).type, batch.schema.field(1).type, batch.schema.field(2).type]
            out = []
            for k, c, n, lab, fx, fy, cx, cy, r, table in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if (k, c) != now:
                    out += settle() if now is not None else []
                    if now is None or k != key:
                        before, key = [], k
                        place = ((cx, cy, r), {f: np.array([s[f] for s in table]) for f in ("slot", "x", "y", "angle", "clear")}) if table and None not in (cx, cy, r) else None
                    now, held = (k, c), []
                known = fx is not None and fy is not None and math.isfinite(fx) and math.isfinite(fy)
                if place is not None and known and len(held) < len(place[1]["slot"]):
                    held.append((n, lab, fx, fy))
                else:
                    out.append((k, c, n, None, None))
            if out:
                yield packed(out)
        if now is not None and (out := settle()):
            yield packed(out)

    schema = f"k {dict(rows.dtypes)['k']}, clip {kinds[clip]}, name {kinds[name]}, slot int, moved boolean"
    return dealt.mapInArrow(run, schema).select("k.*", F.col("clip").alias(clip), F.col("name").alias(name), "slot", "moved")
