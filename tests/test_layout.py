"""Panel layout against every assignment written out, and its edge cases."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.operators import layout, tracking


def plain_cost(places, slots, chosen, disc, want, costs):
    """The cost of one assignment, term by term."""
    cx, cy, r = disc
    total = 0.0
    for (x, y), k, w in zip(places, chosen, want, strict=True):
        a, b = slots["x"][k] - x, slots["y"][k] - y
        size = a * a + b * b
        t = 0.0 if size == 0 else min(1.0, max(0.0, ((cx - x) * a + (cy - y) * b) / size))
        total += math.sqrt(size) - costs.clearance * slots["clear"][k]
        total += costs.crossing if math.dist((x + t * a, y + t * b), (cx, cy)) < r else 0
        total += costs.moved if w >= 0 and w != k else 0
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) > 0
    at = [(slots["x"][k], slots["y"][k]) for k in chosen]
    for i, j in itertools.combinations(range(len(places)), 2):
        p, q, s, u = places[i], at[i], places[j], at[j]
        total += costs.crossing if turn(s, u, p) != turn(s, u, q) and turn(p, q, s) != turn(p, q, u) else 0
    a = sorted(slots["angle"][k] for k in chosen)
    gap = min([b - c for b, c in itertools.pairwise(reversed(a))] + [a[0] + 2 * math.pi - a[-1]]) if len(a) > 1 else math.pi
    return round(total - costs.spread * gap, 6)


@pytest.mark.parametrize("n, m", [(1, 8), (3, 8), (5, 7), (6, 6), (4, 8)])
def test_cheapest_is_the_least_of_all(n, m):
    rng, costs = random.Random(n * 10 + m), layout.Costs()
    for _ in range(3):
        angle = sorted(rng.uniform(-3.1, 3.1) for _ in range(m))
        slots = {"angle": np.array(angle), "x": np.array([200 + 250 * math.cos(a) for a in angle]), "y": np.array([150 + 190 * math.sin(a) for a in angle]), "clear": np.array([rng.uniform(0, 80) for _ in range(m)]), "slot": np.arange(m)}
        places = [(rng.uniform(50, 350), rng.uniform(30, 270)) for _ in range(n)]
        want = [rng.choice([-1, rng.randrange(m)]) for _ in range(n)]
        x, y = (np.array([p[k] for p in places]) for k in (0, 1))
        got = layout.cheapest(x, y, slots, (200.0, 150.0, 80.0), want, costs)
        every = {c: plain_cost(places, slots, c, (200.0, 150.0, 80.0), want, costs) for c in itertools.permutations(range(m), n)}
        assert len(set(got.tolist())) == n
        assert math.isclose(every[tuple(got.tolist())], min(every.values()), abs_tol=2e-6)


def test_ties_take_the_first_assignment():
    slots = {"angle": np.array([-2.0, 0.0, 2.0]), "x": np.array([0.0, 0.0, 0.0]), "y": np.array([0.0, 0.0, 0.0]), "clear": np.zeros(3), "slot": np.arange(3)}
    got = layout.cheapest(np.array([10.0]), np.array([10.0]), slots, (500.0, 500.0, 1.0), [-1])
    assert got.tolist() == [0]


def test_clear_slots_keep_room_or_the_roomiest(spark):
    frames = spark.createDataFrame([(1, 100.0), (2, 20.0), (None, 60.0)], "id int, r double")
    got = {r["id"]: r for r in layout.clear_slots(frames, ["id"], F.lit(400), F.lit(300), F.col("r"), 60.0, 8.0, floor=4).collect()}
    assert len(got[2]["slots"]) == 8 and set(got) == {1, 2, None}
    assert sorted(s["slot"] for s in got[1]["slots"]) == [0, 1, 2, 3, 4, 5]
    for r in got.values():
        assert [s["angle"] for s in r["slots"]] == sorted(s["angle"] for s in r["slots"])
    tight = layout.clear_slots(frames.where("id = 1"), ["id"], F.lit(400), F.lit(300), F.lit(180.0), 60.0, 8.0, floor=4).first()
    assert sorted(s["slot"] for s in tight["slots"]) == [0, 1, 2, 3]


def test_on_limb_keeps_other_labels_and_null_places(spark):
    rows = [("prominence", 0.0, 0.0), ("prominence", 150.0, 0.0), ("sunspot", 0.0, 0.0), (None, 0.0, 0.0), ("lunar limb", None, 0.0)]
    df = spark.createDataFrame(rows, "label string, x double, y double")
    got = df.where(layout.on_limb(F.col("label"), F.col("x"), F.col("y"), F.lit(50.0), F.lit(0.0), F.lit(100.0))).collect()
    assert [(r["label"], r["x"]) for r in got] == [("prominence", 150.0), ("sunspot", 0.0), (None, 0.0), ("lunar limb", None)]


SCHEMA = "capture int, clip int, name int, label string, x double, y double, slot string"


def _assigned(spark, rows, radius=60.0):
    df = spark.createDataFrame(rows, SCHEMA)
    disc = layout.clear_slots(df.select("capture").distinct(), ["capture"], F.lit(400), F.lit(300), F.lit(radius), 60.0, 8.0)
    return {(r["capture"], r["clip"], r["name"]): (r["slot"], r["moved"]) for r in layout.assign_slots(df, disc, ["capture"], "clip", "name", "label", "x", "y").collect()}


def test_a_held_slot_is_kept_from_clip_to_clip(spark):
    rows = [(1, 0, 0, "p", 30.0, 20.0, ""), (1, 1, 0, "p", 30.0, 150.0, ""), (1, 2, 0, "q", 30.0, 280.0, ""), (None, 0, 0, None, 30.0, 20.0, "")]
    got = _assigned(spark, rows)
    assert got[1, 0, 0] == (0, False) and got[1, 1, 0] == (0, False)
    assert got[1, 2, 0] == (1, False)  # another label, nothing to keep
    assert got[None, 0, 0] == (0, False)


def test_rows_without_a_place_or_beyond_the_slots_have_no_slot(spark):
    rows = [(1, 0, k, "p", 20.0 + 40 * k, 20.0, "") for k in range(10)] + [(1, 1, 0, "p", None, 1.0, ""), (1, 1, 1, "p", float("nan"), 1.0, "")]
    got = _assigned(spark, rows, 20.0)
    assert len(got) == 12 and sorted(got[1, 0, k][0] for k in range(8)) == list(range(8))
    assert got[1, 0, 8] == got[1, 0, 9] == got[1, 1, 0] == got[1, 1, 1] == (None, None)
    assert _assigned(spark, []) == {}


def test_many_clips_of_one_key_stream_in_order(spark):
    df = spark.range(30000).select(F.lit(1).alias("capture"), F.col("id").alias("clip"), F.lit(0).alias("name"), F.lit("p").alias("label"), (200 + 150 * F.cos(F.col("id") / 400)).alias("x"), (150 + 110 * F.sin(F.col("id") / 400)).alias("y"))
    disc = layout.clear_slots(df.select("capture").distinct(), ["capture"], F.lit(400), F.lit(300), F.lit(60.0), 60.0, 8.0)
    got = layout.assign_slots(df, disc, ["capture"], "clip", "name", "label", "x", "y").agg(F.count("slot").alias("n"), F.sum(F.col("moved").cast("int")).alias("moved"), F.countDistinct("slot").alias("slots")).first()
    assert got["n"] == 30000 and got["slots"] > 1 and got["moved"] <= 2  # moved only where the held slot's leader would cross the disc


def test_bead_runs_fit_each_run_as_polyfit_does(spark):
    rng = np.random.default_rng(5)
    rows = []
    for capture, (start, n) in enumerate([(0, 40), (10, 24), (5, 25), (3, 2), (7, 1)]):
        at = start + np.cumsum(rng.integers(1, 4, n))
        rows += [(capture, int(i), float(3 + 0.5 * i + 0.01 * i * i + rng.normal()), float(9 - i + rng.normal()), float(rng.uniform(20, 80)), bool(i == at[0])) for i in at]
    rows += [(0, 500, 1.0, 1.0, 10.0, False), (0, 501, None, 1.0, 10.0, True), (0, 502, 1.0, 1.0, 10.0, None)]
    got = tracking.bead_runs(spark.createDataFrame(rows, "capture int, i int, x double, y double, e double, near boolean"), ["capture"], "i", "x", "y", "e", F.col("near")).collect()
    assert {(r["capture"], r["i"]) for r in got} == {(r[0], r[1]) for r in rows if r[1] < 500}  # the run at 500 touches no contact
    for capture in range(5):
        of = [r for r in rows if r[0] == capture and r[1] < 500]
        t = np.array([r[1] for r in of], float)
        for k, name in ((2, "x"), (3, "y")):
            v = np.array([r[k] for r in of])
            want = np.full(1, v[0]) if len(of) == 1 else np.polyval(np.polyfit(t - t.mean(), v, 2 if len(of) >= 25 else 1), t - t.mean())
            mine = [r[name] for r in sorted(got, key=lambda r: r["i"]) if r["capture"] == capture]
            assert np.allclose(mine, want, atol=1e-6)
        e = sorted(r[4] for r in of)
        assert {r["half"] for r in got if r["capture"] == capture} == {min(max(1.35 * e[len(e) // 2], 45.0), 80.0)}


def test_cusp_boxes_need_ten_openings(spark):
    rows = [(1, 30.0)] * 9 + [(2, 33.0)] * 10 + [(3, 100.0)] * 25 + [(1, None)] * 5
    got = {r["c"]: (r["n"], r["degree"], round(r["half"], 6)) for r in tracking.cusp_boxes(spark.createDataFrame(rows, "c int, o double"), ["c"], "o").collect()}
    assert got == {2: (10, 1, 42.9), 3: (25, 2, 46.0)}
