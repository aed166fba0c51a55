"""Tracks, levels, rings and placement against plain computations, and on odd tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.operators import levels, placement, rings, stats, tracking

# ---------------------------------------------------------------- followed centres

CANDIDATES = "file string, i long, x double, y double, n int, arc int, score double"


def test_follow_takes_the_near_fit_and_searches_anew(spark):
    rows = [
        ("a", 0, 10.0, 10.0, 5, 5, 1.0), ("a", 0, 90.0, 90.0, 5, 5, 2.0),  # the first frame: the best score
        ("a", 1, 91.0, 90.0, 80, 150, 0.1), ("a", 1, 10.0, 10.0, 200, 300, 9.0),  # near and good enough
        ("a", 2, None, None, None, None, None),  # no fit: the centre holds
        ("a", 3, 92.0, 90.0, 80, 50, 0.1), ("a", 3, 12.0, 10.0, 80, 60, 9.0),  # thin: more arc elsewhere
        ("a", 4, 13.0, 10.0, 10, 50, 0.1), ("a", 4, 50.0, 10.0, 9, 40, 9.0),  # thin, but nothing better
        ("a", 5, 70.0, 70.0, 1, 1, 0.5),  # none near
        ("b", 0, 1.0, 1.0, 1, 1, 0.5), ("b", 1, 2.0, 1.0, None, None, 0.5), ("b", 1, 0.0, 1.0, None, None, 0.5),  # a tie: the smaller x
        (None, 7, 3.0, 3.0, 1, 1, 1.0),
    ]
    got = {(r["file"], r["i"]): (r["x"], r["y"], r["method"]) for r in tracking.follow(spark.createDataFrame(rows, CANDIDATES).withColumn("k", F.lit(1)), ["file"], "i", 20.0).collect()}
    assert got == {
        ("a", 0): (90.0, 90.0, "best"), ("a", 1): (91.0, 90.0, "near"), ("a", 2): (None, None, "none"), ("a", 3): (12.0, 10.0, "best"), ("a", 4): (13.0, 10.0, "near"),
        ("a", 5): (70.0, 70.0, "best"), ("b", 0): (1.0, 1.0, "best"), ("b", 1): (0.0, 1.0, "near"), (None, 7): (3.0, 3.0, "best"),
    }
    assert tracking.follow(spark.createDataFrame([], CANDIDATES), ["file"], "i", 20.0).count() == 0


def test_follow_one_long_file(spark):
    """200,000 frames of one key; the state goes on over Arrow batches."""
    frames = spark.range(200_000).select(F.lit("f").alias("file"), F.col("id").alias("i"), (F.col("id") * 3.0).alias("x"), F.lit(0.0).alias("y"), F.lit(100).alias("n"), F.lit(200).alias("arc"), F.lit(1.0).alias("score"))
    decoys = frames.withColumns({"x": F.col("x") + 50.0, "score": F.lit(2.0)}).where("i > 0")
    got = tracking.follow(frames.unionByName(decoys), ["file"], "i", 5.0).agg(F.count("*").alias("n"), F.sum((F.col("x") == F.col("i") * 3.0).cast("int")).alias("right")).first()
    assert (got["n"], got["right"]) == (200_000, 200_000)


def test_first_radius(spark):
    fits = spark.createDataFrame([("b", 0, 5.0, 200, 6.0), ("a", 1, 279.0, 100, 281.0), ("a", 2, 280.0, 300, 1.0), ("a", 0, None, 300, 1.0)], "file string, i int, r double, arc int, searched double")
    assert tracking.first_radius(fits, ["file", "i"], "r", "arc", "searched").first()["radius"] == 281.0
    assert tracking.first_radius(fits.where("i = 2"), ["file", "i"], "r", "arc", "searched").first()["radius"] == 280.0
    assert tracking.first_radius(fits.where("i = 9"), ["file", "i"], "r", "arc", "searched").first()["radius"] is None


# ---------------------------------------------------------------- local polynomials


def plain_track(t, x, degree):
    """Point by point, with numpy's own fit."""
    n = len(x)
    if n < degree + 2:
        return None
    d = sorted(abs(x[i - 1] - 2 * x[i] + x[i + 1]) for i in range(1, n - 1))
    tolerance = max(2.5 * (d[len(d) // 2] / 0.6745 / math.sqrt(6) if d else 0.0), 1e-4)
    least = min(n, max(degree + 2, 9))
    widths, w = [], n
    while w > least:
        widths.append(w)
        w = max(least, w // 2)
    out = []
    for i in range(n):
        for w in [*widths, least]:
            lo = max(0, min(i - w // 2, n - w))
            keep = np.arange(lo, lo + w)
            for _ in range(4):
                c = np.polyfit(t[keep], x[keep], degree)
                r = np.abs(x[keep] - np.polyval(c, t[keep]))
                new = keep[r <= max(2.5 * np.sort(r)[len(r) // 2], 1e-4)]
                if len(new) < max(degree + 2, 0.4 * len(keep)):
                    break
                keep = new
            q = max(1, w // 4)
            mid = np.arange(max(lo, i - q), min(lo + w, i + q + 1))
            r = np.sort(np.abs(x[mid] - np.polyval(c, t[mid])))
            if r[len(r) // 2] <= tolerance or w == least:
                out.append((float(np.polyval(c, t[i])), w))
                break
    return out


@pytest.mark.parametrize("n", [1, 3, 4, 5, 9, 10, 37, 120])
def test_smooth_track_point_by_point(n):
    rng = np.random.default_rng(n)
    t = np.cumsum(rng.uniform(0.5, 1.5, n))
    x = 2.6 * np.arctan((t - t.mean()) / 6) + rng.normal(0, 0.01, n)
    x[rng.random(n) < 0.05] += 3
    got, want = tracking.smooth_track(t - t.mean(), x, 2), plain_track(t - t.mean(), x, 2)
    assert (got is None) == (want is None)
    if want:
        assert got[1].tolist() == [w for _, w in want]
        assert np.allclose(got[0], [v for v, _ in want], atol=1e-7)


def test_parabolic_motion_keeps_the_whole_window_and_a_sweep_is_followed():
    rng = np.random.default_rng(7)
    i = np.arange(400.0)
    parabola = 1e-6 * (i - 200) ** 2 + 0.002 * (i - 200) + 0.3
    fitted, width = tracking.smooth_track(i - i.mean(), parabola + rng.normal(0, 0.01, 400), 2)
    assert set(width.tolist()) == {400} and np.degrees(np.abs(fitted - parabola).max()) < 0.5
    sweep = 2.6 * np.arctan((i - 200) / 45)
    fitted, width = tracking.smooth_track(i - i.mean(), sweep + rng.normal(0, 0.01, 400), 2)
    assert width.min() < 400 and np.degrees(np.abs(fitted - sweep).max()) < 2.0


def turns(a, b):
    return abs(math.degrees(math.atan2(math.sin(a - b), math.cos(a - b))))


def test_cusps_of_a_whole_eclipse_follow_the_sweep(spark):
    """Both cusps of one capture over a whole eclipse: slow, a fast swing through maximum, slow again; angles come wrapped."""
    rng = np.random.default_rng(12)
    t = np.arange(560.0)
    truth = {"upper": 2.6 * np.arctan((t - 390) / 40) + 1.0, "lower": 0.9 * np.arctan((t - 380) / 60) - 2.0}
    wrapped = {k: np.mod(v + rng.normal(0, 0.01, len(t)) + math.pi, 2 * math.pi) - math.pi for k, v in truth.items()}
    rows = [("c", float(x), float(wrapped["upper"][i]), float(wrapped["lower"][i])) for i, x in enumerate(t)]
    got = tracking.cusp_track(spark.createDataFrame(rows, "capture string, t double, upper double, lower double"), ["capture"], "t", ["upper", "lower"]).collect()
    far = {k: [turns(r["fitted"], truth[k][int(r["t"])]) for r in got if r["cusp"] == k] for k in truth}
    raw = {k: [turns(wrapped[k][i], truth[k][i]) for i in range(len(t))] for k in truth}
    for k in truth:
        assert np.median(far[k]) < np.median(raw[k]) + 0.5 and np.percentile(far[k], 90) < np.percentile(raw[k], 90) + 1.5
        single = np.polyval(np.polyfit(t, truth[k], 2), t)
        assert np.degrees(np.abs(single - truth[k])).max() > 4 * max(far[k])  # one parabola would not do
    widths = [r["width"] for r in got]
    assert min(widths) < 80 and max(widths) > 4 * min(widths)


def test_local_polynomials_on_odd_tables(spark):
    rows = [("a", 1.0, 0.5), ("a", None, 0.5), ("a", 2.0, None), (None, 1.0, 1.0), *[("b", float(i // 2), 3.0) for i in range(20)], *[("c", 1.0, float(i)) for i in range(12)]]
    got = tracking.local_polynomials(spark.createDataFrame(rows, "k string, t double, x double").withColumn("width", F.lit("z")), ["k"], "t", "x").collect()
    assert sum(r["k"] == "a" for r in got) == 1 and all(r["fitted"] is None for r in got if r["k"] in ("a", None))
    assert all(abs(r["fitted"] - 3.0) < 1e-9 for r in got if r["k"] == "b") and sum(r["k"] == "c" for r in got) == 12
    assert tracking.local_polynomials(spark.createDataFrame([], "k string, t double, x double"), ["k"], "t", "x").count() == 0


def test_unwrapped_angles():
    x = np.array([3.0, -3.0, -2.9, 3.1, 0.0, 0.0])
    got = tracking.unwrapped(x)
    assert np.abs(np.diff(got)).max() <= math.pi and all(turns(a, b) < 1e-9 for a, b in zip(x, got, strict=True))
    assert len(tracking.unwrapped(np.zeros(0))) == 0


# ---------------------------------------------------------------- discs and tracks


def test_fixed_radius_fits_find_centres(spark):
    rng = random.Random(3)
    rows, seeds = [], []
    for k in range(12):
        cx, cy = rng.uniform(100, 200), rng.uniform(100, 200)
        arc = [rng.uniform(0, 2) for _ in range(80)]
        rows += [(k, cx + 60 * math.cos(a) + rng.gauss(0, 0.3), cy + 60 * math.sin(a) + rng.gauss(0, 0.3)) for a in arc] + [(k, cx + 140, cy), (k, cx, cy)]
        seeds.append((k, cx + rng.uniform(-15, 15), cy + rng.uniform(-15, 15), cx, cy))
    seeds += [(50, 1.0, 2.0, 1.0, 2.0), (51, 5.0, 5.0, 5.0, 5.0)]
    rows += [(51, 65.0, 5.0), (51, 66.0, 5.0)]  # two points settle nothing
    table = spark.createDataFrame(seeds, "k int, cx double, cy double, tx double, ty double")
    got = {r["k"]: r for r in tracking.fixed_radius_fits(spark.createDataFrame(rows, "k int, x double, y double"), ["k"], "x", "y", table, 60.0).collect()}
    assert len(got) == 14
    for k, _, _, tx, ty in seeds:
        assert math.hypot(got[k]["cx"] - tx, got[k]["cy"] - ty) < (0.5 if k < 50 else 1e-9)
    assert got[50]["n"] == 0


def test_linear_track_is_validated(spark):
    rows = [(float(t), 0.5 * t - 50 + 1e-9 * t, 3.0) for t in range(0, 200, 10)]
    track = tracking.linear_track(spark.createDataFrame(rows, "t double, x double, y double"), "t", "x", "y")
    told = tracking.validated_track(track, 5.0, F.lit(16.0)).first()  # within 5 for 2 * 4 / 0.5 = 16
    assert abs(told["predicted"] - 16) < 1e-3 and told["valid"]
    assert not tracking.validated_track(track, 5.0, F.lit(30.0)).first()["valid"] and not tracking.validated_track(track, 1.0, F.lit(16.0)).first()["valid"]
    few = tracking.linear_track(spark.createDataFrame(rows[:2], "t double, x double, y double"), "t", "x", "y").first()
    assert few["ax"] is None and few["n"] == 2


# ---------------------------------------------------------------- ranks, levels


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "few", "empty"])
def test_selected_ranks_are_exact(spark, kind):
    rng = np.random.default_rng(5)
    values = {"normal": rng.normal(0, 1, 30000), "ties": rng.integers(0, 4, 20000).astype(float), "heavy": np.exp(rng.normal(0, 8, 20000)), "few": np.array([3.0, 1.0, 2.0]), "empty": np.zeros(0)}[kind]
    rows = [(i % 3 if i % 7 else None, float(v)) for i, v in enumerate(values)] + [(1, None), (9, None)]
    df = spark.createDataFrame(rows, "k int, x double").withColumn("__at", F.lit(1))
    quantiles = {"lo": 0.0, "black": 0.05, "med": 0.5, "p999": 0.999, "hi": 1.0}
    for keys in (["k"], []):
        got = {tuple(r[k] for k in keys): [r[q] for q in quantiles] for r in stats.selected(df, keys, "x", quantiles).collect()}
        groups = {}
        for k, v in rows:
            if v is not None and (k is not None or not keys):
                groups.setdefault((k,) if keys else (), []).append(v)
        want = {k: [sorted(v)[min(len(v) - 1, int(len(v) * q))] for q in quantiles.values()] for k, v in groups.items()}
        assert {k: v for k, v in got.items() if v[0] is not None and k != (None,)} == want


def test_affine_fit_of_levels(spark):
    rng = np.random.default_rng(8)
    rows = []
    for level, n in ((1, 3000), (2, 3000), (3, 3000), (4, 50)):
        base = rng.uniform(0.02, 0.3, n)
        for p, v in enumerate(base if level == 1 else rows_of(rows, 1)[:n]):
            x = float(v) * 1.5 ** (level - 1) + 0.01 * (level - 1)
            rows.append((level, p, x + (0.2 if level > 1 and p % 50 == 0 else 0.0)))
    df = spark.createDataFrame(rows, "level int, p int, value double")
    pairs = levels.neighbours(df, "level", "value", ["p"])
    got = {r["level"]: r for r in levels.fit_affine(pairs, ["level"], "short", "long").collect()}
    assert set(got) == {2, 3, 4} and abs(got[2]["a"] - 1.5) < 0.02 and abs(got[2]["b"] - 0.01) < 0.005
    assert got[4]["a"] == 0.0 and 0 < got[4]["n"] <= 50  # too few pixels
    chain = {r["level"]: r["scale"] for r in levels.level_chain(levels.fit_affine(pairs, ["level"], "short", "long"), "level").collect()}
    assert abs(chain[3] - 2.25) < 0.1 and chain[4] == 0.0
    assert levels.fit_affine(pairs.where("level = 9"), ["level"], "short", "long").count() == 0


def rows_of(rows, level):
    return [r[2] for r in rows if r[0] == level]


def test_reference_level(spark):
    segs = spark.createDataFrame([("a", None), ("b", 3), ("c", 2), ("d", 2), ("e", 0)], "name string, level int")
    made = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",)], "name string")
    got = {r["name"]: r["reference"] for r in levels.with_artefacts(segs, made, ["name"], "level").collect()}
    assert got == {"a": False, "b": False, "c": True, "d": False}
    assert [r["reference"] for r in levels.with_artefacts(segs.where("name = 'a'"), made, ["name"], "level").collect()] == [True]


def test_radial_profile_within_a_bin_of_sorted_medians(spark):
    rng = np.random.default_rng(2)
    yy, xx = np.mgrid[0:90, 0:120]
    r = np.hypot(xx - 60, yy - 45)
    value = np.exp(-r / 20) * rng.uniform(0.8, 1.2, r.shape)
    value[0, 0] = 0.0
    rows = [(1, float(x), float(y), float(v)) for x, y, v in zip(xx.ravel(), yy.ravel(), value.ravel(), strict=True)]
    px = spark.createDataFrame(rows, "image int, x double, y double, value double")
    sketch = levels.radial_sketch(px, ["image"], F.hypot(F.col("x") - 60, F.col("y") - 45), F.col("value"), F.lit(75))
    assert sketch.agg(F.sum("n")).first()[0] == len(rows)
    for row in levels.radial_medians(sketch, ["image"]).collect():
        own = np.sort(value[np.floor(r + 0.5) == row["r"]])
        assert row["n"] == len(own)
        if len(own) > 3:
            median = own[max(0, len(own) // 2 - 1)]
            told = 2 ** (-20 + row["bin"] / 2047 * 22)
            assert abs(math.log2(told / median)) <= 2.5 * 22 / 2047
    shape = spark.createDataFrame([(1, 60.0, 45.0, 120.0, 90.0, 10.0), (2, 1.0, 1.0, 4.0, 4.0, 1.0)], "image int, cx double, cy double, width double, height double, limb double")
    flat = levels.flatten(px.withColumn("r", F.lit("mine")).drop("r"), shape, ["image"], "x", "y", "value", least=20)
    assert flat.count() == len(rows)
    ring = {k: np.median([x["flat"] for x in flat.where(F.hypot(F.col("x") - 60, F.col("y") - 45).between(k, k + 1)).collect()]) for k in (15, 35)}
    raw = {k: np.median(value[(r >= k) & (r <= k + 1)]) for k in (15, 35)}
    assert abs(math.log(ring[15] / ring[35]) - 0.45 * math.log(raw[15] / raw[35])) < 0.15  # a share of the gradient is put back


# ---------------------------------------------------------------- rings, windows


def plain_run(lit):
    n = len(lit)
    best = None
    for s in range(n):
        if lit[s] and (all(lit) or not lit[s - 1]):
            k = 1
            while k < n and lit[(s + k) % n]:
                k += 1
            if best is None or k > best[1]:
                best = (s, k)
    return best


def test_ring_runs_across_zero(spark):
    rng = random.Random(1)
    rings_ = {k: [rng.random() < 0.6 for _ in range(24)] for k in range(40)} | {100: [True] * 24, 101: [False] * 24, 102: [True] * 5 + [False] * 14 + [True] * 5, 103: [True] + [False] * 23}
    rows = [(k, b, 10.0 if x else 2.0) for k, r in rings_.items() for b, x in enumerate(r)]
    df = spark.createDataFrame(rows, "k int, b int, v double")
    runs = rings.longest_ring_run(df.unionByName(df), ["k"], "b", 24, F.col("v") > 5)
    got = {r["k"]: (r["start"], r["length"]) for r in runs.collect()}
    assert got == {k: w for k, r in rings_.items() if (w := plain_run(r))}
    edges = {r["k"]: r for r in rings.ring_edges(df, runs, ["k"], "b", "v", 24, F.lit(6.0)).collect()}
    turn = 2 * math.pi / 24
    assert abs(edges[102]["first"] - 18.5 * turn) < 1e-9 and abs(edges[102]["last"] - 4.5 * turn) < 1e-9 and abs(edges[102]["middle"] - 23.5 * turn) < 1e-9
    assert edges[100]["first"] is None and edges[100]["length"] == 24


def test_output_window_shrinks_as_far_as_needed(spark):
    rng = random.Random(9)
    rows = [(k, rng.uniform(0, 600), rng.uniform(0, 400)) for k in range(6) for _ in range(50 * (k + 1))] + [(7, 300.0, 200.0), (8, 1.0, 1.0), (9, None, 1.0)]
    got = {r["k"]: (r["window_w"], r["window_h"], r["padded"]) for r in placement.output_window(spark.createDataFrame(rows, "k int, x double, y double"), ["k"], "x", "y", 600.0, 400.0, 50.0, most=0.7).collect()}
    want = {}
    for k in (*range(6), 7, 8):
        own = [(x, y) for j, x, y in rows if j == k]
        share = lambda w, h: sum(x - w / 2 < 0 or x + w / 2 > 600 or y - h / 2 < 0 or y + h / 2 > 400 for x, y in own) / len(own)  # noqa: B023, E731
        w = round(2 * 2.2 * 50 / 20) * 20
        h = round(w / (4 / 3) / 20) * 20
        while w > 2 * 1.6 * 50 and share(w, h) > 0.7:
            w -= 20
            h = round(w / (4 / 3) / 20) * 20
        want[k] = (w, h, share(w, h))
    assert got == want


def test_shared_drift_without_groups_is_zero(spark):
    rows = [(1, float(i), 1.0 * i, 2.0) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, t double, x double, y double")
    assert tuple(placement.shared_drift(df, ["k"], "t", "x", "y", F.lit(True), F.lit(True)).first()) == (0.0, 0.0, 0)
    long = df.unionByName(spark.createDataFrame([(k, 10.0 * i, k * 0.1 * 10 * i, -0.5 * 10 * i) for k in (2, 3, 4) for i in range(30)], df.schema))
    got = placement.shared_drift(long, ["k"], "t", "x", "y", F.lit(True), F.lit(True)).first()
    assert abs(got["drift_x"] - 0.3) < 1e-9 and abs(got["drift_y"] + 0.5) < 1e-9 and got["groups"] == 3


def test_totality_placement_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, file int, i int, t double, lx double, ly double, rx double, ry double, dx double, dy double, level string")
    assert placement.place_totality(df, ["k"], "file", "i", "t", ["lx", "ly"], ["rx", "ry"], ["dx", "dy"], "level", F.lit(False), [F.lit(0.0), F.lit(0.0)]).count() == 0


# ---------------------------------------------------------------- whole segmentation


@pytest.mark.parametrize("every", [4, 20, 63])
def test_capture_segments_find_edges_to_the_frame(spark, every):
    """Boundaries at 12, 52, 92 and 132, found from samples that lie far apart."""
    from chronoframe.operators import sequences

    levels_ = [(12, 0.02), (52, 0.3), (92, 0.04), (132, 0.6), (264, 0.02)]
    frames = [("a", i, next(v for end, v in levels_ if i < end)) for i in range(264)] + [("b", i, 0.1) for i in range(50)] + [("c", i, 0.1 * (i + 1)) for i in range(2)]
    f = spark.createDataFrame(frames, "name string, i long, med double")
    points = f.where((F.col("i") % every == 0) | F.col("i").isin(263, 49, 1)).withColumn("p99", F.col("med") * 2)
    totals = f.groupBy("name").agg(F.count("*").alias("total"))
    got = {}
    for r in sequences.capture_segments(points, f, totals, "name", "i", "med", ["med", "p99"]).collect():
        got.setdefault(r["name"], []).append((r["start"], r["count"], round(r["med"], 6), round(r["p99"], 6)))
    assert sorted(got["b"]) == [(0, 50, 0.1, 0.2)] and len(got["c"]) == 1
    if every <= 20:
        ends = [0, *(e for e, _ in levels_)]
        assert sorted(got["a"]) == [(s, e - s, v, 2 * v) for s, e, (_, v) in zip(ends, ends[1:], levels_, strict=False)]
    else:
        assert sum(c for _, c, _, _ in got["a"]) == 264


def test_classify_brackets_totality(spark):
    from chronoframe.operators import sequences

    segs = spark.createDataFrame([("a", 0, "stable", 0.1), ("a", 9, "blown", 0.9), ("b", 0, "stable", 0.01), ("b", 5, "transition", 0.02), ("b", 9, "stable", 0.04), ("c", 0, "stable", 0.2), ("c", 3, "blown", 0.8), ("d", 0, "stable", 0.1)], "name string, start int, kind string, med double")
    got = {(r["name"], r["start"]): (r["state"], r["level_name"]) for r in sequences.classify(segs, ["name", "start"]).collect()}
    assert got == {("a", 0): ("filtered", None), ("a", 9): ("unfiltered", None), ("b", 0): ("unfiltered", "short"), ("b", 5): ("unfiltered", None), ("b", 9): ("unfiltered", "mid"), ("c", 0): ("unfiltered", "long"), ("c", 3): ("unfiltered", None), ("d", 0): ("filtered", None)}
    assert {r["state"] for r in sequences.classify(segs.where("kind <> 'blown'"), ["name", "start"]).collect()} == {"filtered"}


def test_gains_of_zero_do_not_end_a_query(spark):
    from chronoframe.operators import chapters, sequences

    rows = spark.createDataFrame([("a", 0, "f", 0, 0.0, True), ("a", 1, "f", 1, 1.0, False), ("a", 2, "f", 2, None, False), ("a", 3, "f", 3, 2.0, False)], "k string, seq int, file string, index int, gain double, flag boolean")
    cuts = {r["seq"]: r["cut"] for r in sequences.discontinuities(rows, ["k"], "seq", 40, 1.35, 3).collect()}
    assert cuts == {0: False, 1: False, 2: False, 3: True}
    assert chapters.sample_frames(rows, ["k"], "seq", ["k"], "file", "index", "gain", ["flag"]).count() > 0
    segs = spark.createDataFrame([("a", 0, "stable", 1.0, 0.0, 0.0, 5), ("a", 5, "transition", 1.0, 0.0, 0.0, 2), ("a", 7, "stable", 1.0, 0.5, 0.3, 3)], "k string, start int, kind string, chain double, p99 double, entry double, n int")
    assert placement.totality_gains(segs, ["k"], "start", "kind", "chain", "p99", "entry", F.lit(True), 0.7, 1.0).count() == 3
    assert all(math.isfinite(r["gain"]) for r in sequences.gain_chain(segs, ["k"], "start", "entry", "p99", "n").collect())
