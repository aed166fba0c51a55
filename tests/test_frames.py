"""Sources, kernels, settings and streaming."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.functions import kernels as k
from chronoframe.operators import fits, frames
from chronoframe.params import Params
from chronoframe.plans import capture
from chronoframe.sources import ser
from chronoframe.streaming.sessions import sessions


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("ser")
    rng = np.random.default_rng(7)
    y, x = np.indices((48, 64))
    for n in (2, 10):
        stack = []
        for i in range(40):
            level = 4000 if i < 15 else 20000 if i < 30 else 1000
            disc = ((x - 30 - i % 3) ** 2 + (y - 22) ** 2 <= 144) * level
            stack.append(disc + rng.integers(0, 30, x.shape) + 100)
        ser.write(str(d / f"cap{n}.ser"), np.array(stack).astype(np.uint16), 8, [ser.EPOCH_TICKS + 10_000_000 * i for i in range(40)])
    return str(d)


def test_ser_round_trip_and_rows(spark, folder):
    assert [p[-8:] for p in ser.discover(folder)] == ["cap2.ser", "ap10.ser"]
    rows = ser.read(spark, folder, chunkbytes="30000").orderBy("file", "i").collect()
    assert len(rows) == 80 and rows[41]["utc"].isoformat() == "1970-01-01T00:00:01"
    full = frames.pixels(bytes(rows[3]["payload"]), 48, 64, 16)
    some = ser.read(spark, folder, rows="6").where("file = 'cap10.ser' and i = 3").collect()[0]
    assert some["height"] == 6 and (frames.pixels(bytes(some["payload"]), 6, 64, 16) == full[[0, 8, 16, 24, 32, 40]]).all()
    assert ser.read(spark, folder, stride="10").count() == 8


def test_ser_cut_short_and_sliced(spark, folder, tmp_path):
    raw = open(f"{folder}/cap2.ser", "rb").read()
    (tmp_path / "short.ser").write_bytes(raw[: ser.HEADER + 48 * 64 * 2 * 7 + 100])
    assert ser.info(str(tmp_path / "short.ser")).usable == 7
    assert ser.slice_file(f"{folder}/cap2.ser", str(tmp_path / "slice.ser"), 35, 20) == 5
    got = ser.read(spark, str(tmp_path / "slice.ser")).orderBy("i").collect()
    assert len(got) == 5 and got[0]["utc"].second == 35
    (tmp_path / "bad.ser").write_bytes(b"no")
    with pytest.raises(ValueError):
        ser.info(str(tmp_path / "bad.ser"))
    assert "5 frames" in ser.describe(str(tmp_path / "slice.ser"))


def test_light_curve_and_segments(spark, folder):
    curve = capture.light_curve(spark, folder, 48)
    got = {(r["file"], r["i"]): r for r in curve.collect()}
    raw = ser.read(spark, folder).where("file = 'cap2.ser' and i = 20").collect()[0]
    v = np.sort(np.frombuffer(bytes(raw["payload"]), "<u2"))
    assert got["cap2.ser", 20]["p99"] == v[int(len(v) * 0.99)] / 65535 and got["cap2.ser", 20]["max"] == v[-1] / 65535
    segs = capture.segments(curve.withColumn("med", F.col("p99")), 3).where("file = 'cap2.ser'").orderBy("start").collect()
    assert [(s["start"], s["count"]) for s in segs] == [(0, 15), (15, 15), (30, 10)]


def test_discs_and_tracking(spark, folder):
    f = ser.read(spark, folder).where("i < 12")
    discs = {(r["file"], r["i"]): r for r in frames.detect_discs(f).collect()}
    assert len(discs) == 24 and all(abs(d["cx"] - 30 - i % 3) < 0.6 and abs(d["r"] - 12) < 0.6 for (_, i), d in discs.items())
    shifts = {(r["file"], r["i"]): r for r in frames.track(f).collect()}
    assert all(abs((s["dx"] - shifts[n, 0]["dx"]) - i % 3) < 0.4 and s["ok"] for (n, i), s in shifts.items())


def test_demosaic():
    flat = np.zeros((16, 16), np.uint16)
    for cid, (red, blue) in k.BAYER.items():
        flat[:] = 50
        flat[red[0] :: 2, red[1] :: 2], flat[blue[0] :: 2, blue[1] :: 2] = 80, 20
        assert np.allclose([p.mean() for p in k.superpixel(flat, cid, 100)], [0.8, 0.5, 0.2])
        assert np.allclose(k.bilinear(flat, cid, 100)[1:-1, 1:-1], [0.8, 0.5, 0.2]) and np.allclose(k.green(flat, cid, 100), 0.5)
    noise = np.random.default_rng(1).integers(0, 65536, (32, 32)).astype(np.uint16)
    out = k.bilinear(noise, 8, 65535)
    assert (out[::2, ::2, 0] == noise[::2, ::2].astype(np.float32) / np.float32(65535)).all()
    # Beyond an edge stands its value: green at the red corner has two neighbours and, twice, the corner itself.
    corner = (2 * float(noise[0, 0]) + float(noise[0, 1]) + float(noise[1, 0])) / 4 / 65535
    assert abs(out[0, 0, 1] - corner) < 1e-6 and abs(out[0, 5, 2] - (float(noise[0, 5]) + float(noise[1, 5])) / 2 / 65535) < 1e-6
    for bad in (0, 100):
        with pytest.raises(ValueError):
            k.superpixel(flat, bad, 1)
    with pytest.raises(ValueError):
        k.superpixel(flat[:15], 8, 1)


def test_shifts():
    rng = np.random.default_rng(3)
    x = k.box_blur(rng.normal(size=(128, 128)), 2)
    moved = k.translate(x, 3.5, -2.25)
    dx, dy = k.phase_shift(x, moved)
    assert abs(dx - 3.5) < 0.6 and abs(dy + 2.25) < 0.6
    mx, my, score = k.match_shift(moved, x)
    assert abs(mx - 3.5) < 0.3 and abs(my + 2.25) < 0.3 and score > 0.8
    assert np.allclose(k.crop(x, 10.5, 20, 8, 8), (x[20:28, 10:18] + x[20:28, 11:19]) / 2)
    back = k.drizzle([x, moved], [(0, 0), (3.5, -2.25)], 1)
    assert np.corrcoef(back[8:-8, 8:-8].ravel(), x[8:-8, 8:-8].ravel())[0, 1] > 0.97


def test_blobs_rings_and_peaks():
    y, x = np.indices((90, 110))
    disc = ((x - 50.3) ** 2 + (y - 41.7) ** 2 <= 20**2).astype(float)
    two = k.blobs((disc > 0) | ((x == 100) & (y > 80)) | ((x == 101) & (y == 80)))
    assert [b["area"] for b in two] == [int(disc.sum()), 10]
    cx, cy, _ = k.ring_search(k.box_blur(disc, 1), 20, (53, 45))
    assert abs(cx - 50.3) < 0.7 and abs(cy - 41.7) < 0.7
    fx, fy = fits.fixed_radius_centre(k.limb_points(disc, 0.5), 55, 38, 20)
    assert abs(fx - 50.3) < 0.7 and abs(fy - 41.7) < 0.7
    sky = np.random.default_rng(0).normal(size=(60, 60))
    sky[10, 10], sky[12, 10], sky[40, 50] = 40, 39, 20
    assert [p[:2] for p in k.suppressed_peaks(sky, np.ones_like(sky, bool), 6, 5, 8)] == [(10, 10), (50, 40)]
    assert abs(k.centroid(disc)[0] - 50.3) < 2 and k.annulus_median(disc, 50.3, 41.7, 5, 15) == 1.0
    assert np.allclose(k.radial_profile(disc, 50, 42)[0][:15], 1) and abs(k.radial_power(sky).sum() - 1) < 1e-9
    assert k.complete_png(k.encode_png((disc * 255).astype(np.uint8))) and not k.complete_png(k.encode_png(disc.astype(np.uint16))[:-5])
    p = fits.robust_polynomial(np.arange(50.0), np.where(np.arange(50) % 9 == 0, 99.0, np.arange(50.0) ** 2), 2)
    assert np.allclose(p, [1, 0, 0], atol=1e-6)


def test_contacts():
    c = fits.contacts([0.1, -100.0], [0.0, 2.0], 279, 292)
    assert abs(0.5 * (c["c1"] + c["c4"]) - 1000) < 1e-9 and c["c1"] < c["c2"] < c["c3"] < c["c4"]
    assert fits.contacts([0.1, -100.0], [0.0, 100.0], 279, 292)["c2"] is None and fits.closest_approach([0.1, -100.0], [0.0, 2.0]) == pytest.approx(1000)


def test_params(tmp_path):
    (tmp_path / "a.toml").write_text("[find]\nreach_r = 0.5\narea_r2 = 0.1\n")
    p = Params.load({"find": {"reach_r": 1.0, "n": 3}}, str(tmp_path / "a.toml"), {"find": {"n": 4}}, radius=200.0)
    assert p.px("find.reach_r") == 100 and p.px("find.area_r2") == pytest.approx(4000) and p["find.n"] == 4 and "find.x" not in p
    with pytest.raises(SystemExit):
        Params(p.values).px("find.reach_r")


def test_streaming_sessions(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:20"), (1, "2024-01-01 00:05:00"), (2, "2024-01-01 00:00:10"), (9, "2024-01-01 09:00:00")]
    spark.createDataFrame(rows, "k int, t string").select("k", F.col("t").cast("timestamp").alias("t")).write.parquet(str(tmp_path / "in"))
    q = sessions(spark.readStream.schema("k int, t timestamp").parquet(str(tmp_path / "in")), "k", "t", "1 minute", "10 minutes")
    run = q.writeStream.format("memory").queryName("s").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert sorted((r["k"], r["n"]) for r in spark.table("s").collect()) == [(1, 1), (1, 2), (2, 1)]
