"""Frame tables to measurements: a kernel a row, in Arrow batches, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from .fits import loose


def pixels(payload: bytes, height: int, width: int, depth: int) -> np.ndarray:
    return np.frombuffer(payload, np.uint8 if depth <= 8 else "<u2").reshape(height, width)


def light_curve(frames: DataFrame) -> DataFrame:
    """Robust brightness of every frame (or of the rows that were read): black, med, p99, p999, max, lit, satfrac."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for f in b.itertuples():
                v = np.sort(pixels(f.payload, f.height, f.width, f.depth).ravel()).astype(np.float64)
                full, n = float((1 << f.depth) - 1), len(v)
                pick = lambda q, v=v, n=n: v[min(n - 1, int(n * q))]
                black = pick(0.05)
                floor = black + max(full / 2048, black / 8)
                rows.append((f.file, f.i, f.utc, black / full, pick(0.5) / full, pick(0.99) / full, pick(0.999) / full, v[-1] / full, float((v > floor).mean()), float((v >= full * 63 / 64).mean())))
            yield pd.DataFrame(rows, columns=["file", "i", "utc", "black", "med", "p99", "p999", "max", "lit", "satfrac"])

    return frames.mapInPandas(run, "file string, i int, utc timestamp_ntz, black double, med double, p99 double, p999 double, max double, lit double, satfrac double")


def sample(frames: DataFrame, counts: DataFrame, step: int) -> DataFrame:
    """Every step-th frame and the last of each file."""
    return frames.join(F.broadcast(counts), "file").where((F.col("i") % step == 0) | (F.col("i") == F.col("frames") - 1)).drop("frames")


def detect_discs(frames: DataFrame, share: float = 1e-4) -> DataFrame:
    """Largest bright component of each frame that is round enough and off the border: centre, radius, area, count."""

    def run(batches):
        for b in batches:
            rows = []
            for f in b.itertuples():
                x = pixels(f.payload, f.height, f.width, f.depth)
                found = kernels.blobs(x > (float(x.min()) + float(x.max())) / 2)
                good = [d for d in found if d["area"] >= share * x.size and d["x0"] > 0 and d["y0"] > 0 and d["x1"] < f.width and d["y1"] < f.height and 0.35 <= d["area"] / ((d["x1"] - d["x0"]) * (d["y1"] - d["y0"])) <= 1]
                if good:
                    d = good[0]
                    rows.append((f.file, f.i, (d["x0"] + d["x1"] - 1) / 2, (d["y0"] + d["y1"] - 1) / 2, float(np.sqrt(d["area"] / np.pi)), d["area"], len(found)))
            yield pd.DataFrame(rows, columns=["file", "i", "cx", "cy", "r", "area", "blobs"])

    return frames.mapInPandas(run, "file string, i int, cx double, cy double, r double, area long, blobs int")


def track(frames: DataFrame) -> DataFrame:
    """Shift of each frame against the middle frame of its file, by phase correlation, and whether it is plausible."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        images = [pixels(f.payload, f.height, f.width, f.depth).astype(np.float64) for f in pdf.itertuples()]
        ref = images[len(images) // 2]
        shifts = [kernels.phase_shift(ref, x) for x in images]
        out = pd.DataFrame({"file": pdf["file"].to_numpy(), "i": pdf["i"].to_numpy(), "dx": [s[0] for s in shifts], "dy": [s[1] for s in shifts]})
        return out.assign(ok=(out.dx.abs() <= 80) & (out.dy.abs() <= 80))

    return frames.groupBy("file").applyInPandas(run, "file string, i int, dx double, dy double, ok boolean")


def encode_manifest(frames: DataFrame, fps: int, out: str) -> DataFrame:
    """Commands that would encode the runs of rendered frames; the encoder is outside this library."""
    spans = frames.agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    return spans.select(F.format_string("ffmpeg -framerate %d -start_number %d -i seq_%%05d.png -frames:v %d " + out, F.lit(fps), F.col("first"), F.col("n")).alias("command"), "first", "n")


def assemble(pixels_: DataFrame, keys: Sequence[str], x: str, y: str, value: Column, width: int, height: int) -> DataFrame:
    """(keys, __width, __height, __image): an image a row, 64-bit floats row by row, from a table of pixels.

    A place with several samples has the largest, one without any 0; samples beyond the frame, or without a value, are left out. Samples
    are reduced to places before an image's places meet: width times height numbers at most.
    """
    inside = F.col(x).between(0, width - 1) & F.col(y).between(0, height - 1) & value.isNotNull()
    place = (F.floor(y).cast("int") * width + F.floor(x).cast("int")).alias("__at")
    places = pixels_.where(inside).groupBy(*keys, place).agg(F.max(value.cast("double")).alias("__v"))
    images = places.groupBy(*keys).agg(F.collect_list("__at").alias("__at"), F.collect_list("__v").alias("__v"))

    def run(batches):
        for batch in batches:
            data = []
            for at, v in zip(batch.column("__at"), batch.column("__v"), strict=True):
                flat = np.zeros(width * height)
                flat[at.values.to_numpy()] = v.values.to_numpy()
                data.append(flat.tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([loose(batch.column("k")), pa.array(np.full(n, width, np.int32)), pa.array(np.full(n, height, np.int32)), pa.array(data, pa.binary())], names=["k", "__width", "__height", "__image"])

    packed = images.select(F.struct(*keys).alias("k"), "__at", "__v")
    return packed.mapInArrow(run, f"k {dict(packed.dtypes)['k']}, __width int, __height int, __image binary").select("k.*", "__width", "__height", "__image")


def _images(batch: pa.RecordBatch):
    for w, h, raw in zip(batch.column("__width").to_pylist(), batch.column("__height").to_pylist(), batch.column("__image"), strict=True):
        yield np.frombuffer(raw.as_buffer(), np.float64).reshape(h, w)


def planes(images: DataFrame, keys: Sequence[str], kernel: Callable[[np.ndarray], dict[str, np.ndarray]]) -> DataFrame:
    """(keys, plane, x, y, value): the pixels of the planes that a kernel makes of each image. An image at a time, no shuffle."""
    source = images.select(F.struct(*keys).alias("k"), "__width", "__height", "__image")

    def run(batches):
        for batch in batches:
            k = loose(batch.column("k"))
            for row, image in enumerate(_images(batch)):
                for name, plane in kernel(image).items():
                    y, x = (c.ravel().astype(np.int32) for c in np.indices(plane.shape))
                    n = len(x)
                    yield pa.RecordBatch.from_arrays([k.take(pa.array(np.full(n, row))), pa.array([name] * n), pa.array(x), pa.array(y), pa.array(plane.ravel().astype(np.float64))], names=["k", "plane", "x", "y", "value"])

    return source.mapInArrow(run, f"k {dict(source.dtypes)['k']}, plane string, x int, y int, value double").select("k.*", "plane", "x", "y", "value")


def measures(images: DataFrame, keys: Sequence[str], names: Sequence[str], kernel: Callable[[np.ndarray], Sequence[float]]) -> DataFrame:
    """(keys, names): the numbers that a kernel measures on each image. An image at a time, no shuffle."""
    source = images.select(F.struct(*keys).alias("k"), "__width", "__height", "__image")

    def run(batches):
        for batch in batches:
            told = [kernel(image) for image in _images(batch)]
            yield pa.RecordBatch.from_arrays([loose(batch.column("k")), *(pa.array([float(t[j]) for t in told], pa.float64()) for j in range(len(names)))], names=["k", *names])

    return source.mapInArrow(run, f"k {dict(source.dtypes)['k']}, " + ", ".join(f"`{n}` double" for n in names)).select("k.*", *names)
