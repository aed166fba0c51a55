"""Folders of FITS, TIFF and PNG files: headers, times, pixels, and files that are none."""

import datetime as dt
import os
import struct
import zlib

import numpy as np
import pytest

from chronoframe.functions import kernels
from chronoframe.sources import images


def fits(x, when=None):
    cards = ["SIMPLE  =                    T", f"BITPIX  = {16:>20}", f"NAXIS   = {3 if x.ndim == 3 else 2:>20}", f"NAXIS1  = {x.shape[-1]:>20}", f"NAXIS2  = {x.shape[-2]:>20}"]
    cards += [f"NAXIS3  = {x.shape[0]:>20}"] if x.ndim == 3 else []
    cards += [f"BZERO   = {32768:>20}", f"BSCALE  = {1:>20}"] + ([f"DATE-OBS= '{when}' / start"] if when else []) + ["END"]
    head = "".join(c.ljust(80) for c in cards).encode()
    body = (x.astype(np.int32) - 32768).astype(">i2").tobytes()
    return head.ljust(-(-len(head) // 2880) * 2880) + body.ljust(-(-len(body) // 2880) * 2880, b"\0")


def tiff(x, when=None, order="<", far=0, planar=1):
    """One strip; the directory stands behind the pixels, as writers like to do."""
    kind = x.dtype.itemsize * 8
    flat = x.reshape(x.shape[0], x.shape[1], -1)
    body = (np.moveaxis(flat, 2, 0) if planar == 2 else flat).astype(x.dtype.newbyteorder(order)).tobytes() + b"\0" * far
    at, text = 8, (when or "").encode() + b"\0"
    text_at = at + len(body)
    entries = [(256, 4, 1, x.shape[1]), (257, 4, 1, x.shape[0]), (258, 3, 1, kind), (259, 3, 1, 1), (273, 4, 1, at), (277, 3, 1, flat.shape[2]), (279, 4, 1, len(body) - far), (284, 3, 1, planar)]
    pack = lambda t, k, n, v: struct.pack(order + "HHI", t, k, n) + (struct.pack(order + "HH", v, 0) if k == 3 else struct.pack(order + "I", v))
    exif_at = text_at + len(text)
    exif = struct.pack(order + "H", 1) + pack(36867, 2, len(text), text_at) + struct.pack(order + "I", 0) if when else b""
    if when:
        entries.append((34665, 4, 1, exif_at))
    ifd_at = exif_at + len(exif)
    ifd = struct.pack(order + "H", len(entries)) + b"".join(pack(*e) for e in entries) + struct.pack(order + "I", 0)
    return (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, ifd_at) + body + text + exif + ifd


def png(x, kinds=(0, 1, 2, 3, 4)):
    """Rows filtered by each of the format's filters in turn."""
    step = x.dtype.itemsize * (x.shape[2] if x.ndim == 3 else 1)
    rows = x.astype(x.dtype.newbyteorder(">")).reshape(x.shape[0], -1).view(np.uint8).astype(int)
    out = b""
    for y, row in enumerate(rows):
        kind, up = kinds[y % len(kinds)], rows[y - 1] if y else np.zeros_like(row)
        left, corner = (np.concatenate((np.zeros(step, int), r[:-step])) for r in (row, up))
        p = left + up - corner
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        out += bytes([kind]) + ((row - [0, left, up, (left + up) // 2, paeth][kind]) % 256).astype(np.uint8).tobytes()
    part = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", x.shape[1], x.shape[0], 8 * x.dtype.itemsize, 2 if x.ndim == 3 else 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(out)) + part(b"IEND", b"")


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(1)
    grey, colour = rng.integers(0, 65536, (30, 40)).astype(np.uint16), rng.integers(0, 256, (12, 10, 3)).astype(np.uint8)
    cube = rng.integers(0, 65536, (3, 8, 9)).astype(np.uint16)
    made = {
        "a/f2.fits": (fits(grey, "2026-08-12T18:01:02.5"), grey[..., None]), "a/f10.fits": (fits(grey), grey[..., None]), "a/f1.fit": (fits(cube, "2026-08-12T18:01:01Z"), np.moveaxis(cube, 0, 2)),
        "b/x1.tif": (tiff(grey, "2026:08:12 18:00:00", far=300_000), grey[..., None]), "b/x2.tiff": (tiff(grey, "2026:08:12 18:00:01", ">"), grey[..., None]), "b/x3.tif": (tiff(colour, "2026:08:12 18:00:02", planar=2), colour),
        "c/p1.png": (png(grey), grey[..., None]), "c/p2.png": (png(colour), colour), "c/p3.png": (kernels.encode_png(colour), colour),
        "d/bad.png": (b"no picture", None), "d/short.fits": (fits(grey)[:3000], None), "d/short.tif": (tiff(grey)[:200], None),
    }
    for name, (raw, _) in made.items():
        os.makedirs(tmp_path / name.partition("/")[0], exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    (tmp_path / "a" / "notes.txt").write_text("none")
    (tmp_path / "d" / "empty.fits").write_bytes(b"")  # the engine lists no empty files
    return tmp_path, made


def test_headers_and_times(spark, folder):
    path, made = folder
    got = {f"{r['capture']}/{r['file']}": r for r in images.headers(spark, str(path)).collect()}
    assert set(got) == set(made)
    assert [got[f"a/{n}"]["i"] for n in ("f1.fit", "f2.fits", "f10.fits")] == [0, 1, 2]  # natural order
    assert (got["a/f2.fits"]["utc"], got["a/f2.fits"]["utc_from"]) == (dt.datetime(2026, 8, 12, 18, 1, 2, 500000), "fits") and got["a/f10.fits"]["utc_from"] == "file"
    assert got["b/x1.tif"]["utc"] == dt.datetime(2026, 8, 12, 18, 0, 0) and {got[f"b/{n}"]["utc_from"] for n in ("x1.tif", "x2.tiff", "x3.tif")} == {"exif"}
    for name, (_, x) in made.items():
        if x is not None:
            assert (got[name]["height"], got[name]["width"], got[name]["channels"], got[name]["depth"]) == (*x.shape, 8 * x.dtype.itemsize), name
    assert got["d/bad.png"]["format"] is None and got["d/bad.png"]["utc_from"] == "file"
    assert {r["capture"]: r["has_real_times"] for r in images.real_times(images.headers(spark, str(path))).collect()} == {"a": False, "b": True, "c": False, "d": False}


def test_pixels(spark, folder):
    path, made = folder
    got = {f"{r['capture']}/{r['file']}": r for r in images.frames(spark, str(path)).collect()}
    assert set(got) == set(made)
    for name, (_, x) in made.items():
        r = got[name]
        if x is None:
            assert r["payload"] is None, name
        else:
            y = np.frombuffer(r["payload"], "u1" if r["depth"] == 8 else "<u2").reshape(r["height"], r["width"], r["channels"])
            assert (y == x).all(), name


def test_listing_reads_no_content(spark, folder):
    listed = images._numbered(images.files(spark, str(folder[0])).drop("content"))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan and listed.count() == 12


def test_an_empty_folder_has_no_frames(spark, tmp_path):
    assert images.headers(spark, str(tmp_path)).count() == 0 and images.frames(spark, str(tmp_path)).count() == 0
