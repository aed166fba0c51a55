"""Folders of images as frame tables: FITS, TIFF and PNG, read through the engine's own file layer.

``binaryFile`` lists and opens files wherever the cluster's file systems reach. The times, names and sizes of files need no
content. For ``headers`` only the first and last ``ENDS`` bytes of a file go to the parser; its pixels stay where they are. ``frames``
decodes pixels. A folder below the given one is a capture; its files in natural order are frames.

Defined results: a file that is none of these formats, is cut short, or uses what is not decoded here (compressed TIFF, interlaced
or palette PNG) has nulls for what it does not tell, and no payload; its row stays. Files without a byte have no row. A time without a zone is UTC.
"""

from __future__ import annotations

import datetime as dt
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import natural_key

PATTERN = "*.{fits,fit,fts,tif,tiff,png,FITS,FIT,FTS,TIF,TIFF,PNG}"
#: Bytes of a file's beginning and of its end that its header is read from.
ENDS = 1 << 16
#: Fixed by the formats: TIFF tags, and the bytes of their value types.
TAGS = {256: "width", 257: "height", 258: "bits", 259: "compression", 273: "strips", 277: "channels", 279: "strip_bytes", 284: "planar", 306: "changed", 34665: "exif", 36867: "taken"}
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 7: 1, 9: 4, 10: 8}
FITS_BLOCK, FITS_CARD = 2880, 80
PNG_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


class Ends:
    """A file of which the beginning and the end are at hand."""

    def __init__(self, head: bytes, tail: bytes, size: int):
        self.head, self.tail, self.size = head, tail, size

    def at(self, place: int, n: int) -> bytes:
        if 0 <= place and place + n <= len(self.head):
            return self.head[place : place + n]
        off = place - (self.size - len(self.tail))
        if off < 0 or place + n > self.size:
            raise ValueError("not at hand")
        return self.tail[off : off + n]


def _time(text: str) -> dt.datetime | None:
    text = text.strip().strip("\x00").strip()
    if len(text) >= 19 and text[4] == ":":
        text = text[:10].replace(":", "-") + text[10:]
    try:
        told = dt.datetime.fromisoformat(text.replace("Z", ""))
    except ValueError:
        return None
    return told if told.tzinfo is None else told.astimezone(dt.UTC).replace(tzinfo=None)


def _tiff(file: Ends, base: int = 0) -> dict:
    order = {b"II": "<", b"MM": ">"}[file.at(base, 2)]
    number = lambda place, kind: struct.unpack(order + kind, file.at(base + place, struct.calcsize(kind)))[0]
    found: dict = {}
    todo, seen = [number(4, "I")], set()
    while todo:
        place = todo.pop()
        if place in seen or not place:
            continue
        seen.add(place)
        for k in range(number(place, "H")):
            entry = place + 2 + 12 * k
            tag, kind, n = number(entry, "H"), number(entry + 2, "H"), number(entry + 4, "I")
            if tag not in TAGS or kind not in TYPE_BYTES or n > 1 << 20:
                continue
            size = TYPE_BYTES[kind] * n
            where = entry + 8 if size <= 4 else number(entry + 8, "I")
            if kind == 2:
                found[TAGS[tag]] = file.at(base + where, n).decode("ascii", "replace")
            else:
                code = {1: "B", 3: "H", 4: "I", 7: "B"}.get(kind)
                if code:
                    found[TAGS[tag]] = list(struct.unpack(f"{order}{n}{code}", file.at(base + where, size)))
        if "exif" in found:
            todo += found.pop("exif")
    return {"order": order} | found


def _fits(file: Ends) -> dict:
    cards: dict = {}
    place = 0
    while True:
        block = file.at(place, FITS_BLOCK).decode("ascii", "replace")
        place += FITS_BLOCK
        for i in range(0, FITS_BLOCK, FITS_CARD):
            card = block[i : i + FITS_CARD]
            if card[:8].strip() == "END":
                return cards | {"data_at": place}
            if card[8:10] == "= ":
                value = card[10:].strip()
                cards[card[:8].strip()] = value[1:].partition("'")[0].strip() if value.startswith("'") else value.partition("/")[0].strip()


def header(file: Ends) -> dict:
    """format, width, height, channels, depth, taken, taken_from: what the header tells."""
    try:
        if file.head[:8] == b"\x89PNG\r\n\x1a\n":
            width, height, depth, colour, _, _, _ = struct.unpack(">IIBBBBB", file.at(16, 13))
            out = {"format": "png", "width": width, "height": height, "channels": PNG_CHANNELS.get(colour), "depth": depth}
            place = 8
            while place + 12 <= file.size:
                n, kind = struct.unpack(">I4s", file.at(place, 8))
                if kind == b"eXIf":
                    told = _tiff(file, place + 8)
                    return out | _taken(told.get("taken") or told.get("changed"), "exif")
                if kind == b"IDAT":
                    break
                place += 12 + n
            return out
        if file.head[:9] == b"SIMPLE  =":
            c = _fits(file)
            axes = int(c.get("NAXIS", 0))
            return {"format": "fits", "width": int(c["NAXIS1"]), "height": int(c["NAXIS2"]), "channels": int(c["NAXIS3"]) if axes > 2 else 1, "depth": abs(int(c["BITPIX"]))} | _taken(c.get("DATE-OBS"), "fits")
        if file.head[:4] in (b"II*\x00", b"MM\x00*"):
            t = _tiff(file)
            return {"format": "tiff", "width": t["width"][0], "height": t["height"][0], "channels": t.get("channels", [1])[0], "depth": t.get("bits", [1])[0]} | _taken(t.get("taken") or t.get("changed"), "exif")
    except (ValueError, KeyError, struct.error, IndexError):
        pass
    return {}


def _taken(text: str | None, source: str) -> dict:
    when = _time(text) if text else None
    return {"taken": when, "taken_from": source} if when else {}


def _unfiltered(raw: bytes, height: int, row: int, step: int) -> np.ndarray:
    """PNG rows without their filters."""
    data = np.frombuffer(raw, np.uint8)[: height * (row + 1)].reshape(height, row + 1)
    out = np.zeros((height, row), np.uint8)
    for y in range(height):
        kind, line, above = data[y, 0], data[y, 1:], out[y - 1] if y else np.zeros(row, np.uint8)
        if kind == 0:
            out[y] = line
        elif kind == 1:
            out[y] = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint64).astype(np.uint8).reshape(-1)
        elif kind == 2:
            out[y] = line + above
        else:
            for i in range(row):
                a, b, c = int(out[y, i - step]) if i >= step else 0, int(above[i]), int(above[i - step]) if i >= step else 0
                if kind == 3:
                    near = (a + b) // 2
                else:
                    p = a + b - c
                    near = min((a, b, c), key=lambda v: abs(p - v))  # noqa: B023  the first of equals, as the format says
                out[y, i] = (int(line[i]) + near) & 255
    return out


def decode(content: bytes) -> np.ndarray | None:
    """Samples as rows, columns, channels; None where they are not told, or coded otherwise."""
    file = Ends(content, b"", len(content))
    told = header(file)
    if not told:
        return None
    try:
        w, h, ch, depth = (told[k] for k in ("width", "height", "channels", "depth"))
        if told["format"] == "png":
            if depth not in (8, 16) or ch is None or content[28]:
                return None
            place, parts = 8, []
            while place + 12 <= len(content):
                n, kind = struct.unpack(">I4s", content[place : place + 8])
                if kind == b"IDAT":
                    parts.append(content[place + 8 : place + 8 + n])
                place += 12 + n
            step = ch * depth // 8
            rows = _unfiltered(zlib.decompress(b"".join(parts)), h, w * step, step)
            return (rows if depth == 8 else rows.view(">u2")).reshape(h, w, ch)
        if told["format"] == "fits":
            c = _fits(file)
            kind = {8: ">u1", 16: ">i2", 32: ">i4", -32: ">f4", -64: ">f8"}[int(c["BITPIX"])]
            x = np.frombuffer(content, kind, w * h * ch, c["data_at"]).reshape(ch, h, w)
            zero, scale = float(c.get("BZERO", 0)), float(c.get("BSCALE", 1))
            x = x if (zero, scale) == (0.0, 1.0) else (x.astype(np.int64) + 32768).astype(np.uint16) if (zero, scale, kind) == (32768.0, 1.0, ">i2") else x * scale + zero
            return np.moveaxis(x, 0, 2)
        t = _tiff(file)
        if t.get("compression", [1])[0] != 1 or depth not in (8, 16):
            return None
        raw = b"".join(content[a : a + n] for a, n in zip(t["strips"], t["strip_bytes"], strict=True))
        x = np.frombuffer(raw, "u1" if depth == 8 else t["order"] + "u2", w * h * ch)
        return np.moveaxis(x.reshape(ch, h, w), 0, 2) if t.get("planar", [1])[0] == 2 else x.reshape(h, w, ch)
    except (ValueError, KeyError, struct.error, zlib.error, IndexError):
        return None


def files(spark: SparkSession, folder: str) -> DataFrame:
    """path, capture, file, modified, length, content: content is read only where it is asked for."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", PATTERN).option("recursiveFileLookup", "true").load(folder)
    parts = F.split("path", "/")
    return found.select("path", F.element_at(parts, -2).alias("capture"), F.element_at(parts, -1).alias("file"), F.col("modificationTime").cast("timestamp_ntz").alias("modified"), "length", "content")


def _numbered(df: DataFrame, key: Callable[[Column], Column] = natural_key) -> DataFrame:
    return df.withColumn("i", (F.row_number().over(Window.partitionBy("capture").orderBy(key(F.col("file")), "path")) - 1).cast("int"))


_HEADER = {"format": (pa.string(), "string"), "width": (pa.int32(), "int"), "height": (pa.int32(), "int"), "channels": (pa.int32(), "int"), "depth": (pa.int32(), "int"), "taken": (pa.timestamp("us"), "timestamp_ntz"), "taken_from": (pa.string(), "string")}


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """capture, i, file, path, length, format, width, height, channels, depth, utc, utc_from.

    ``utc`` is the time of the picture's EXIF data, else FITS' DATE-OBS, else the file's; ``utc_from`` says which: exif, fits or file.
    """
    f = files(spark, folder)
    ends = f.select("path", "length", F.substring("content", 1, ENDS).alias("head"), F.expr(f"substring(content, -{ENDS}, {ENDS})").alias("tail"))

    def run(batches):
        for batch in batches:
            told = [header(Ends(h, t, n)) for h, t, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([t.get(c) for t in told], kind) for c, (kind, _) in _HEADER.items())], names=["path", *_HEADER])

    read = ends.mapInArrow(run, "path string, " + ", ".join(f"{c} {kind}" for c, (_, kind) in _HEADER.items()))
    # the listing, with times and numbers, reads no content
    listed = _numbered(f.drop("content"))
    both = listed.join(read, "path")
    return both.select("capture", "i", "file", "path", "length", "format", "width", "height", "channels", "depth", F.coalesce("taken", "modified").alias("utc"), F.coalesce("taken_from", F.lit("file")).alias("utc_from"))


def real_times(read: DataFrame) -> DataFrame:
    """(capture, has_real_times): whether every frame of a capture told its own time."""
    return read.groupBy("capture").agg(F.bool_and(F.col("utc_from") != "file").alias("has_real_times"))


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """capture, i, file, height, width, channels, depth, payload: samples row by row, little-endian, channels last; depth is that of the payload."""
    numbered = _numbered(files(spark, folder).drop("content"))
    source = files(spark, folder).select("path", "content")

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = decode(content.as_py())
                row = (path, *((x.shape[0], x.shape[1], x.shape[2], 8 * x.dtype.itemsize, np.ascontiguousarray(x.astype(x.dtype.newbyteorder("<"))).tobytes()) if x is not None else (None,) * 5))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.string(), *[pa.int32()] * 4, pa.binary()), strict=True)], names=["path", "height", "width", "channels", "depth", "payload"])

    read = source.mapInArrow(run, "path string, height int, width int, channels int, depth int, payload binary")
    return numbered.join(read, "path").select("capture", "i", "file", "height", "width", "channels", "depth", "payload")
