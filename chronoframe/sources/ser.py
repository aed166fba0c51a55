"""SER video files as a Spark data source, and a writer of slices.

``spark.read.format("ser").option("path", folder_or_file)`` gives a row per frame; a partition seeks to its own range of
frames. ``rows`` reads only so many evenly spaced rows of each frame. A file cut short gives the frames it really has.
"""

from __future__ import annotations

import datetime as dt
import os
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADER = 178
#: Fixed by the SER format: seven numbers at byte 14 are LuID, colour id, endianness, width, height, depth, frames.
FIELDS_AT = 14
EPOCH_TICKS = 621355968000000000
SCHEMA = "file string, i int, utc timestamp_ntz, height int, width int, depth int, color_id int, payload binary"


@dataclass(frozen=True)
class SerInfo:
    path: str
    color_id: int
    width: int
    height: int
    depth: int
    frames: int
    size: int
    start_ticks: int

    @property
    def sample(self) -> int:
        return 1 if self.depth <= 8 else 2

    @property
    def channels(self) -> int:
        return 3 if self.color_id >= 100 else 1

    @property
    def frame_bytes(self) -> int:
        return self.width * self.height * self.sample * self.channels

    @property
    def usable(self) -> int:
        return max(0, min(self.frames, (self.size - HEADER) // self.frame_bytes))

    @property
    def has_trailer(self) -> bool:
        return self.size >= HEADER + self.frames * self.frame_bytes + 8 * self.frames


def info(path: str) -> SerInfo:
    with open(path, "rb") as f:
        head = f.read(HEADER)
    if len(head) < HEADER or head[:14] != b"LUCAM-RECORDER":
        raise ValueError(f"{path} is no SER file")
    _, color, _, width, height, depth, frames = struct.unpack_from("<7i", head, FIELDS_AT)
    return SerInfo(path, color, width, height, depth, frames, os.path.getsize(path), struct.unpack_from("<q", head, 170)[0])


def to_time(ticks: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=(ticks - EPOCH_TICKS) // 10)


def row_numbers(height: int, rows: int) -> np.ndarray:
    return np.arange(rows) * height // rows


def read_frame(f, ser: SerInfo, i: int, rows: int = 0) -> bytes:
    at, line = HEADER + i * ser.frame_bytes, ser.frame_bytes // ser.height
    if not rows or rows >= ser.height:
        f.seek(at)
        return f.read(ser.frame_bytes)
    out = []
    for r in row_numbers(ser.height, rows).tolist():
        f.seek(at + r * line)
        out.append(f.read(line))
    return b"".join(out)


def discover(path: str) -> list[str]:
    """SER files of a folder in natural order, or the file itself."""
    import re

    if os.path.isfile(path):
        return [path]
    if not os.path.isdir(path):
        raise ValueError(f"{path} is no folder")
    names = [n for n in os.listdir(path) if n.lower().endswith(".ser")]
    return [os.path.join(path, n) for n in sorted(names, key=lambda n: [int(p) if p.isdigit() else p.lower() for p in re.findall(r"\d+|\D+", n)])]


@dataclass
class FrameRange(InputPartition):
    path: str
    lo: int
    hi: int


class SerReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.rows = options["path"], int(options.get("rows", 0))
        self.chunk, self.stride = int(options.get("chunkbytes", 64 << 20)), int(options.get("stride", 1))

    def partitions(self):
        out = []
        for p in discover(self.path):
            ser = info(p)
            step = max(1, self.chunk // ser.frame_bytes)
            out += [FrameRange(p, a, min(ser.usable, a + step)) for a in range(0, ser.usable, step)]
        return out or [FrameRange("", 0, 0)]

    def read(self, part):
        if not part.path:
            return
        ser = info(part.path)
        with open(part.path, "rb") as f:
            for i in range(part.lo, part.hi):
                if i % self.stride:
                    continue
                ticks = ser.start_ticks
                if ser.has_trailer:
                    f.seek(HEADER + ser.frames * ser.frame_bytes + 8 * i)
                    ticks = struct.unpack("<q", f.read(8))[0]
                payload = read_frame(f, ser, i, self.rows)
                height = min(self.rows, ser.height) if self.rows else ser.height
                yield os.path.basename(part.path), i, to_time(ticks), height, ser.width, ser.depth, ser.color_id, payload


class SerSource(DataSource):
    @classmethod
    def name(cls):
        return "ser"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SerReader(self.options)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(SerSource)
    return spark.read.format("ser").options(path=path, **options).load()


def write(path: str, frames: np.ndarray, color_id: int = 8, ticks: list[int] | None = None) -> None:
    """Write frames (n, h, w) of unsigned 8- or 16-bit samples."""
    depth = 8 * frames.dtype.itemsize
    with open(path, "wb") as f:
        f.write(b"LUCAM-RECORDER" + struct.pack("<7i", 0, color_id, 0, frames.shape[2], frames.shape[1], depth, len(frames)) + bytes(120))
        f.write(struct.pack("<2q", ticks[0] if ticks else EPOCH_TICKS, ticks[0] if ticks else EPOCH_TICKS))
        f.write(frames.astype(frames.dtype.newbyteorder("<")).tobytes())
        if ticks:
            f.write(struct.pack(f"<{len(ticks)}q", *ticks))


def slice_file(src: str, dst: str, start: int, count: int) -> int:
    """Copy frames [start, start + count) with their times; returns how many there were."""
    ser = info(src)
    n = max(0, min(count, ser.usable - start))
    with open(src, "rb") as f, open(dst, "wb") as g:
        head = bytearray(f.read(HEADER))
        struct.pack_into("<i", head, FIELDS_AT + 24, n)
        g.write(head)
        f.seek(HEADER + start * ser.frame_bytes)
        for _ in range(n):
            g.write(f.read(ser.frame_bytes))
        if ser.has_trailer:
            f.seek(HEADER + ser.frames * ser.frame_bytes + 8 * start)
            g.write(f.read(8 * n))
    return n


def describe(path: str) -> str:
    s = info(path)
    return f"{os.path.basename(path)}: {s.usable} frames, {s.width}x{s.height}, {s.depth} bit, colour {s.color_id}"
