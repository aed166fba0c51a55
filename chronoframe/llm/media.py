"""Operator 4: media columns over content-addressed payloads in tar shards.

A payload is a text in UTF-8, filled up with zero bytes to a positive multiple of 64, stored as an 8-bit greyscale PNG
64 samples wide (lossless). Every task writes the distinct payloads it meets to a tar shard of its own; an index gives
each digest one place (shard, offset, length), which the rows carry. The metadata columns (format, width, height, depth)
come from range reads of the header alone, the digests and the feature from the stored form's range. Work on a payload is
done once per digest.

A shard's name has the task's attempt; a task that runs again writes a new shard, and the index, written to the shared
folder, names only shards whose task ended. Equal payloads of several tasks are stored by each; the index keeps the first.

Defined results: null text: empty, so 64 zero bytes. Repeated rows stay repeated. No documents: no rows.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, utf8_buffers

UNIT = 64
HEADER_BYTES = 33
#: Fixed by the PNG standard.
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(raw: bytes) -> bytes:
    return raw + bytes(UNIT if not raw else -len(raw) % UNIT)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes, level: int = 6) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    lines = np.zeros((len(rows), UNIT + 1), np.uint8)  # filter 0 before each line
    lines[:, 1:] = rows
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", UNIT, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> dict[str, int]:
    """Width, height, depth and colour type from the first bytes alone."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != struct.unpack(">I", head[29:33])[0]:
        raise ValueError("not a PNG header")
    width, height, depth, colour = struct.unpack(">IIBB", head[16:26])
    return {"width": width, "height": height, "depth": depth, "colour": colour}


def from_png(media: bytes) -> bytes:
    head, at, body = png_header(media[:HEADER_BYTES]), HEADER_BYTES, []
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        if zlib.crc32(media[at + 4 : at + 8 + size]) != struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IDAT":
            body.append(media[at + 8 : at + 8 + size])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(head["height"], head["width"] + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines are not written here")
    return lines[:, 1:].tobytes()


def _tar_entry(name: str, body: bytes) -> bytes:
    info = tarfile.TarInfo(name)
    info.size = len(body)
    return info.tobuf(tarfile.USTAR_FORMAT) + body + bytes(-len(body) % tarfile.BLOCKSIZE)


def store(docs: DataFrame, scratch: Scratch, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows: key, n_bytes, digest; index: digest, shard, offset, length), both written tables."""
    folder = scratch.folder("shards")
    kind = dict(docs.dtypes)[key]
    docs.sparkSession._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(docs.sparkSession._jsc.hadoopConfiguration()).mkdirs(docs.sparkSession._jvm.org.apache.hadoop.fs.Path(folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4().hex}.tar"
        seen: dict[bytes, tuple[int, int]] = {}
        out, at = None, 0
        try:
            for batch in batches:
                data, off = utf8_buffers(batch.column(1))
                size, digests, places = [], [], []
                for i in range(batch.num_rows):
                    raw = data[off[i] : off[i + 1]].tobytes()
                    payload = payload_of(raw)
                    digest = hashlib.sha256(payload).digest()
                    if digest not in seen:
                        out = out or system.open_output_stream(f"{base}/{name}")
                        media = to_png(payload)
                        entry = _tar_entry(f"{digest.hex()}.png", media)
                        seen[digest] = (at + tarfile.BLOCKSIZE, len(media))
                        out.write(entry)
                        at += len(entry)
                    size.append(len(raw))
                    digests.append(digest)
                    places.append(seen[digest])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(digests, pa.binary()), pa.array([name] * len(size), pa.string()), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())], names=[key, "n_bytes", "digest", "shard", "offset", "length"])
            if out:
                out.write(bytes(2 * tarfile.BLOCKSIZE))
        finally:
            if out:
                out.close()

    rows = scratch.write(docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, n_bytes long, digest binary, shard string, offset long, length long"), "rows")
    index = rows.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("p")).select("digest", "p.*")
    return rows.select(key, "n_bytes", "digest"), scratch.write(index.repartition("shard").sortWithinPartitions("shard", "offset"), "index")


def _ranges(folder: str, batches, work, names):
    system, base = fs.FileSystem.from_uri(folder)
    opened, handle = None, None
    try:
        for batch in batches:
            found = []
            for shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True):
                if shard != opened:
                    if handle:
                        handle.close()
                    opened, handle = shard, system.open_input_file(f"{base}/{shard}")
                found.append(work(handle, offset, length))
            columns = [pa.array(list(c)) for c in zip(*found, strict=True)] if found else []
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("digest"), *columns], names=["digest", *names])
    finally:
        if handle:
            handle.close()


META = {"format": "string", "width": "long", "height": "long", "depth": "long"}
FEATURES = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}


def _head(handle, offset: int, length: int) -> tuple:
    """Metadata from a range read of the header."""
    h = png_header(handle.read_at(HEADER_BYTES, offset))
    return "png", h["width"], h["height"], h["depth"]


def _samples(handle, offset: int, length: int, meta: tuple) -> tuple:
    """What needs the samples, from a range read of the stored form."""
    media = handle.read_at(length, offset)
    payload = from_png(media)
    sample = np.frombuffer(payload, np.uint8)
    counts = np.bincount(sample, minlength=256)
    share = counts[counts > 0] / len(sample)
    form, width, height, depth = meta
    text = f"{form}:{width}x{height}x{depth}:mean={sample.mean():.4f}:entropy={-(share * np.log2(share)).sum():.4f}:max={int(sample.max())}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), text


def _fields(columns: dict[str, str]) -> str:
    return "digest binary, " + ", ".join(f"{n} {k}" for n, k in columns.items())


def metadata(index: DataFrame, folder: str) -> DataFrame:
    """Format columns per digest; reads the header's bytes only."""
    return index.mapInArrow(lambda b: _ranges(folder, b, _head, list(META)), _fields(META))


def features(index: DataFrame, folder: str) -> DataFrame:
    """Format columns from the header's range, then what needs the samples from the stored form's, per digest."""

    def both(handle, offset, length):
        meta = _head(handle, offset, length)
        return *meta, *_samples(handle, offset, length, meta)

    return index.mapInArrow(lambda b: _ranges(folder, b, both, [*META, *FEATURES]), _fields(META | FEATURES))


def media_columns(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Store all texts, read them back, and give each row its payload's place and columns."""
    scratch = Scratch(docs.sparkSession, "media")
    rows, index = store(docs, scratch, key)
    found = features(index, scratch.folder("shards")).join(index, "digest")
    return rows.join(found, "digest").select(key, "n_bytes", *FEATURES, *META, F.hex("digest").alias("digest"), "shard", "offset", "length")


def tar_members(raw: bytes) -> list[tuple[str, bytes]]:
    """(name, body) of a shard's entries, by the standard reader."""
    with tarfile.open(fileobj=io.BytesIO(raw)) as t:
        return [(m.name, t.extractfile(m).read()) for m in t.getmembers()]
