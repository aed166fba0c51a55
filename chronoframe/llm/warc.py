"""Operator 5: WARC archives, compressed record by record with a Zstandard dictionary.

Each task writes an archive, another one after each ``ARCHIVE_BYTES``: it builds a dictionary from records of its own (a bounded sample of ``dictionary_sample``
bytes), puts it in a skippable frame at the file's start, and compresses every record as a frame of its own. Payloads of
at least ``revisit_from`` bytes that occur more than once are stored by the record with the largest id; the others are
revisit records that name it.

Defined results: null html: an empty payload. Rows that share payload and the largest id are all responses. A null id
never is the largest and is written as an empty id. Repeated rows stay repeated; extra columns are dropped. Few long records
are cut into pieces for the dictionary; where even these are too few, or nothing repeats in them, the skippable frame is
empty and frames go without one.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, utf8_buffers

#: Fixed by the published format of Zstandard WARC files: the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_SAMPLE = 4 << 20
DICTIONARY_BYTES = 64 << 10
#: Fewer than 16 records are cut into pieces of this length to train on.
DICTIONARY_PIECE = 1 << 14
REVISIT_FROM = 1000
#: A task begins another archive once one has so many bytes.
ARCHIVE_BYTES = 1 << 30


def record(key, url: str | None, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    kind = b"response" if refers_to is None else b"revisit"
    target = (url or "").encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:page:%s>" % (b"" if key is None else str(key).encode()), b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Target-URI: " + target, b"WARC-Payload-Digest: sha1:" + digest.encode(), b"X-Payload-Length: %d" % size]
    if refers_to is None:
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    else:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%s>" % str(refers_to).encode()]
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(body)]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    return fields, block.partition(b"\r\n\r\n")[2]


def _dictionary(samples: list[bytes]):
    import zstandard

    if len(samples) < 16:
        samples = [r[i : i + DICTIONARY_PIECE] for r in samples for i in range(0, len(r), DICTIONARY_PIECE)]
    if len(samples) < 16:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1 << 10, sum(map(len, samples)) // 10)), samples, level=3)
    except zstandard.ZstdError:
        return None


class Writer:
    """Archive of one task. The first records are held back until the dictionary's sample is full."""

    def __init__(self, stream, sample: int = DICTIONARY_SAMPLE):
        self.stream, self.sample, self.at = stream, sample, 0
        self.held: list[bytes] | None = []
        self.size = 0

    def _begin(self) -> None:
        import zstandard

        book = _dictionary(self.held)
        raw = book.as_bytes() if book else b""
        self.codec = zstandard.ZstdCompressor(level=6, dict_data=book)
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        held, self.held = self.held, None
        for r in held:
            self._put(self.codec.compress(r))

    def _put(self, raw: bytes) -> None:
        self.stream.write(raw)
        self.at += len(raw)

    def add(self, raw: bytes) -> None:
        if self.held is None:
            self._put(self.codec.compress(raw))
            return
        self.held.append(raw)
        self.size += len(raw)
        if self.size >= self.sample:
            self._begin()

    def close(self) -> None:
        if self.held is not None:
            self._begin()
        self.stream.close()


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    raw = stream.read(size)
    codec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if size else None)
    rest = b""
    while True:
        frame, out = codec.decompressobj(), []
        while not frame.eof:
            rest = rest or stream.read(1 << 18)
            if not rest:
                if out:
                    raise ValueError("archive ends inside a record")
                return
            out.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def with_revisits(pages: DataFrame, key: str = "page_id", html: str = "html", revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Pages with payload_digest, payload_bytes and refers_to (null for responses)."""
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("id"), "url", text.alias("html")).withColumns({"payload_digest": F.sha1(F.col("html").cast("binary")), "payload_bytes": F.octet_length("html").cast("long")})
    first = rows.where(F.col("payload_bytes") >= revisit_from).groupBy(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n")).agg(F.max("id").alias("top"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    # Only ids and digests meet by digest, which may be hot; pages meet their marks by id.
    narrow = rows.where(F.col("payload_bytes") >= revisit_from).select("id", "payload_digest", "payload_bytes")
    marks = narrow.join(first, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("n"))).where(~F.col("id").eqNullSafe(F.col("top"))).select(F.col("id").alias("i"), "d", "n", F.col("top").alias("refers_to")).distinct()
    joined = rows.join(marks, F.col("id").eqNullSafe(F.col("i")) & (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("n")), "left")
    return joined.select("id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "payload_digest", "payload_bytes", "refers_to")


def write_archives(rows: DataFrame, scratch: Scratch, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write an archive a task, more where it has much; the written table of (shard, records) names those whose task ended."""
    folder = scratch.folder("archives")
    path = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).mkdirs(path)

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        name, out, n = "", None, 0
        named = lambda: pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["shard", "records"])
        for batch in batches:
            data, off = utf8_buffers(batch.column("html"))
            cols = [batch.column(c).to_pylist() for c in ("id", "url", "payload_digest", "payload_bytes", "refers_to")]
            for i, (key, url, digest, size, refers) in enumerate(zip(*cols, strict=True)):
                if out is None:
                    name, n = f"{uuid.uuid4().hex}.warc.zst", 0
                    out = Writer(system.open_output_stream(f"{base}/{name}"))
                out.add(record(key, url, data[off[i] : off[i + 1]].tobytes(), digest, size, refers))
                n += 1
                if out.at >= archive_bytes:
                    out.close()
                    out = None
                    yield named()
        if out:
            out.close()
            yield named()

    return scratch.write(rows.mapInArrow(run, "shard string, records long"), "archives")


def read_archives(shards: DataFrame, folder: str, key: str = "page_id", kind: str = "bigint") -> DataFrame:
    """A row per record of all archives; a response's length and digest are computed from what was read."""

    def run(batches):
        system, base = fs.FileSystem.from_uri(folder)
        whole = (lambda x: int(x)) if kind in ("bigint", "int", "smallint", "tinyint") else str
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                rows = []
                with system.open_input_stream(f"{base}/{shard}") as stream:
                    for raw in read_archive(stream):
                        f, payload = parse(raw)
                        page, refers = f["WARC-Record-ID"][10:-1], f.get("WARC-Refers-To", "")[10:-1]
                        size, digest = int(f["X-Payload-Length"]), f["WARC-Payload-Digest"].removeprefix("sha1:")
                        if f["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                            raise ValueError(f"payload of {page} does not fit its digest")
                        rows.append((whole(page) if page else None, size, digest, f["WARC-Type"], whole(refers) if refers else None))
                        if len(rows) == 4096:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    names = [key, "payload_bytes", "payload_digest", "record_type", "refers_to"]
    ids = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(kind, pa.string())

    def _rows(rows):
        c = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c[0], ids), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.string()), pa.array(c[4], ids)], names=names)

    return shards.repartition(max(1, min(shards.count(), 100000))).mapInArrow(run, f"`{key}` {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}")


def archive(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Write all pages as records, read the archives back."""
    scratch = Scratch(pages.sparkSession, "warc")
    shards = write_archives(with_revisits(pages, key), scratch)
    return read_archives(shards, scratch.folder("archives"), key, dict(pages.dtypes)[key])
