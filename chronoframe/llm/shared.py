"""Shared plumbing: the folder all executors see, written tables, Arrow text buffers, hashes of words."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library: nothing to trim
    _LIBC = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a folder of our own only in local mode where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='chronoframe-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh(name: str, taken) -> str:
    """``name``, with as many underscores behind it as keep it apart from the columns ``taken``."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def trim() -> None:
    """Give memory that a worker no longer uses back to the machine: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


#: Spark's setting that deletes the shuffle files of a query once it has run.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors.

    ``sweep``: what a write has shuffled is deleted as soon as it is done, not when the driver happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession, what: str, sweep: bool = False):
        self.spark, self.root, self.sweep = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}", sweep
        self.made = 0
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)  # results may still be read until the driver ends

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Run ``df`` once, return it as a table read back from the shared folder."""
        self.made += 1
        at = self.folder(f"{name}-{self.made}")
        was = self.spark.conf.get(SWEEP, "false")
        self.spark.conf.set(SWEEP, "true" if self.sweep else was)
        try:
            df.write.mode("overwrite").parquet(at)
        finally:
            self.spark.conf.set(SWEEP, was)
        out = self.spark.read.schema(df.schema).parquet(at)
        out.scratch_path = at
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for t in tables:
            if t is not None and getattr(t, "scratch_path", None):
                path = jvm.org.apache.hadoop.fs.Path(t.scratch_path)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of plans that are no longer referenced."""
        gc.collect()
        self.spark._jvm.System.gc()


def partitions_for(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- Arrow text


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, most: int = 1 << 20):
    """Row ranges whose bytes together are about ``most``; at least one row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


# ---------------------------------------------------------------- hashes of words

_RNG = np.random.default_rng(20240607)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Byte classes: 0 white space, 1 anything else. RUNS tells letters (and bytes beyond ASCII), digits and marks apart.
WORDS = (~_SPACE).astype(np.uint8)
RUNS = WORDS * np.uint8(3)
RUNS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
RUNS[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The first bytes of eight, by their number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = _RNG.integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number, and of its inverse, at least n of each."""
    if len(_POWERS[0]) < n:
        size = max(1 << 17, 2 * n)
        for k, base in enumerate((_ODD, _ODD_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def _words_of_slice(data: np.ndarray, breaks: np.ndarray, fold: bool, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    kind = classes[data]
    fresh = np.empty(n + 1, bool)  # a new class begins, or a text
    fresh[0] = fresh[n] = True
    np.not_equal(kind[1:], kind[:-1], out=fresh[1:n])
    fresh[breaks[breaks < n]] = True
    edge = np.flatnonzero(fresh)
    inside = kind[edge[:-1]] > 0
    starts, ends = edge[:-1][inside], edge[1:][inside]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    padded = np.zeros(-(-n // 8) * 8 + 16, np.uint8)
    padded[:n] = _LOWER[data] if fold else data
    aligned = padded.view(np.uint64)

    def eight(at: np.ndarray) -> np.ndarray:
        """The eight bytes from each place on."""
        bits = (at & 7).astype(np.uint64) << np.uint64(3)
        at = at >> 3
        return (aligned[at] >> bits) | ((aligned[at + 1] << (np.uint64(63) - bits)) << np.uint64(1))

    length = ends - starts
    h = mix((eight(starts) & _FIRST[np.minimum(length, 8)]) + length.astype(np.uint64) * _ODD)
    more = np.flatnonzero(length > 8)
    at = 8
    while len(more):  # each turn takes eight bytes of the words that have so many, the last ones from the end
        h[more] = mix(h[more] ^ eight(np.minimum(starts[more] + at, ends[more] - 8)) * _ODD)
        at += 8
        more = more[length[more] > at]
        if at >= 512 and len(more):
            for i in more.tolist():
                rest = eight(np.append(np.arange(starts[i] + at, ends[i] - 7, 8), ends[i] - 8))
                h[i] = mix(h[i : i + 1] ^ (mix(rest) * powers(len(rest))[0][: len(rest)]).sum(dtype=np.uint64, keepdims=True))[0]
            break
    return h, starts


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True, slice_bytes: int = 1 << 20, classes: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of consecutive texts, and each text's place among them.

    ``fold`` lower-cases A-Z. Texts longer than ``slice_bytes`` go through in slices cut at white space, so that
    temporary memory stays bounded by the slice, or by the longest word.
    """
    hashes, places = [], []
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + slice_bytes)
        if end < n:
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            inner = offsets[np.searchsorted(offsets, at, side="right") : np.searchsorted(offsets, end, side="right")]
            cut = max(at + int(gaps[-1]) + 1 if len(gaps) else at, int(inner[-1]) if len(inner) else at)
            if cut <= at:  # a word longer than the slice: on to its end
                stop = int(offsets[np.searchsorted(offsets, at, side="right")])
                cut = stop
                for p in range(end, stop, slice_bytes):
                    more = np.flatnonzero(_SPACE[data[p : min(stop, p + slice_bytes)]])
                    if len(more):
                        cut = p + int(more[0]) + 1
                        break
            end = cut
        h, starts = _words_of_slice(data[at:end], offsets[(offsets >= at) & (offsets < end)] - at, fold, classes)
        hashes.append(h)
        places.append(starts + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(places) if places else np.zeros(0, np.int64)
    return h, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its k-word shingles; with fewer words, of the whole sequence."""
    words, at = word_hashes(data, offsets)
    out: list[np.ndarray] = []
    if len(words) >= k:
        joined = words[: len(words) - k + 1] * _PLACE[0]
        for j in range(1, k):
            joined = joined + words[j : len(words) - k + 1 + j] * _PLACE[j]
        joined = mix(joined)
    else:
        joined = words[:0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            s = joined[a : b - k + 1].copy()
            s.sort()
            if len(s) > 1:
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            out.append(s)
        elif b > a:
            whole = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(words[:0])
    return out


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit key of a set of hashes, whatever their order."""
    total = s.sum(dtype=np.uint64, keepdims=True) + np.array([len(s)], np.uint64) * _ODD
    return int(mix(total ^ np.bitwise_xor.reduce(s, keepdims=True) * _ODD_INVERSE).view(np.int64)[0])


# ---------------------------------------------------------------- sums of fixed-size tables


def table_blocks(table: np.ndarray, block: int) -> pa.RecordBatch:
    """The rows of a task's own table, in blocks that can be added up elsewhere."""
    flat = np.ascontiguousarray(table).reshape(-1)
    starts = range(0, len(flat), block)
    return pa.RecordBatch.from_arrays([pa.array([i // block for i in starts], pa.int32()), pa.array([flat[i : i + block].tobytes() for i in starts], pa.binary())], names=["block", "data"])


def sum_tables(blocks: DataFrame, dtype, fan_in: int = 64) -> dict[int, np.ndarray]:
    """Element sums of equally sized blocks from all tasks. Two levels; what reaches the driver is one table."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(raw.as_buffer(), dtype)
                if k in sums:
                    sums[k] += x
                else:
                    sums[k] = x.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["block", "data"])

    schema = "block int, data binary"
    salted = blocks.repartition(F.col("block"), F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    rows = salted.mapInArrow(add, schema).repartition("block").mapInArrow(add, schema).collect()
    return {r["block"]: np.frombuffer(bytes(r["data"]), dtype) for r in rows}


# ---------------------------------------------------------------- connected components


#: So few edges are joined by one task, in bounded memory (some 100 MB), rather than in rounds of the whole cluster.
FEW_EDGES = 1_000_000


def least_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id of its component) of all ids in the edges."""
    ids, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:  # point to the end of each chain
            jump = root[root]
            if (jump == root).all():
                break
            root = jump
        a, b = root[a], root[b]
        differ = a != b
        a, b = a[differ], b[differ]
    return ids, ids[root]


def _roots(batches):
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        u.append(batch.column(0).to_numpy())
        v.append(batch.column(1).to_numpy())
    ids, root = least_labels(np.concatenate(u), np.concatenate(v))
    if len(ids):
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(root)], names=["id", "root"])


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b", few: int = FEW_EDGES) -> DataFrame:
    """(id, root) for every id with an edge to another; root is the smallest id of its component.

    Alternates large-star and small-star steps; every step is two aggregations of the edges that remain, written to
    the shared folder. No edge or component reaches the driver, only their number and a checksum.
    """
    cur = scratch.write(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")

    def state(df):
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    was = state(cur)
    if was[0] <= few:
        return scratch.write(cur.repartition(1).mapInArrow(_roots, "id long, root long"), "roots")
    while was[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        new = scratch.write(small.where("u <> v").distinct(), "edges")
        now = state(new)
        scratch.drop(cur)
        cur = new
        if now == was:
            break
        was = now
    return cur.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(cur.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
