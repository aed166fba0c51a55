"""Operator 11: cross-tokenizer alignment by id-striped dense count matrices.

Side A is a byte-level BPE, side B a piece BPE that puts a space in front. A text is cut at each single space between two
characters that are no space: neither side has a token across such a cut (A's pre-tokenizer begins a new word there, and no
piece of B has a space behind another character; otherwise texts stay whole). Units between cuts are encoded by the
libraries once a worker and remembered, up to a bound.

1. ``links``: tasks turn chunks of texts into links, summed up by (text, A id, B id) and dealt into stripes of B ids.
2. ``counts``: links are summed up within each task, then by stripe and salt, then by stripe: one dense block of a stripe's B
   ids by all A ids, filled by ``np.add.at``. Row maxima are each B id's best count.
3. ``scores``: each stripe's counts go to the tasks that hold its links; a stripe with many links is dealt to several.
4. Sums return to their chunk of texts, and there to the rows.

Defined results: a null or empty text, or one that either side does not give back byte by byte, has no tokens: zeros and ''.
Repeated rows, and rows with a null key, count as often as they appear, each returned. Extra columns are dropped. Memory is
bounded by the chunk, by the block, or by the longest run of text without a cut.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, chunks, partitions_for, trim, utf8_buffers

#: B ids of one stripe; a block has so many rows of 8 bytes an A id.
STRIPE = 128
#: Bytes of text turned into links at once, and rows at most.
CHUNK, CHUNK_ROWS = 4 << 20, 1 << 15
#: Units are forgotten after a chunk that brings them over this size (characters, and bytes of links and of keeping them).
REMEMBERED = 40 << 20
#: Characters of new units encoded as one text.
BLOCK = 1 << 16
#: Sums kept by a task before it hands them on.
HELD = 2_000_000
#: Links of a stripe, in bytes, that one task takes.
SHARE = 32 << 20
#: Salts of the first sums of a stripe.
FAN_IN = 8

_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
LINK = np.dtype([("doc", "<u2"), ("b", "<u2"), ("a", "<u4"), ("n", "<u4")])
PAIR = np.dtype([("b", "<u2"), ("a", "<u4"), ("n", "<i8")])
SCORE = np.dtype([("doc", "<u2"), ("best", "<i8"), ("sum", "<i8")])


def _edged(unit: str) -> bool:
    """Whether a space beside it may be no cut."""
    return not unit or unit[0].isspace() or unit[-1].isspace() or unit[0] == "▁" or unit[-1] == "▁"


def _byte_decoder() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: printable Latin-1 as itself, the rest from 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Sides:
    """Both tokenizers, their ids' bytes, and the units seen so far: sizes, links and groups of each by its number."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        table = _byte_decoder()
        self.a_size, self.b_size = self.a.get_vocab_size(), self.b.get_piece_size()
        self.a_bytes = [b""] * self.a_size
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in raw], np.int64) for raw in (self.a_bytes, self.b_bytes))
        self.decimal = [str(i) for i in range(max(self.a_size, self.b_size))]
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.edged: set[str] = set()  # units that begin or end with white space, so a space beside them is no cut
        self.groups: list[bytes] = []
        self.sizes: list[np.ndarray] = []  # per batch of units, rows of: tokens of A, of B, groups, links
        self.pairs: list[np.ndarray] = []  # A id << 32 | B id of each link, unit by unit
        self.held = 0

    def units(self, text: str, fresh: set[str]) -> list[str]:
        """The text's units; those not seen before are added to ``fresh``."""
        parts = text.split(" ") if self.cuts else [text]
        known = self.number
        new = [p for p in parts if p not in known]
        if self.cuts and (any(map(_edged, new)) or not self.edged.isdisjoint(parts)):
            parts = _CUT.split(text)
            new = [p for p in parts if p not in known]
        fresh.update(new)
        return parts

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both sides for a space and ``text``; None if one of them doesn't give it back byte by byte."""
        a, b, want = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text), b" " + text.encode()
        good = b"".join(map(self.a_bytes.__getitem__, a)) == want and b"".join(map(self.b_bytes.__getitem__, b)) == want
        return (a, b) if good else None

    def learn(self, units: list[str]) -> None:
        """Number new units, all aligned at once; -1 for those that a side doesn't give back byte by byte.

        Units with a space between each two are encoded as one text, for no token crosses a cut; those with white edges alone.
        """
        good, flat_a, flat_b = [], [], []
        edged = [u for u in units if _edged(u)]
        self.edged.update(edged)
        plain = _blocks_of([u for u in units if u not in self.edged], BLOCK if self.cuts else 1)
        for block in itertools.chain(plain, ([u] for u in edged)):
            told = self.encode(" ".join(block))
            for part in [block] if told or len(block) == 1 else ([u] for u in block):
                each = told if part is block else self.encode(part[0])
                if each:
                    good += part
                    flat_a.append(np.array(each[0], np.int64))
                    flat_b.append(np.array(each[1], np.int64))
                else:
                    self.number[part[0]] = -1
        self.held += sum(map(len, units)) + 64 * len(units)
        if not good:
            return
        self.number.update(zip(good, range(len(self.groups), len(self.groups) + len(good)), strict=True))
        flat_a, flat_b = np.concatenate(flat_a), np.concatenate(flat_b)
        ends_a, ends_b = np.cumsum(self.a_length[flat_a]), np.cumsum(self.b_length[flat_b])
        ends = np.cumsum([len(u.encode()) + 1 for u in good])  # tokens of both sides end there
        n_a, n_b = (np.diff(np.searchsorted(x, ends, side="right"), prepend=0) for x in (ends_a, ends_b))
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.bincount(np.searchsorted(ends, both), minlength=len(good))
        # each link begins where the later of its tokens begins: one for each distinct begin of either side
        begins = np.union1d(np.append(0, ends_a[:-1]), np.append(0, ends_b[:-1]))
        of_a, of_b = np.searchsorted(ends_a, begins, side="right"), np.searchsorted(ends_b, begins, side="right")
        n_links = np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(good))
        self.pairs.append(flat_a[of_a] << 32 | flat_b[of_b])
        self.sizes.append(np.stack((n_a, n_b, n_groups, n_links), axis=1))
        self.held += 8 * len(begins)
        text_a, text_b = ([self.decimal[i] for i in x.tolist()] for x in (flat_a, flat_b))
        to_a, to_b = (np.searchsorted(ends_a, both) + 1).tolist(), (np.searchsorted(ends_b, both) + 1).tolist()
        each = [f"{text_a[i]}|{text_b[j]}" if x == i + 1 and y == j + 1 else ",".join(text_a[i:x]) + "|" + ",".join(text_b[j:y]) for i, x, j, y in zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)]
        at = np.append(0, np.cumsum(n_groups)).tolist()
        self.groups += [";".join(each[i:j]).encode() for i, j in itertools.pairwise(at)]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, links, each unit's place among the links), by number."""
        self.sizes = [np.concatenate(self.sizes)] if self.sizes else [np.zeros((0, 4), np.int64)]
        self.pairs = [np.concatenate(self.pairs)] if self.pairs else [np.zeros(0, np.int64)]
        return self.sizes[0], self.pairs[0], np.append(0, np.cumsum(self.sizes[0][:, 3]))


def _blocks_of(units: list[str], most: int):
    """Units in lists of about ``most`` characters."""
    block, size = [], 0
    for u in units:
        block.append(u)
        size += len(u) + 1
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


@lru_cache(maxsize=2)
def sides(a_path: str, b_path: str) -> Sides:
    """Once per worker process."""
    return Sides(a_path, b_path)


def _sum_up(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(weights, at)


def align_texts(side: Sides, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Each text's tokens of A, of B, groups, links; its digest; the links as rows (text, B id, A id, times) in order of B, A, text."""
    fresh: set[str] = set()
    parts = [side.units(t, fresh) if t else [] for t in texts]
    known = side.number
    if fresh:
        side.learn(sorted(fresh))
    del fresh
    sizes, pairs, at = side.tables()
    sums, digests = np.zeros((len(texts), 4), np.int64), []
    numbers = []
    for doc, p in enumerate(parts):
        parts[doc] = None
        own = list(map(known.__getitem__, p))
        if not own or min(own) < 0:
            digests.append("")
            continue
        digests.append(hashlib.sha256(b";".join(map(side.groups.__getitem__, own))).hexdigest())
        numbers.append(np.array(own, np.int64) | doc << 40)
    if not numbers:
        return sums, digests, np.zeros((4, 0), np.int64)
    numbers = np.sort(np.concatenate(numbers))
    first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
    times = np.diff(first, append=len(numbers))
    docs, numbers = numbers[first] >> 40, numbers[first] & ((1 << 40) - 1)
    some = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
    sums[docs[some]] = np.add.reduceat(sizes[numbers] * times[:, None], some, axis=0)
    each = sizes[numbers, 3]
    pair = pairs[np.arange(each.sum()) + np.repeat(at[numbers] - np.cumsum(each) + each, each)]
    bits = max(1, int(docs[-1]).bit_length())
    key, n = _sum_up((((pair & 0xFFFFFFFF) * side.a_size + (pair >> 32)) << bits) | np.repeat(docs, each), np.repeat(times, each))
    pair = key >> bits
    return sums, digests, np.stack((key & ((1 << bits) - 1), pair // side.a_size, pair % side.a_size, n))


def links(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of two kinds: stripe >= 0 with the links of a chunk's texts; stripe -1 with a text's own sums, its chunk and place there."""
    kind = dict(docs.dtypes)[key]
    fields = ["stripe", "chunk", "doc", key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "data"]
    types = [pa.int32(), pa.int64(), pa.int32(), None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        chunk = TaskContext.get().partitionId() << 40
        for batch in batches:
            side = sides(a_path, b_path)
            types[3] = batch.column(0).type
            _, offsets = utf8_buffers(batch.column(1))
            for lo, hi in chunks(offsets, CHUNK):
                for i in range(lo, hi, CHUNK_ROWS):
                    j = min(hi, i + CHUNK_ROWS)
                    sums, digests, found = align_texts(side, batch.column(1).slice(i, j - i).to_pylist())
                    rows = j - i
                    own = [pa.array(np.full(rows, -1, np.int32)), pa.array(np.full(rows, chunk)), pa.array(np.arange(rows, dtype=np.int32)), batch.column(0).slice(i, rows)]
                    own += [pa.array(np.ascontiguousarray(sums[:, k])) for k in range(4)] + [pa.array(digests, pa.string()), pa.nulls(rows, pa.binary())]
                    yield pa.RecordBatch.from_arrays(own, names=fields)
                    stripe = found[1] // STRIPE
                    edges = np.flatnonzero(np.concatenate(([True], stripe[1:] != stripe[:-1]))) if len(stripe) else np.zeros(0, np.int64)
                    cells = np.empty(len(stripe), LINK)
                    cells["doc"], cells["b"], cells["a"], cells["n"] = found[0], found[1] % STRIPE, found[2], found[3]
                    data = [np.ascontiguousarray(cells[x:y]).tobytes() for x, y in zip(edges, np.append(edges, len(cells))[1:], strict=True)]
                    n = len(data)
                    if n:
                        nulls = [pa.nulls(n, t) for t in types[2:9]]
                        yield pa.RecordBatch.from_arrays([pa.array(stripe[edges].astype(np.int32)), pa.array(np.full(n, chunk)), *nulls, pa.array(data, pa.binary())], names=fields)
                    chunk += 1
                    if side.held > REMEMBERED:
                        side.clear()
            trim()

    schema = f"stripe int, chunk long, doc int, {key} {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, data binary"
    return docs.select(key, text).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _pairs(keys: np.ndarray, sums: np.ndarray, a_size: int) -> bytes:
    out = np.empty(len(keys), PAIR)
    out["b"], out["a"], out["n"] = keys // a_size, keys % a_size, sums
    return out.tobytes()


def _adder(a_size: int, cell: np.dtype):
    """Sums of the pairs of a task's rows (stripe, data), stripe by stripe; handed on when many are held."""

    def add(batches):
        held: dict[int, list] = {}
        size = 0

        def merged():
            for stripe, parts in held.items():
                keys, sums = _sum_up(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                held[stripe] = [(keys, sums)]
            return sum(len(p[0][0]) for p in held.values())

        def rows():
            for stripe, parts in held.items():
                yield _batch([(stripe, _pairs(*parts[0], a_size))], ["stripe", "data"], [pa.int32(), pa.binary()])

        for batch in batches:
            for stripe, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(raw.as_buffer(), cell)
                keys, sums = _sum_up(x["b"].astype(np.int64) * a_size + x["a"], x["n"].astype(np.int64))
                held.setdefault(stripe, []).append((keys, sums))
                size += len(keys)
                if size > HELD:
                    size = merged()
                    if size > HELD // 2:
                        yield from rows()
                        held.clear()
                        size = 0
        merged()
        yield from rows()

    return add


def counts(stored: DataFrame, a_size: int) -> DataFrame:
    """(stripe, data): how many links hold each id pair, from dense blocks of a stripe each."""

    def dense(batches):
        block = np.zeros((STRIPE, a_size), np.int64)
        flat = block.reshape(-1)
        now = None

        def done():
            at = np.flatnonzero(flat)
            out = _batch([(now, _pairs(part, flat[part], a_size)) for part in np.array_split(at, max(1, -(-len(at) // 500_000)))], ["stripe", "data"], [pa.int32(), pa.binary()])
            flat[at] = 0
            return out

        for batch in batches:
            for stripe, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now is not None and stripe != now:
                    yield done()
                now = stripe
                x = np.frombuffer(raw.as_buffer(), PAIR)
                np.add.at(block, (x["b"], x["a"]), x["n"])
        if now is not None:
            yield done()

    schema = "stripe int, data binary"
    own = stored.select("stripe", "data").mapInArrow(_adder(a_size, LINK), schema)
    salted = own.repartition(F.col("stripe"), F.pmod(F.spark_partition_id(), F.lit(FAN_IN))).mapInArrow(_adder(a_size, PAIR), schema)
    return salted.repartition("stripe").sortWithinPartitions("stripe").mapInArrow(dense, schema)


def scores(stored: DataFrame, counted: DataFrame, a_size: int) -> DataFrame:
    """(chunk, data): for each text of a chunk, its links that are their B id's best, and the counts of all, from one stripe."""

    def score(batches):
        block = np.zeros((STRIPE, a_size), np.int64)
        flat = block.reshape(-1)
        now, filled, top = None, [], None
        out: list[tuple] = []
        for batch in batches:
            for place, kind, chunk, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                if place != now:
                    for keys in filled:
                        flat[keys] = 0
                    now, filled, top = place, [], None
                if kind == 0:  # counts come before links
                    x = np.frombuffer(raw.as_buffer(), PAIR)
                    keys = x["b"].astype(np.int64) * a_size + x["a"]
                    flat[keys] = x["n"]
                    filled.append(keys)
                    continue
                if top is None:
                    top = block.max(axis=1)
                x = np.frombuffer(raw.as_buffer(), LINK)
                n, b = x["n"].astype(np.int64), x["b"]
                count = block[b, x["a"]]
                docs, place_of = np.unique(x["doc"], return_inverse=True)
                cell = np.zeros(len(docs), SCORE)
                cell["doc"] = docs
                best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
                np.add.at(best, place_of, n * (count == top[b]))
                np.add.at(total, place_of, n * count)
                cell["best"], cell["sum"] = best, total
                out.append((chunk, cell.tobytes()))
                if len(out) >= 64:
                    yield _batch(out, ["chunk", "data"], [pa.int64(), pa.binary()])
                    out = []
        if out:
            yield _batch(out, ["chunk", "data"], [pa.int64(), pa.binary()])

    # a row for each stripe: shares of those with many links
    shares = F.broadcast(stored.groupBy("stripe").agg(F.ceil(F.sum(F.length("data")) / SHARE).cast("int").alias("shares")))
    a = counted.join(shares, "stripe").select("stripe", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("chunk"), "data")
    b = stored.join(shares, "stripe").select("stripe", F.pmod(F.hash("chunk"), "shares").alias("share"), F.lit(1).alias("kind"), "chunk", "data")
    both = a.unionByName(b).withColumn("place", F.struct("stripe", "share"))
    dealt = both.repartition("stripe", "share").sortWithinPartitions("stripe", "share", "kind")
    return dealt.select((F.col("stripe").cast("long") * F.lit(1 << 32) + F.col("share")).alias("place"), "kind", "chunk", "data").mapInArrow(score, "chunk long, data binary")


def align_documents(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    scratch = Scratch(spark, "alignment")
    a_size = Tokenizer.from_file(a_path).get_vocab_size()
    all_rows = scratch.write(links(docs, a_path, b_path, key, text), "links")
    stored = all_rows.where("stripe >= 0").select("stripe", "chunk", "data")
    counted = scratch.write(counts(stored, a_size), "counts")
    scored = scores(stored, counted, a_size)
    names = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def gather(batches):
        now, best, total = None, None, None
        for batch in batches:
            chunk, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (chunk[1:] != chunk[:-1]) | (kinds[1:] != kinds[:-1]))))
            for i, j in zip(cuts, [*cuts[1:], len(chunk)], strict=True):
                if chunk[i] != now:
                    now, best, total = chunk[i], np.zeros(CHUNK_ROWS, np.int64), np.zeros(CHUNK_ROWS, np.int64)
                if kinds[i] == 0:  # scores come before texts
                    for raw in batch.column(2).slice(i, j - i):
                        x = np.frombuffer(raw.as_buffer(), SCORE)
                        best[x["doc"]] += x["best"]
                        total[x["doc"]] += x["sum"]
                    continue
                part = batch.slice(i, j - i)
                doc = part.column(3).to_numpy()
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(4, 9)), pa.array(best[doc]), pa.array(total[doc]), part.column(9)], names=names)

    nothing = {"doc": "int", key: kind, "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string"}
    a = scored.select("chunk", F.lit(0).alias("kind"), "data", *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()))
    b = all_rows.where("stripe = -1").select("chunk", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("data"), *nothing)
    dealt = a.unionByName(b).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return dealt.mapInArrow(gather, f"{key} {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
