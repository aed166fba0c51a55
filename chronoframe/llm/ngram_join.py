"""Operator 1: n-gram Jaccard join by size-aware heavy-light overlap join.

Documents become sets of hashed k-word shingles; equal sets are one class. Light classes (few shingles) enumerate all
subsets of the sizes that a link needs: two of them that share such a subset are linked, with nothing left to verify.
Heavy classes are looked up in inverted lists of prefix elements: under one order of all shingles, two sets with
Jaccard at least t share an element among their first n - ceil(t n) + 1. The order puts frequent shingles last, by counts
of all shingles of all documents in a fixed number of slots, so that passages many documents share stay out of the lists.
Before anything is paired, a list falls into the parts that sizes, places and 64 parity bits of the sets connect, and sets
that meet by chance alone go no further. Pairs from the lists are verified on whole sets. The boundary between light and heavy is the size at which the
histogram of sizes makes the sum of both costs least.

Defined results: null or empty text, or no word: an empty set, linked with nothing, its component its own doc_id.
Repeated rows get equal results. A null doc_id has the least doc_id of its component that is not null, if any.
Shingles are compared by 64-bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .linkage import link, parts
from .shared import Scratch, chunks, mix, set_key, shingle_sets, sum_tables, table_blocks, utf8_buffers

#: Jaccard threshold as a fraction.
NUMERATOR, DENOMINATOR = 80, 100
#: Slots that shingles are counted in, for the order of prefixes.
SLOTS = 1 << 18
#: Largest size whose sets may be light; the boundary is chosen up to here.
LIGHT_MOST = 12
#: Cost of an entry of an inverted list against that of an enumerated subset.
LIST_COST = 4
#: Parity bits that the last join compares.
SIGNATURE_BITS = 512
#: Rows of lists that are held at a time, and rounds of leaders at most: a round looks at no more pairs than entries.
HELD, ROUNDS = 1 << 16, 8


def needed_overlap(n: int, m: int) -> int:
    """Least intersection of sets of n and m elements that are linked."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


def subset_sizes(n: int, light: int) -> list[int]:
    return sorted({needed_overlap(n, m) for m in range(1, light + 1) if DENOMINATOR * min(n, m) >= NUMERATOR * max(n, m)})


def subsets(s: np.ndarray, light: int) -> list[tuple[int, int]]:
    """(key, size) of every subset whose size some link of this set needs."""
    out, spread = [], mix(s)
    for c in subset_sizes(len(s), light):
        pick = np.array(list(combinations(range(len(s)), c)))
        keys = mix(spread[pick].sum(axis=1, dtype=np.uint64) + np.uint64(c))
        out += [(k, c) for k in keys.view(np.int64).tolist()]
    return out


def prefix_length(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def parity_bits(s: np.ndarray) -> bytes:
    """A bit per slot: whether an odd number of elements fall there. About as many slots as elements."""
    size = max(SIGNATURE_BITS, 1 << min(16, (len(s) - 1).bit_length()))
    return np.packbits((np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def signature(bits: bytes) -> list[int]:
    """Parity bits folded to ``SIGNATURE_BITS``, as signed 64-bit numbers."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.int64).reshape(-1, SIGNATURE_BITS // 64), axis=0).tolist()


def least_difference(p: np.ndarray, q: np.ndarray) -> int:
    """A lower bound of the symmetric difference of two sets, from their parity bits; longer ones fold into shorter."""
    while len(p) > len(q):
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    while len(q) > len(p):
        q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    return int(np.bitwise_count(p ^ q).sum())


def _sets(batch: pa.RecordBatch, column: str):
    data, off = utf8_buffers(batch.column(column))
    for i, j in chunks(off):
        yield from enumerate(shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i]), i)


def describe(docs: DataFrame, key: str) -> DataFrame:
    """(key, th, n, cls, small, bits) of each row, and blocks of this task's counts of shingles."""
    source = docs.select(F.col(key).alias("id"), F.xxhash64("text").alias("th"), "text")
    names = ["id", "th", "n", "cls", "small", "bits", "block", "data"]

    def run(batches):
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            n, cls, small, bits = [], [], [], []
            for _, s in _sets(batch, "text"):
                if len(s):
                    np.add.at(counts, (s >> np.uint64(46)).astype(np.int64), 1)
                n.append(len(s))
                cls.append(set_key(s) if len(s) else None)
                small.append(s.tobytes() if 0 < len(s) <= LIGHT_MOST else None)
                bits.append(parity_bits(s) if len(s) else None)
            size = len(n)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(small, pa.binary()), pa.array(bits, pa.binary()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], names=names)
        blocks = table_blocks(counts, 1 << 12)
        k = blocks.num_rows
        empty = pa.nulls(k, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.nulls(k, ids), empty, empty, empty, pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), *blocks.columns], names=names)

    kind = dict(source.dtypes)["id"]
    ids = to_arrow_type(source.schema["id"].dataType)
    return source.mapInArrow(run, f"id {kind}, th long, n long, cls long, small binary, bits binary, block int, data binary")


def boundary(sizes: dict[int, int]) -> int:
    """Largest light size: where enumerating subsets and scanning lists together cost least. ``sizes``: classes by size."""

    def subset_count(n: int, light: int) -> int:
        return sum(int(np.prod([(n - i) / (i + 1) for i in range(c)]) + 0.5) for c in subset_sizes(n, light))

    def cost(light: int) -> float:
        return sum(k * (subset_count(n, light) if n <= light else 0) + k * (LIST_COST * prefix_length(n) if n > light * NUMERATOR // DENOMINATOR else 0) for n, k in sizes.items())

    return min(range(0, LIGHT_MOST + 1), key=cost)


def may_link(p, q):
    """Whether two sets may be linked that have an element in common at ``rest`` elements from the end, and none before.

    Each linked pair has a first common element, and there this holds; what follows it has to suffice for the overlap.
    """
    alike = DENOMINATOR * F.least(p["n"], q["n"]) >= NUMERATOR * F.greatest(p["n"], q["n"])
    return alike & ((NUMERATOR + DENOMINATOR) * F.least(p["rest"], q["rest"]) >= NUMERATOR * (p["n"] + q["n"]))


def signatures_allow(p, q):
    """Whether the signatures leave room for a link: bits that differ are elements in one set only."""
    apart = sum((F.bit_count(p["sig"][i].bitwiseXOR(q["sig"][i])) for i in range(1, SIGNATURE_BITS // 64)), F.bit_count(p["sig"][0].bitwiseXOR(q["sig"][0])))
    return (DENOMINATOR + NUMERATOR) * apart <= (DENOMINATOR - NUMERATOR) * (p["n"] + q["n"])


def prefix_lists(docs: DataFrame, level: np.ndarray, light: int) -> DataFrame:
    """(key, id, n, rest, mark): the first elements of each class under the order (frequency, hash).

    ``n`` is the size of the set, ``rest`` the number of its elements from this one on, ``mark`` has 64 parity bits of the set.
    """

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, ids, sizes, rest, marks = [], [], [], [], []
            for _, s in _sets(batch, "text"):
                if not len(s) or len(s) <= light * NUMERATOR // DENOMINATOR:
                    continue
                cls = set_key(s)
                if cls in seen:
                    continue
                seen.add(cls)
                p = prefix_length(len(s))
                frequency = level[(s >> np.uint64(46)).astype(np.int64)]
                keys.append(s[np.argsort(frequency, kind="stable")[:p]] if frequency.any() else s[:p])
                ids.append(np.full(len(keys[-1]), cls, np.int64))
                sizes.append(np.full(len(keys[-1]), len(s), np.int64))
                rest.append(np.arange(len(s), len(s) - p, -1, dtype=np.int64))
                marks.append(np.full(len(keys[-1]), mark_of(s).view(np.int64)))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (ids, sizes, rest, marks))], names=["key", "id", "n", "rest", "mark"])

    return docs.select("text").mapInArrow(run, "key long, id long, n long, rest long, mark long")


def mark_of(s: np.ndarray) -> np.uint64:
    """64 parity bits of a set."""
    return np.bitwise_xor.reduce(np.uint64(1) << (s & np.uint64(63)))


def parts_of(key: np.ndarray, n: np.ndarray, rest: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The part of each row of lists sorted by (key, n): sets that ``may_link`` and their marks allow to be linked are in one."""

    def allow(x, y):
        total = n[x] + n[y]
        few = (DENOMINATOR + NUMERATOR) * np.bitwise_count((mark[x] ^ mark[y]).view(np.uint64)).astype(np.int64) <= (DENOMINATOR - NUMERATOR) * total
        return few & ((NUMERATOR + DENOMINATOR) * np.minimum(rest[x], rest[y]) >= NUMERATOR * total)

    return parts(key, lambda x, y: DENOMINATOR * n[x] >= NUMERATOR * n[y], allow)


def split_lists(lists: DataFrame) -> DataFrame:
    """(key, id, n, rest) of the lists' parts of several sets; a list of more than sixteen times HELD rows stays whole."""
    names = ["key", "id", "n", "rest"]

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def split(columns: list[np.ndarray]) -> pa.RecordBatch:
        key = columns[0]
        same = key[1:] == key[:-1]
        several = np.append(same, False) | np.insert(same, 0, False)
        key, ids, n, rest, mark = (c[several] for c in columns)
        if not len(key):
            return out([key, ids, n, rest])
        part = parts_of(key, n, rest, mark)
        several = np.bincount(part, minlength=len(part))[part] > 1
        name = mix(mix(key.view(np.uint64)) + ids[part].view(np.uint64)).view(np.int64)
        return out([c[several] for c in (name, ids, n, rest)])

    def run(batches):
        held: list[list[np.ndarray]] = []
        size, long = 0, None  # the key of a list that passes whole
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if long is not None:
                on = columns[0] == long
                if on.any():
                    yield out([c[on] for c in columns[:4]])
                columns = [c[~on] for c in columns]
                if not len(columns[0]):
                    continue
                long = None
            held.append(columns)
            size += len(columns[0])
            if size < HELD:
                continue
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last list may go on
            if cut:
                yield split([c[:cut] for c in columns])
            held = [[c[cut:] for c in columns]]
            size -= cut
            if size > 16 * HELD:
                long = columns[0][-1]
                yield out(held[0][:4])
                held, size = [], 0
        if held:
            yield split([np.concatenate(x) for x in zip(*held, strict=True)])

    return lists.repartition("key").sortWithinPartitions("key", "n").mapInArrow(run, "key long, id long, n long, rest long")


def light_links(scratch: Scratch, classes: DataFrame, light: int) -> DataFrame | None:
    """Links of light classes: within a subset's group, the smallest set is linked with all it may be linked with.

    If sets of n and m elements that share c are linked, each is linked with the smallest set of the group, too.
    """
    if light < 4:
        return None

    def run(batches):
        for batch in batches:
            rows = [(k, c, cls, n) for cls, n, raw in zip(*(batch.column(x).to_pylist() for x in ("cls", "n", "small")), strict=True) for k, c in subsets(np.frombuffer(raw, np.uint64), light)]
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64())], names=["key", "c", "id", "n"])

    subs = scratch.write(classes.where(F.col("n") <= light).select("cls", "n", "small").mapInArrow(run, "key long, c int, id long, n long"), "subsets")
    lead = subs.groupBy("key", "c").agg(F.min(F.struct("n", "id")).alias("lead"))
    pairs = subs.join(lead, ["key", "c"]).where((F.col("id") != F.col("lead.id")) & (DENOMINATOR * F.col("c") >= NUMERATOR * (F.col("n") + F.col("lead.n") - F.col("c"))))
    return pairs.select(F.col("id").alias("a"), F.col("lead.id").alias("b")).distinct()


def _packed(docs: DataFrame, key: str) -> DataFrame:
    """(id, th, packed): texts compressed for a shuffle."""
    source = docs.select(F.col(key).alias("id"), F.xxhash64("text").alias("th"), "text").where("text is not null")

    def run(batches):
        codec = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, off = utf8_buffers(batch.column("text"))
            packed = [codec.compress(data[a:b].tobytes()) for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(packed, pa.binary())], names=["id", "th", "packed"])

    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, th long, packed binary")


def fetch_sets(docs: DataFrame, key: str, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(cls, elements) of the classes in ``ids`` (cls), from the text of one document of each."""
    wanted = classes.join(ids, "cls", "left_semi").select(F.col("rep.id").alias("rid"), F.col("rep.th").alias("rth"), "cls")
    texts = _packed(docs, key).join(wanted, F.col("id").eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth"))).select("cls", "packed")

    def run(batches):
        codec = zstandard.ZstdDecompressor()
        seen: set[int] = set()
        for batch in batches:
            for cls, packed in zip(batch.column("cls").to_pylist(), batch.column("packed"), strict=True):
                if cls in seen:  # repeated rows meet in one partition
                    continue
                seen.add(cls)
                raw = np.frombuffer(codec.decompress(packed.as_buffer()), np.uint8)
                s = shingle_sets(raw, np.array([0, len(raw)]))[0]
                yield pa.RecordBatch.from_arrays([pa.array([cls], pa.int64()), pa.array([s.tobytes()], pa.binary())], names=["cls", "elements"])

    return texts.mapInArrow(run, "cls long, elements binary")


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and parity bits do not rule out: at the threshold, few elements are in one set only."""
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    fits = F.least("n_a", "n_b") * DENOMINATOR >= F.greatest("n_a", "n_b") * NUMERATOR

    def run(batches):
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            apart = [least_difference(np.frombuffer(p.as_buffer(), np.uint8), np.frombuffer(q.as_buffer(), np.uint8)) for p, q in zip(batch.column("bits_a"), batch.column("bits_b"), strict=True)]
            mask = pa.array((DENOMINATOR + NUMERATOR) * np.array(apart, np.int64) <= (DENOMINATOR - NUMERATOR) * total)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").where(fits).mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    x = sets.select(F.col("cls").alias("a"), F.col("elements").alias("ea"))
    y = sets.select(F.col("cls").alias("b"), F.col("elements").alias("eb"))
    fits = F.least(F.octet_length("ea"), F.octet_length("eb")) * DENOMINATOR >= F.greatest(F.octet_length("ea"), F.octet_length("eb")) * NUMERATOR

    def run(batches):
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("ea"), batch.column("eb"), strict=True):
                s, t = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = np.concatenate((s, t))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(DENOMINATOR * common >= NUMERATOR * (len(s) + len(t) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return pairs.join(x, "a").join(y, "b").where(fits).mapInArrow(run, "a long, b long")


def join_documents(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, class_id, th) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngrams")
    told = scratch.write(describe(docs, key), "described")
    rows = told.where("block is null").select("id", "th", "n", "cls", "small", "bits")
    sums = sum_tables(told.where("block is not null").select("block", "data"), np.int64)
    counts = np.concatenate([sums[k] for k in sorted(sums)]) if sums else np.zeros(SLOTS, np.int64)
    usual = 2 * max(1.0, float(counts.mean()))
    level = np.where(counts <= usual, 0, np.minimum(counts / usual, 250) + 1).astype(np.uint8)

    classes = scratch.write(rows.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("small").alias("small"), F.first("bits").alias("bits"), F.min(F.struct("id", "th")).alias("rep"), F.min("id").alias("least")), "classes")
    sizes = {r["n"]: r["count"] for r in classes.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").count().collect()}
    light = boundary(sizes)

    held: list[DataFrame] = []

    def verify(pairs: DataFrame) -> DataFrame:
        scratch.drop(*held)
        close = scratch.write(promising(pairs, classes), "close")
        held[:] = [close]
        if close.isEmpty():
            return close
        ids = close.select(F.col("a").alias("cls")).unionByName(close.select(F.col("b").alias("cls"))).distinct()
        held.append(scratch.write(fetch_sets(docs, key, classes, ids), "sets"))
        return verified(*held)

    def sign(batches):
        for batch in batches:
            sigs = [signature(raw) for raw in batch.column("bits").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(sigs, pa.list_(pa.int64()))], names=["id", "sig"])

    signed = classes.select("cls", "bits").mapInArrow(sign, "id long, sig array<long>")
    lists = scratch.write(split_lists(prefix_lists(docs, level, light)), "parts")
    comps = link(scratch, lists, verify, rounds=ROUNDS, known=light_links(scratch, classes, light), fits=may_link, details=signed, fits_last=signatures_allow)
    scratch.drop(*held)
    # Components are named by class: rows meet their class, never all rows of a component in one task.
    named = classes.select("cls", "least", F.col("cls").alias("root"))
    if comps is not None:
        rooted = scratch.write(classes.join(comps, F.col("cls") == comps["id"], "left").select("cls", "least", F.coalesce("root", "cls").alias("root")), "rooted")
        alone = rooted.groupBy("root").agg(F.min("least").alias("least"))
        named = scratch.write(rooted.select("cls", "root").join(alone, "root"), "named")
    found = rows.select(F.col("id").alias("row_id"), "th", "n", F.col("cls").alias("row_cls")).join(named, F.col("row_cls") == F.col("cls"), "left")
    return found.select(F.col("row_id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "row_id").alias("component_id"), F.col("root").alias("class_id"), "th")


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One document of each component: that with the least id, once. Documents without shingles all stay."""
    found = join_documents(docs.select(F.col(f"`{key}`").alias("id"), "text"), "id")
    stay = found.where(F.col("class_id").isNull() | F.col("id").eqNullSafe(F.col("component_id")))
    with_words = stay.where("class_id is not null").groupBy("class_id").agg(F.min(F.struct("id", "th")).alias("s")).select("s.*", F.lit(True).alias("once"))
    empty = stay.where("class_id is null").select("id", "th", F.lit(False).alias("once")).distinct()
    chosen = Scratch(docs.sparkSession, "kept").write(with_words.unionByName(empty).withColumnsRenamed({"id": "chosen_id", "th": "chosen_th"}), "rows")
    packed = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64("text").alias("th"), F.struct(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(docs.columns))).alias("row"))
    marked = packed.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("th") == F.col("chosen_th")))
    again = F.row_number().over(Window.partitionBy("chosen_id", "chosen_th", "once").orderBy(F.lit(0)))
    once = marked.where("once").withColumn("number", again).where("number = 1").drop("number")
    return once.unionByName(marked.where("not once")).select(*(F.col("row")[f"c{k}"].alias(n) for k, n in enumerate(docs.columns)))
