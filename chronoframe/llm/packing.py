"""Operator 2: best-fit packing of token sequences (best-two-fit).

Texts are tokenised once; documents longer than a sequence are cut into pieces. Pieces are dealt evenly to groups of a
fixed size, each packed on its own, so a group wastes at most part of a few sequences. In a group: fill a sequence
greedily with the longest piece that fits the gap; when none fits, take the sequence's smallest piece out if two unpacked
pieces fill its expanded gap more tightly.

Defined results: null and empty texts have only the end token. Literals of the tokenizer's added tokens in a text are these
tokens, as the library encodes them. Repeated rows are pieces of their own. Ties between pieces of one length go by
position in the group. Extra columns are dropped, or carried by ``keep``; one called like a result of the operator makes
that result get an underscore more.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, fresh, trim

SEQUENCE = 4096
END_ID = 1
#: Pieces packed together, about.
GROUP_PIECES = 20000
#: Words that a worker remembers, at most; it forgets all of them then, which changes no result.
REMEMBERED = 800_000

#: Fixed: the published splitting pattern of the vocabulary.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[\x21-\x7e\xa1-\xff]+")


class _Words(dict):
    """Ids of a word between spaces, as little-endian bytes. Neither normalising nor splitting reaches across a space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized or " " in t.content for t in added):
            raise ValueError("added tokens that reach across spaces or are looked for in normalised text")
        self.added = tuple(t.content for t in added)  # as in the library, their literals are these tokens
        self.model, self.parts = self.whole.model, {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.sign = {b: chr(b) for b in printable}
        self.sign |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in self.sign)}

    def __missing__(self, word: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
            self.parts.clear()
        if _PLAIN.fullmatch(word) and not any(t in word for t in self.added):  # letters up to U+00FF: lower case and composed form are the same everywhere
            ids = b"".join([self.parts.get(p) or self.part(p) for p in _SPLIT.findall(word.lower())])
        else:
            ids = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes() if word else b""
        self[word] = ids
        return ids

    def part(self, piece: str) -> bytes:
        tokens = self.model.tokenize("".join([self.sign[b] for b in piece.encode()]))
        ids = self.parts[piece] = np.array([t.id for t in tokens], "<u4").tobytes()
        return ids


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def token_ids(text: str | None, path: str) -> bytes:
    """Ids of a text by the tokenizer file at ``path``, as little-endian unsigned 32-bit numbers."""
    words = _words(path)
    return b"".join(map(words.__getitem__, (text or "").replace("\n", " ").split(" ")))


RESULTS = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


def pieces(docs: DataFrame, path: str, key: str = "doc_id", keep: tuple[str, ...] = (), with_ids: bool = False, sequence: int = SEQUENCE) -> DataFrame:
    """A row per piece: its document as the struct ``row``, piece, start, length, ids_crc32, and the ids themselves on demand."""
    source = docs.select(F.struct(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate((key, *keep)))).alias("row"), F.col("text").alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(batch.num_rows):
                raw = token_ids(column[i].as_py(), path) + end
                for k, at in enumerate(range(0, len(raw), 4 * sequence)):
                    cut = raw[at : at + 4 * sequence]
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(cut)
            out = [batch.column("row").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.binary())] if with_ids else []), names=["row", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
        trim()

    return source.mapInArrow(run, f"row {dict(source.dtypes)['row']}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def pack(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each piece by best-two-fit."""
    order = np.argsort(lengths, kind="stable")[::-1]
    stacks: dict[int, list[int]] = {}
    for i in order.tolist():
        stacks.setdefault(int(lengths[i]), []).append(i)
    there = 0  # bit s: an unpacked piece of length s
    for s in stacks:
        there |= 1 << s

    def longest(most: int) -> int:
        return (there & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else -1

    def take(s: int) -> int:
        nonlocal there
        i = stacks[s].pop()
        if not stacks[s]:
            there ^= 1 << s
        return i

    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins = 0
    while there:
        content, gap = [], sequence
        while (s := longest(gap)) > 0:
            content.append((s, take(s)))
            gap -= s
        if gap and there:
            small = content[-1][0]
            room, best = gap + small, (small, 0, 0)
            a = longest(room - 1)
            while a > 0 and 2 * a >= best[0] and best[0] < room:
                b = longest(min(a, room - a))
                if b == a and len(stacks[a]) < 2:
                    b = longest(a - 1)
                if b > 0 and a + b > best[0]:
                    best = (a + b, a, b)
                a = longest(a - 1)
            if best[1]:
                _, out = content.pop()
                content += [(best[1], take(best[1])), (best[2], take(best[2]))]
                stacks.setdefault(small, []).append(out)
                there |= 1 << small
        at = 0
        for s, i in content:
            number[i], offset[i] = bins, at
            at += s
        bins += 1
    return number, offset


def pack_pieces(table: DataFrame, sequence: int = SEQUENCE, group: int = GROUP_PIECES, counted: Callable[[], int] | None = None) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces with a ``length``."""
    groups = max(1, -(-(counted or table.count)() // group))
    names = table.columns

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        number, offset = pack(rows.column("length").to_numpy(), sequence)
        number += TaskContext.get().partitionId() << 32
        rows = rows.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))
        yield from rows.to_batches(max_chunksize=10000)

    fields = ", ".join(f"`{n}` {k}" for n, k in table.dtypes)
    return table.select(names).repartition(groups).mapInArrow(run, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", keep: tuple[str, ...] = (), sequence: int = SEQUENCE) -> DataFrame:
    """Tokenise, cut and pack all documents. The tokeniser runs once; the pieces are written to the shared folder."""
    table = Scratch(docs.sparkSession, "packing").write(pieces(docs, path, key, keep, sequence=sequence), "pieces")
    own = [key, *keep]
    packed = pack_pieces(table, sequence)
    return packed.select(*(F.col("row")[f"c{k}"].alias(n) for k, n in enumerate(own)), *(F.col(c).alias(fresh(c, own)) for c in RESULTS if c in packed.columns))
