"""Operator 3: fuzzy line dedup by SimHash, pigeonhole blocks and edit similarity.

Lines are normalised (A-Z lower-cased, white space runs to one space); equal ones are one. Two lines are similar if one
minus the edit distance over the longer length is at least ``SIMILAR``; that alone decides on a pair that meets.

The SimHash of a line has blocks that share no features: a hash deals the line's features to the blocks, and each block is
the SimHash of its own ones. A changed feature thus reaches two blocks at most, the old one's and the new one's, and by
the pigeonhole principle the others agree exactly, however long the line. Features are the words of a line, or, in lines of
few words, pieces of words cut by what stands there, so that they follow the length of a line and not its number of words; the
second and each further occurrence of a feature in a line is another feature, so that repeated words and separators have enough
of them. ``SCHEMES`` says how many blocks lines have by their features, and in how many ways features are dealt to them.
Lines of at most ``SHORT`` characters meet by text segments: one is cut into one more piece than edits are allowed, so that a
piece is whole in the other, not far from its place, and every similar pair meets.
Runs of bytes longer than ``LONG_WORD`` among many words are cut by content. The same keys serve any number of
lines. The recall of the keys against all pairs by edit similarity is measured in tests/llm and stated in the README.

Keys travel as sorted blocks, one for each batch and target; a task takes one target after the other, which Spark has
brought together. With each key goes the line's shape, its length and counts of its letters, which bound edits from below: a
list falls into the parts that shapes connect, and lines that meet by chance alone go no further. Parts are called by
their lines, so that lines which meet by several keys are one list. Of each connected group one occurrence stays, the first by (doc_id, hash of the text,
line number); blank lines always stay.

Defined results: null and blank texts are returned as they are. Rows equal in doc_id and text count as one document and
keep the same lines. A document whose lines all go has an empty text, n_kept 0. Lines are compared by 64-bit hashes of
their words. Extra columns are carried along; should one be called like a count, the count gets an underscore more.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linkage import link, parts
from .shared import _LOWER, _SPACE, Scratch, chunks, fresh, mix, partitions_for, powers, trim, utf8_buffers, word_hashes

SIMILAR = 0.9
#: (features up to, blocks, ways to deal features to blocks, features that a key stands for at least) of a line's SimHash.
SCHEMES = ((26, 5, 3, 2), (80, 7, 2, 3), (None, 14, 1, 3))
#: Lines of so many words at most have pieces of words as features, others whole words.
PIECED = 24
#: Bytes of a piece are about PIECE + 3, and PIECE_MOST at most.
PIECE, PIECE_MOST = 3, 12
#: Bytes of a run without white space beyond which it is cut into several words.
LONG_WORD = 32
#: Most characters of lines that meet by segments.
SHORT = 60
#: Slots that pairs of neighbouring bytes are counted in, to rule pairs of lines out.
SLOTS = 256
#: Bytes of text whose entries a task should get: some 20 bytes have an entry.
TARGET = 1 << 25


#: Whether a byte begins a character that is no white space.
_BEGINS = np.array([b not in (0x20, *range(0x09, 0x0E)) and not 0x80 <= b < 0xC0 for b in range(256)], np.uint8)


#: Slots that a shape counts letters in, modulo 16, and the length that stands for one unknown or longer.
SHAPE_SLOTS, UNKNOWN = 12, 0xFFFF
#: For each byte, one in its slot's ten bits of two numbers; none for white space and the bytes that continue a character.
_LANES = np.zeros((2, 256), np.uint64)
for _b in np.flatnonzero(_BEGINS):
    _LANES[_LOWER[_b] % SHAPE_SLOTS // 6, _b] = np.uint64(1) << np.uint64(10 * (_LOWER[_b] % SHAPE_SLOTS % 6))


def normalise(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _long_cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places within long runs where a word ends by what stands there: after bytes whose hash is a multiple of eight."""
    out = [np.zeros(0, np.int64)]
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        x = data[a:b].astype(np.uint64)
        h = mix(x[2:-1] + (x[1:-2] << np.uint64(8)) + (x[:-3] << np.uint64(16)))
        out.append(np.flatnonzero((h & np.uint64(7)) == 0) + a + 3)
    return np.concatenate(out)


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number in the text, start, end) of every line of consecutive texts."""
    feeds = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((offsets[:-1], feeds + 1)))
    first = np.arange(len(offsets) - 1) + np.searchsorted(feeds, offsets[:-1])
    count = np.diff(np.append(first, len(start)))
    text = np.repeat(np.arange(len(offsets) - 1), count)
    return text, np.arange(len(start)) - first[text], start, np.append(start[1:], len(data))


def line_words(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of words, place of each line's first word and one behind the last, hash of each line's words)."""
    words, at = word_hashes(data, np.append(start, len(data)))
    up, down = powers(len(words) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])))
    key = mix((total[at[1:]] - total[at[:-1]]) * down[at[:-1]] + np.diff(at).astype(np.uint64))
    return words, at, key


def block_keys(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the line, key) by the blocks of SimHashes; line i has the features words[at[i]:at[i + 1]]."""
    count = np.diff(at)
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    low = 0
    for number, (high, blocks, ways, least) in enumerate(SCHEMES):
        # The longer of two similar lines may belong to the scheme above; it meets the other in both.
        line = np.flatnonzero((count >= low) & (count > 0) & (count <= (high or np.inf) / SIMILAR + 1))
        low = high
        if not len(line):
            continue
        lead = np.cumsum(count[line]) - count[line]
        place = np.repeat(at[line] - lead, count[line]) + np.arange(count[line].sum())
        owner = np.repeat(np.arange(len(line), dtype=np.uint64), count[line])
        # One sort brings the equal features of a line together: the line's number above 40 bits of the feature's hash.
        pairs = np.sort((owner << np.uint64(40)) | (words[place] >> np.uint64(24)))
        begin = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        again = (np.arange(len(pairs)) - np.repeat(begin, np.diff(np.append(begin, len(pairs))))).astype(np.uint64)
        owner, feature = pairs >> np.uint64(40), mix((pairs & np.uint64((1 << 40) - 1)) + (again << np.uint64(40)))
        for way in range(ways):
            group = (owner * np.uint64(blocks) + mix(feature + np.uint64(way + 1)) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            block = group[order]
            begin = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            sizes = np.diff(np.append(begin, len(block)))
            sims = _majority(feature[order], begin, sizes)
            enough = sizes >= least
            salt = ((number * 8 + way) << 8) + block[begin[enough]] % blocks + 1
            rows.append(line[block[begin[enough]] // blocks])
            keys.append(mix(sims[enough] ^ mix(salt.astype(np.uint64))))
    return np.concatenate(rows), np.concatenate(keys)


def pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, place of each line's first piece and one behind the last): words of lines cut by content.

    A word is cut behind three bytes whose hash is a multiple of PIECE, and where PIECE_MOST bytes have had no cut.
    """
    size = end - start
    lead = np.cumsum(size) - size
    flat = _LOWER[data[np.repeat(start - lead, size) + np.arange(size.sum())]]
    n = len(flat)
    blank = _SPACE[flat]
    first = np.zeros(n + 1, bool)
    first[lead] = True
    first[1:n] |= blank[1:] != blank[:-1]
    first[n] = True
    wide = flat.astype(np.uint64)
    h = np.ones(n, np.uint64)
    h[3:] = mix(wide[2:-1] + (wide[1:-2] << np.uint64(8)) + (wide[:-3] << np.uint64(16))) % np.uint64(PIECE)
    word = np.flatnonzero(first)
    inside = np.arange(n) - np.repeat(word[:-1], np.diff(word))
    first[:n] |= (h == 0) & (inside >= 3)
    edge = np.flatnonzero(first)
    inside = np.arange(n) - np.repeat(edge[:-1], np.diff(edge))
    first[:n] |= inside % PIECE_MOST == 0
    edge = np.flatnonzero(first)
    some = ~blank[edge[:-1]]
    a, b = edge[:-1][some], edge[1:][some]
    hashes = np.zeros(len(a), np.uint64)
    for k in range(PIECE_MOST):
        there = a + k < b
        hashes[there] = mix(hashes[there] * np.uint64(31) + wide[a[there] + k] + np.uint64(1))
    return hashes, np.searchsorted(a, np.append(lead, n))


def _majority(hashes: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of each run of hashes: the bits that more than half of them have."""
    out = np.empty(len(begin), np.uint64)
    step = 1 << 13  # runs at a time, so that the counters stay in a cache
    for i in range(0, len(begin), step):
        a, n = begin[i : i + step], sizes[i : i + step]
        # Eight one-byte counters go into each addition; pieces of 255 words cannot overflow them.
        lanes = np.unpackbits(hashes[a[0] : a[-1] + n[-1]].view(np.uint8)).view(np.uint64).reshape(-1, 8)
        pieces = -(-n // 255)
        if pieces.max() > 1:
            lead = np.cumsum(pieces) - pieces
            starts = np.repeat(a - a[0], pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(lead, pieces))
            sums = np.add.reduceat(np.add.reduceat(lanes, starts, axis=0).view(np.uint8), lead, axis=0, dtype=np.int32)
            half = (n // 2)[:, None]
        else:
            sums = np.add.reduceat(lanes, a - a[0], axis=0).view(np.uint8)
            half = (n // 2).astype(np.uint8)[:, None]
        out[i : i + step] = np.packbits(sums > half, axis=1).view(np.uint64)[:, 0]
    return out


def most_edits(longer: int) -> int:
    return int((1 - SIMILAR) * longer + 1e-9)


def least_length(longer: int) -> int:
    """Of a line similar to one of ``longer`` characters that is no longer itself."""
    return longer - most_edits(longer)


def segments(n: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces that a line of n characters is cut into: one more than it may have edits."""
    longer = n
    while least_length(longer + 1) <= n:
        longer += 1
    edges = np.linspace(0, n, most_edits(longer) + 2).astype(int).tolist()
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


@cache
def segment_places(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, salt) of all pieces by which a line of n characters meets others of its length or less.

    The salt tells the length and the piece they stand for. If the pieces before one need an edit each, and those behind
    it too, it lies no farther from its place than there are pieces before it, or behind it when counted from the end.
    """
    out = set()
    for m in range(max(1, least_length(n)), n + 1):
        cut = segments(m)
        for i, (start, length) in enumerate(cut):
            behind, shift = len(cut) - 1 - i, n - m
            for at in range(max(0, start - i, start + shift - behind), min(n - length, start + i, start + shift + behind) + 1):
                out.add((at, length, m * 256 + i))
    for i, (start, length) in enumerate(segments(n)):
        out.add((start, length, n * 256 + i))
    return tuple(np.array(x) for x in zip(*sorted(out), strict=True))


def segment_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the line, key) by the segments of lines of at most SHORT characters."""
    lengths = np.array([len(x) for x in lines], np.int64)
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    up, down = powers(len(code) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(code + np.uint64(1)) * up[: len(code)])))
    offsets = np.cumsum(lengths) - lengths
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for n in np.unique(lengths[lengths <= SHORT]).tolist():
        row = np.flatnonzero(lengths == n)
        start, length, salt = segment_places(n)
        first = offsets[row][:, None] + start
        h = mix((total[first + length] - total[first]) * down[first]) ^ mix(salt.astype(np.uint64) + np.uint64(1))
        rows.append(np.repeat(row, len(start)))
        keys.append(h.reshape(-1))
    return np.concatenate(rows), np.concatenate(keys)


def byte_counts(lines: list[bytes]) -> np.ndarray:
    """A row a line: how many of its bytes fall in each of 64 slots."""
    data = np.frombuffer(b"".join(lines), np.uint8)
    owner = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    return np.bincount(owner * 64 + (data & 63), minlength=len(lines) * 64).reshape(-1, 64).astype(np.int32)


def pair_counts(lines: list[bytes]) -> np.ndarray:
    """A row a line: how many of its pairs of neighbouring bytes fall in each of SLOTS slots."""
    data = np.frombuffer(b"".join(lines), np.uint8)
    lengths = np.array([len(x) for x in lines], np.int64)
    owner = np.repeat(np.arange(len(lines)), lengths)
    inside = owner[1:] == owner[:-1]
    slot = (data[:-1].astype(np.int64) * 31 + data[1:]) % SLOTS
    return np.bincount((owner[1:] * SLOTS + slot)[inside], minlength=len(lines) * SLOTS).reshape(-1, SLOTS).astype(np.int32)


def shapes(data: np.ndarray, start: np.ndarray, chars: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A number a line: its length in 16 bits, above them the counts of its characters' first bytes in slots, four bits each.

    A count beyond ten bits runs into the next, in lines so long that counts rule nothing out. Texts that are not UTF-8
    have other characters than bytes tell: their lines are of unknown length.
    """
    size = np.minimum(chars, UNKNOWN)
    try:
        data.tobytes().decode()
    except UnicodeDecodeError:
        size = np.full_like(size, UNKNOWN)
    out = size.astype(np.uint64)
    edge = np.append(start, len(data))
    for half, lane in enumerate(_LANES):
        sums = np.zeros(len(start), np.uint64)
        for i, j in chunks(edge, 1 << 16):
            if edge[j] > edge[i]:  # an empty last line is none's place
                sums[i:j] = np.add.reduceat(np.append(lane[data[edge[i] : edge[j]]], np.uint64(0)), edge[i:j] - edge[i])
        total = sums[rows]
        for k in range(6):
            out |= ((total >> np.uint64(10 * k)) & np.uint64(15)) << np.uint64(16 + 4 * (6 * half + k))
    return out


def shapes_allow(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether lines of these shapes may be similar by their counts: an edit changes two of them by one at most."""
    size = np.maximum(p & np.uint64(UNKNOWN), q & np.uint64(UNKNOWN)).astype(np.int64)
    nibbles, sixteen, one = np.uint64(0x0F0F0F0F0F0F), np.uint64(0x101010101010), np.uint64(0x0101010101010101)
    apart = np.zeros(len(p), np.int64)
    for at in (16, 20):
        x, y = (p >> np.uint64(at)) & nibbles, (q >> np.uint64(at)) & nibbles
        d = ((x | sixteen) - y) & nibbles
        far = ((d >> np.uint64(3)) & one) * np.uint64(15)  # differences of eight and more are less the other way round
        d = (d & ~far) | ((sixteen - d) & nibbles & far)
        apart += ((d * one) >> np.uint64(56)).astype(np.int64)
    return apart <= 2 * ((1 - SIMILAR) * size + 1e-9).astype(np.int64)


def parts_of(group: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """The part of each row of groups sorted by length, by the number of a row in it: lines that shapes allow to be similar are in one."""
    size = (shape & np.uint64(UNKNOWN)).astype(np.int64)
    low = size - ((1 - SIMILAR) * size + 1e-9).astype(np.int64)
    return parts(group, lambda x, y: low[y] <= size[x], lambda x, y: shapes_allow(shape[x], shape[y]), size == UNKNOWN)


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Edit distance by bit-parallel columns, after the common ends are taken off; if it is over ``most``, any number over it."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return max(len(a), len(b)) - n
    x, y = np.frombuffer(a[:n].encode("utf-32-le"), np.uint32), np.frombuffer(b[:n].encode("utf-32-le"), np.uint32)
    head = int((x != y).argmax())
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    if n and a[-n:] != b[-n:]:
        x, y = np.frombuffer(a[-n:].encode("utf-32-le"), np.uint32), np.frombuffer(b[-n:].encode("utf-32-le"), np.uint32)
        tail = int((x != y)[::-1].argmax())
    else:
        tail = n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for c in set(a):
        bits = np.frombuffer(a.encode("utf-32-le"), np.uint32) == ord(c)
        where[c] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b, strict=True):
        equal = where.get(c, 0)
        v = equal | down
        h = (((equal & up) + up) ^ up) | equal
        plus, minus = down | (full & ~(h | up)), up & h
        score += bool(plus & top) - bool(minus & top)
        if most is not None and score - left > most:
            return score - left
        plus, minus = ((plus << 1) | 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(v | plus)), plus & v
    return score


#: (words left out of one line, of the other) tried where two lines differ, fewest first.
_SKIPS = [(d - e, e) for d in range(1, 6) for e in sorted(range(d + 1), key=lambda e: abs(d - 2 * e))]


def aligned(p: list[str], q: list[str], most: int) -> int:
    """An upper bound of the edit distance of two lines of these words: that of an alignment found in one pass."""
    i = j = cost = 0
    n, m = len(p), len(q)
    while i < n and j < m:
        if p[i] == q[j]:
            i += 1
            j += 1
            continue
        for x, y in _SKIPS:
            if i + x < n and j + y < m and p[i + x] == q[j + y]:
                break
        else:
            x = y = 1
        cost += max(sum(map(len, p[i : i + x])) + x, sum(map(len, q[j : j + y])) + y) - (x > 0 and y > 0)
        if cost > most:
            return cost
        i += x
        j += y
    return cost + max(sum(map(len, p[i:])) + n - i, sum(map(len, q[j:])) + m - j)


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``; bounds that settle it are tried before the distance itself."""
    if abs(len(a) - len(b)) > most:
        return False
    return aligned(a.split(" "), b.split(" "), most) <= most or edit_distance(a, b, most) <= most


class Lines:
    """Some lines, and what rules pairs of them out: an edit of a character changes its bytes and one pair of bytes more, on either side, at most."""

    def __init__(self, lines: list[str]):
        raw = [x.encode() for x in lines]
        self.lines, self.words = lines, {}
        code = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
        used = np.flatnonzero(np.bincount(code)) if len(code) else code
        # Numbers from one in as few bytes as they need; 0 is what stands beyond a line.
        number = np.zeros(int(used[-1]) + 1 if len(used) else 0, np.min_scalar_type(len(used) + 1))
        number[used] = np.arange(1, len(used) + 1)
        self.code = number[code]
        self.chars = np.array([len(x) for x in lines], np.int64)
        self.start = np.cumsum(self.chars) - self.chars
        self.wide = np.where(self.chars == np.array([len(x) for x in raw], np.int64), 2, 5)
        self.bytes = byte_counts(raw)
        self.size = self.bytes.sum(axis=1)
        self.counts = pair_counts(raw)
        self.total = self.counts.sum(axis=1)

    def may(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs (i, j) lengths and counts do not rule out."""
        longer = np.maximum(self.chars[i], self.chars[j])
        most = ((1 - SIMILAR) * longer + 1e-9).astype(np.int64)
        out = np.abs(self.chars[i] - self.chars[j]) <= most
        for at in range(0, len(i), 4096):
            some = np.flatnonzero(out[at : at + 4096]) + at
            x, y = i[some], j[some]
            common = np.minimum(self.bytes[x], self.bytes[y]).sum(axis=1, dtype=np.int64)
            out[some] = np.maximum(self.size[x], self.size[y]) - common <= (np.maximum(self.wide[x], self.wide[y]) - 1) * most[some]
            some = some[out[some]]
            x, y = i[some], j[some]
            common = np.minimum(self.counts[x], self.counts[y]).sum(axis=1, dtype=np.int64)
            out[some] = np.maximum(self.total[x], self.total[y]) - common <= np.maximum(self.wide[x], self.wide[y]) * most[some]
        return out

    def similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs (i, j) are similar."""
        out = self.may(i, j)
        some = np.flatnonzero(out)
        i, j = i[some], j[some]
        swap = self.chars[i] > self.chars[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        most = ((1 - SIMILAR) * self.chars[j] + 1e-9).astype(np.int64)
        # Near copies are settled by an alignment of their words; the rest takes the distance itself.
        hard = []
        for k, (x, y, d) in enumerate(zip(i.tolist(), j.tolist(), most.tolist(), strict=True)):
            if aligned(self._words(x), self._words(y), d) > d:
                hard.append(k)
        self.words.clear()
        hard = np.array(hard, np.int64)
        i, j = i[hard], j[hard]
        out[some[hard]] = within_many(self.code, self.start[i], self.chars[i], self.start[j], self.chars[j], most[hard], lambda k: (self.lines[i[k]], self.lines[j[k]]))
        return out

    def _words(self, i: int) -> list[str]:
        if i not in self.words:
            self.words[i] = self.lines[i].split(" ")
        return self.words[i]


#: Numbers in the tables of characters' places that pairs are compared by at a time, and columns between looks at which pairs are settled.
CELLS, COLUMNS = 1 << 21, 16
#: So many pairs, and twice as many more for each word of diagonals, pay for a batch; fewer are compared one by one.
FEW_ROWS = 5


def _spread(code: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """A row for each piece of ``code``, with zeros behind it."""
    at = np.arange(width)
    return np.where(at < size[:, None], code[np.minimum(start[:, None] + at, len(code) - 1)], code.dtype.type(0))


def _portions(cells: np.ndarray):
    """Slices of rows of ascending widths that have at most CELLS cells, one row at least."""
    at = 0
    while at < len(cells):
        # The widest is the last, so a portion that fits by its last row fits.
        fits = np.arange(1, len(cells) - at + 1) * cells[at:] <= CELLS
        n = max(1, int(fits.argmin()) if not fits.all() else len(fits))
        yield slice(at, at + n)
        at += n


def within_many(code, a, m, b, n, most, pair) -> np.ndarray:
    """For each pair of pieces of ``code``, a of m characters and b of n >= m, whether their edit distance is at most ``most``.

    ``pair`` gives the two lines of a pair: where few pairs need many words of diagonals, one by one is the cheaper way.
    """
    out = n - m <= most
    # The rest is settled where one is empty, or where as many edits are allowed as the longer has characters.
    hard = np.flatnonzero(out & (n > most))
    out[hard[m[hard] == 0]] = False
    hard = hard[m[hard] > 0]
    words = most[hard] // 64 + 1
    # Beyond four words, sizes are rounded up, so that more pairs share one: a wider band is as exact.
    step = np.maximum(1, 1 << np.maximum(0, np.frexp(words)[1] - 3))
    words = -(-words // step) * step
    letters = int(code.max()) + 1 if len(code) else 1
    for w in np.unique(words).tolist():
        k = hard[words == w]
        if len(k) < FEW_ROWS * (1 + 2 * w):
            for x in k.tolist():
                out[x] = _banded_one(*pair(x), int(most[x]))
            continue
        k = k[np.argsort(n[k], kind="stable")]
        for rows in _portions((n[k] // 64 + w + 2) * letters):
            x = k[rows]
            out[x] = _banded(code, letters, a[x], m[x], b[x], n[x], most[x], w)
    return out


def _banded_one(a: str, b: str, most: int) -> bool:
    """``_banded`` for two lines, a no longer than b, in integers of as many bits as there are diagonals."""
    delta = len(b) - len(a)
    own = (most - delta) // 2
    top = delta + own
    mask = (1 << most + 1) - 1
    letters = np.frombuffer(a.encode("utf-32-le"), np.uint32)
    where = {c: int.from_bytes(np.packbits(letters == ord(c), bitorder="little").tobytes(), "little") << top + 1 for c in set(a)}
    up, down, score = mask & ~((1 << top) - 1), 0, delta
    for j, c in enumerate(b, 1):
        same = (where.get(c, 0) >> j) & mask
        diagonal = ((((same & up) + up) ^ up) | same | down) & mask
        if j > delta and not (diagonal >> own) & 1:
            score += 1
            if score > most:
                return False
        plus, minus, step = down | (mask & ~(diagonal | up)), diagonal & up, diagonal >> 1
        up, down = minus | (mask & ~(step | plus)), step & plus
    return True


def _banded(code, letters: int, a, m, b, n, most, words: int) -> np.ndarray:
    """Edit distances held against ``most`` by bit-parallel columns of the diagonals that a path of so few edits can reach.

    Bit t of a column j is the row j - top + t; the diagonal that ends at both ends is ``own``. What goes up along it is the
    distance, which never falls, so a pair is settled as soon as it is over ``most``.
    """
    own = (most - (n - m)) // 2
    top = n - m + own
    width = int(n.max())
    # Where each character stands in each short line, a bit a place: row i stands at top + i, so that the band of column j begins at j.
    places = np.zeros((width // 64 + words + 2, len(m) * letters), np.uint64)
    lead = np.cumsum(m) - m
    r = np.repeat(np.arange(len(m)), m)
    c = np.arange(len(r)) - lead[r]
    at = top[r] + 1 + c
    np.add.at(places.reshape(-1), (at >> 6) * (len(m) * letters) + r * letters + code[a[r] + c], np.uint64(1) << (at & 63).astype(np.uint64))
    long = np.ascontiguousarray(_spread(code, b, n, width).T)  # beyond its end a line equals nothing: no place is of character 0
    base = np.arange(len(m)) * letters
    bit = np.clip(top[:, None] - 64 * np.arange(words), 0, 64).astype(np.uint64)
    one, ones = np.uint64(1), ~np.uint64(0)
    up = np.where(bit < 64, ones << np.minimum(bit, np.uint64(63)), np.uint64(0)).T.copy()
    down = np.zeros_like(up)
    score, delta = n - m, n - m
    shift, word = (own % 64).astype(np.uint64), own // 64
    out, row = np.zeros(len(m), bool), np.arange(len(m))
    done = 0  # columns that ``long`` no longer has
    for j in range(1, width + 1):
        at = base + long[j - 1 - done]
        low, by = j >> 6, np.uint64(j & 63)
        same = [places[low + w].take(at) for w in range(words + bool(by))]
        if by:
            same = [(x >> by) | (y << np.uint64(64 - int(by))) for x, y in zip(same[:-1], same[1:], strict=True)]
        diagonal = np.empty_like(up)
        carry = None
        for w in range(words):
            x = same[w] & up[w]
            total = x + up[w]
            if w < words - 1:
                over = total < x
            if carry is not None:
                total = total + carry
                if w < words - 1:
                    over |= total < carry
            if w < words - 1:
                carry = over.astype(np.uint64)
            diagonal[w] = (total ^ up[w]) | same[w] | down[w]
        plus, minus = down | ~(diagonal | up), diagonal & up
        step = diagonal >> one
        if words > 1:
            step[:-1] |= diagonal[1:] << np.uint64(63)
        up, down = minus | ~(step | plus), step & plus
        here = diagonal[0] if words == 1 else diagonal[word, np.arange(len(word))]
        score = score + ((j > delta) & (j <= n) & ((here >> shift) & one == 0))
        if j % COLUMNS == 0 or j == width:
            live = (score <= most) & (n > j)
            if live.sum() * 4 <= len(live) * 3:
                out[row[(score <= most) & (n <= j)]] = True
                if not live.any():
                    break
                base, row, score, most, delta, n, shift, word = (x[live] for x in (base, row, score, most, delta, n, shift, word))
                up, down, long, done = up[:, live], down[:, live], long[j - done :, live], j
    return out


#: Pairs that are compared at a time, and bytes of their lines: enough that a column of a batch has many rows.
PAIRS, PAIR_BYTES = 1 << 14, 1 << 24


def _similar_pairs(batches):
    for batch in batches:
        size = np.cumsum(sum(pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in "xy")) if batch.num_rows else np.zeros(0, np.int64)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(size, (size[at - 1] if at else 0) + PAIR_BYTES, side="right"))
            some = batch.slice(at, min(max(1, end - at), PAIRS))
            at += some.num_rows
            ids, place = np.unique(np.concatenate([some.column(c).to_numpy() for c in "ab"]), return_index=True)
            bodies = pa.concat_arrays([some.column(c) for c in "xy"]).take(pa.array(place)).to_pylist()
            held = Lines(bodies)
            mask = pa.array(held.similar(*(np.searchsorted(ids, some.column(c).to_numpy()) for c in "ab")), pa.bool_())
            yield pa.RecordBatch.from_arrays([some.column("a").filter(mask), some.column("b").filter(mask)], names=["a", "b"])
    trim()


#: Lines of a list that are compared with so many others at a time.
BLOCK = 256


def _pairs_in(table: pa.Table, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (x, y) of one group, of different components, whose lengths allow that they are similar; own and other block where they differ."""
    comp, own, i, j = (table.column(c).to_numpy() for c in ("comp", "own", "i", "j"))
    chars = pc.utf8_length(table.column("body")).to_numpy()
    size = np.diff(edge)
    group = np.repeat(np.arange(len(size)), size)
    one = i == j
    xs, ys = [], []
    for d in range(1, int(size.max()) if len(size) else 0):
        x = np.flatnonzero(group[:-d] == group[d:])
        y = x + d
        longer = np.maximum(chars[x], chars[y])
        may = (comp[x] != comp[y]) & (one[x] | (own[x] != own[y])) & (np.abs(chars[x] - chars[y]) <= (1 - SIMILAR) * longer + 1e-9)
        xs.append(x[may])
        ys.append(y[may])
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.zeros(0, np.int64),) * 2


def _similar_in_lists(batches):
    """Links (a, b) within the groups (key, i, j): rows of block i with those of block j, from sorted rows."""

    def edges(table: pa.Table) -> np.ndarray:
        k, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        return np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True])))

    def links(table: pa.Table, edge: np.ndarray):
        x, y = _pairs_in(table, edge)
        ids = table.column("id").to_numpy()
        lines, place, of = np.unique(ids, return_index=True, return_inverse=True)
        low, high = np.minimum(of[x], of[y]), np.maximum(of[x], of[y])
        low, high = np.divmod(np.unique(low * len(lines) + high), max(1, len(lines)))
        some, rows = np.unique(np.concatenate((low, high)), return_inverse=True)
        held = Lines(table.column("body").take(pa.array(place[some])).to_pylist())
        mask = held.similar(*np.split(rows, 2)) if len(some) else np.zeros(0, bool)
        found = lines[low[mask]], lines[high[mask]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 32 * BLOCK):
            held.append(batch.slice(at, 32 * BLOCK))
            table = pa.Table.from_batches(held)
            edge = edges(table)
            if len(edge) > 2:  # the last group may go on
                yield links(table.slice(0, edge[-2]), edge[:-1])
            held = table.slice(edge[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield links(table, edges(table))
    trim()


def in_lists(lists: DataFrame, bodies: DataFrame) -> DataFrame:
    """Links (a, b) across components within lists (key, id, comp, length), by blocks of each list: a long list is several tasks' work."""
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    with_body = lists.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(bodies.select(F.col("line").alias("id"), "body"), "id")
    dealt = with_body.select("key", "id", "comp", "body", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "comp", (F.col("block") <= F.col("other")).alias("own"), "body")
    sorted_rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sorted_rows.mapInArrow(_similar_in_lists, "a long, b long").distinct()


def _texts(docs: DataFrame, key: str) -> DataFrame:
    """(id, th, text) of the texts there are; th tells the texts of one id apart."""
    return docs.where(F.col("text").isNotNull()).select(F.col(key).alias("id"), F.xxhash64("text").alias("th"), F.col("text").alias("text"))


def occurrences(docs: DataFrame, key: str) -> DataFrame:
    """(id, th, line, number) of every line that is not blank."""
    source = _texts(docs, key)
    names = ["id", "th", "number", "line"]

    def run(batches):
        for batch in batches:
            data, off = utf8_buffers(batch.column("text"))
            for i, j in chunks(off):
                some = data[off[i] : off[j]]
                text, number, start, _ = lines_of(some, off[i : j + 1] - off[i])
                _, at, line = line_words(some, start)
                full = np.flatnonzero(at[1:] > at[:-1])
                taken = batch.select(["id", "th"]).take(pa.array(text[full] + i))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(number[full], pa.int32()), pa.array(line[full].view(np.int64))], names=names)
        trim()

    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, th long, number int, line long")


class Seen:
    """Lines that a task has had, up to a bound; those beyond it are entered again, which changes nothing."""

    def __init__(self, most: int = 1 << 18):
        self.most, self.old, self.new = most, np.zeros(0, np.uint64), []

    def first(self, lines: np.ndarray) -> np.ndarray:
        """Places of lines that were not here before."""
        at = np.sort(np.unique(lines, return_index=True)[1])
        if len(self.old):
            near = np.minimum(np.searchsorted(self.old, lines[at]), len(self.old) - 1)
            at = at[self.old[near] != lines[at]]
        if len(self.old) < self.most:
            self.new.append(lines[at])
            if sum(map(len, self.new)) > 1 << 14:
                self.old = np.sort(np.concatenate((self.old, *self.new)))
                self.new = []
        return at


def entries(data: np.ndarray, offsets: np.ndarray, seen: Seen) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, shape) of all ways in which lines meet."""
    _, _, start, end = lines_of(data, offsets)
    return entries_of(data, start, end, *line_words(data, start), seen)


def entries_of(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, at: np.ndarray, line: np.ndarray, seen: Seen) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``entries`` of lines whose words are known."""
    fresh_lines = seen.first(line)
    fresh_lines = fresh_lines[at[fresh_lines + 1] > at[fresh_lines]]
    if not len(fresh_lines):
        return (np.zeros(0, np.uint64),) * 3
    size = end[fresh_lines] - start[fresh_lines]
    count = at[fresh_lines + 1] - at[fresh_lines]
    # Runs far longer than words are: cut by content, on a copy with a space at each cut.
    sparse = np.flatnonzero((size > LONG_WORD * count) & (count > PIECED))
    if len(sparse):
        words, at2 = _cut_words(data, start[fresh_lines], end[fresh_lines], words, at[fresh_lines], count, sparse)
    else:
        lead = np.cumsum(count) - count
        words = words[np.repeat(at[fresh_lines] - lead, count) + np.arange(count.sum())]
        at2 = np.append(lead, count.sum())
    # Characters of the normalised line: bytes that begin one and are no white space, and a space between words.
    chars = np.add.reduceat(np.append(_BEGINS[data], np.uint8(0)), start, dtype=np.int32)[fresh_lines] + count - 1
    # Shorter lines are similar to none that is too long to meet by segments.
    long = chars >= least_length(SHORT + 1)
    found = []
    whole = np.flatnonzero(long & (count > PIECED))
    if len(whole):
        sizes = np.diff(at2)[whole]
        own = words[np.repeat(at2[whole] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        r, k = block_keys(own, np.append(0, np.cumsum(sizes)))
        found.append((whole[r], k))
    few_words = np.flatnonzero(long & (count <= PIECED / SIMILAR + 1))
    cost = np.cumsum(size[few_words]) if len(few_words) else np.zeros(0, np.int64)
    for some in np.split(few_words, np.searchsorted(cost, np.arange(1 << 19, cost[-1], 1 << 19))) if len(cost) else ():
        if len(some):
            r, k = block_keys(*pieces(data, start[fresh_lines[some]], end[fresh_lines[some]]))
            found.append((some[r], mix(k + np.uint64(1))))
    row, key = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    brief = np.flatnonzero(chars <= SHORT)
    raw = [data[a:b].tobytes() for a, b in zip(start[fresh_lines[brief]].tolist(), end[fresh_lines[brief]].tolist(), strict=True)]
    normal = [normalise(x).decode("utf-8", "replace") for x in raw]
    few = [k for k, x in enumerate(normal) if len(x) <= SHORT]
    row2, key2 = segment_keys([normal[k] for k in few])
    row = np.concatenate((row, brief[np.array(few, np.int64)][row2] if few else row2))
    return np.concatenate((key, key2)), line[fresh_lines][row], shapes(data, start, chars, fresh_lines)[row]


def _cut_words(data, start, end, words, at, count, sparse) -> tuple[np.ndarray, np.ndarray]:
    """Words of lines, those of ``sparse`` lines hashed anew with long runs cut by content."""
    parts = [words[a : a + n] for a, n in zip(at.tolist(), count.tolist(), strict=True)]
    for i in sparse.tolist():
        raw = data[start[i] : end[i]]
        gap = np.isin(raw, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
        bounds = np.flatnonzero(np.diff(np.concatenate(([1], gap, [1])).astype(np.int8)))
        runs = bounds.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] > LONG_WORD]
        cut = np.insert(raw, _long_cuts(raw, runs[:, 0], runs[:, 1]), 0x20)
        parts[i] = word_hashes(cut, np.array([0, len(cut)]))[0]
    sizes = np.array([len(x) for x in parts])
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))


#: Bytes of a key that travel; lines that agree in so many meet, and are held against each other like any others.
KEY_BYTES = 6


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as steps from one to the next, all their first bytes before the second ones: the first are mostly zero."""
    steps = np.diff(keys >> np.uint64(64 - 8 * KEY_BYTES), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BYTES :].T).tobytes()


def _unpacked_keys(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(KEY_BYTES, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, 8 - KEY_BYTES :] = planes.T
    return np.cumsum(wide.view(">u8")[:, 0].astype(np.uint64)) << np.uint64(64 - 8 * KEY_BYTES)


#: Occurrences of lines that a row carries.
PLACES = 1 << 14


def _blocks(docs: DataFrame, key: str, targets: int) -> DataFrame:
    """(target, keys, lines, shapes): entries sorted by key, a row for each target that a batch has entries for.

    Besides, without keys, (target, lines, ids, ths, numbers) of the occurrences of lines, so that texts are read and cut into words once.
    """
    source = _texts(docs, key)
    names = ["target", "keys", "lines", "shapes", "ids", "ths", "numbers"]
    kind = dict(source.dtypes)["id"]

    def run(batches):
        seen, codec = Seen(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, off = utf8_buffers(batch.column("text"))
            ids, ths = batch.column("id"), batch.column("th").to_numpy()
            got, places = [], []
            for i, j in chunks(off, 1 << 21):
                some = data[off[i] : off[j]]
                text, number, start, end = lines_of(some, off[i : j + 1] - off[i])
                words, at, line = line_words(some, start)
                full = np.flatnonzero(at[1:] > at[:-1])
                places.append((line[full], text[full] + i, number[full].astype(np.int32)))
                got.append(entries_of(some, start, end, words, at, line, seen))
            if not got:
                continue
            keys, lines, shape = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.argsort(keys)
            keys, lines, shape = keys[order], lines[order], shape[order]
            target = ((keys >> np.uint64(32)) * np.uint64(targets)) >> np.uint64(32)
            edge = np.searchsorted(target, np.arange(targets + 1))
            some = np.flatnonzero(np.diff(edge))
            packed = [codec.compress(_packed_keys(keys[edge[t] : edge[t + 1]])) for t in some.tolist()]
            raw = [[x[edge[t] : edge[t + 1]].tobytes() for t in some.tolist()] for x in (lines, shape)]
            none = pa.nulls(len(some), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(x, pa.binary()) for x in (packed, *raw)), pa.nulls(len(some), pa.list_(ids.type)), none, none], names=names)
            line, text, number = (np.concatenate(x) for x in zip(*places, strict=True))
            cuts = np.append(np.arange(0, len(line), PLACES), len(line))
            pairs = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            if pairs:
                raw = [[x[a:b].tobytes() for a, b in pairs] for x in (line, ths[text], number)]
                held, none = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids.take(pa.array(text))), pa.nulls(len(pairs), pa.binary())
                to = pa.array([int(line[a] % np.uint64(targets)) for a, _ in pairs], pa.int32())
                yield pa.RecordBatch.from_arrays([to, none, pa.array(raw[0], pa.binary()), none, held, *(pa.array(x, pa.binary()) for x in raw[1:])], names=names)
        trim()

    return source.mapInArrow(run, f"target int, keys binary, lines binary, shapes binary, ids array<{kind}>, ths binary, numbers binary")


def _groups(keys: np.ndarray, lines: np.ndarray, shape: np.ndarray | None = None) -> pa.RecordBatch | None:
    """(key, id, lead, length) of the entries, each once, whose keys have several lines, by the parts that shapes leave of them."""
    order = np.argsort(keys)
    keys, lines = keys[order], lines[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    several = np.minimum.reduceat(lines, begin) < np.maximum.reduceat(lines, begin)
    mask = np.repeat(several, np.diff(np.append(begin, len(keys))))
    keys, lines = keys[mask], lines[mask].view(np.int64)
    if not len(keys):
        return None
    shape = shape[order][mask] if shape is not None else np.full(len(keys), UNKNOWN, np.uint64)
    order = np.lexsort((lines, shape & np.uint64(UNKNOWN), keys))
    keys, lines, shape = keys[order], lines[order], shape[order]
    once = np.concatenate(([True], (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])))
    keys, lines, shape = keys[once], lines[once], shape[once]
    part = parts_of(keys, shape)
    order = np.lexsort((lines, part))
    part, lines = part[order], lines[order]
    # A text that is not UTF-8 may have lent its line another length: the same line is in a part once.
    once = np.concatenate(([True], (part[1:] != part[:-1]) | (lines[1:] != lines[:-1])))
    part, lines = part[once], lines[once]
    begin = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    length = np.diff(np.append(begin, len(part)))
    name = mix(np.add.reduceat(mix(lines.view(np.uint64)), begin) + length.astype(np.uint64)).view(np.int64)
    lead, of, name = np.repeat(lines[begin], length), np.repeat(length, length), np.repeat(name, length)
    keep = (of > 2) | ((of == 2) & (lines != lead))
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (name, lines, lead, of)], names=["key", "id", "lead", "length"]) if keep.any() else None


def _meet(batches):
    """Groups of the blocks of a task, sorted by target: one target's entries are held at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    now = None
    for batch in batches:
        for target, *raw in zip(batch.column("target").to_pylist(), *(batch.column(c) for c in ("keys", "lines", "shapes") if c in batch.schema.names), strict=True):
            if target != now and held:
                found = _groups(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
                if found is not None:
                    yield found
            now = target
            held.append(tuple(np.frombuffer(x.as_buffer(), np.uint64) for x in raw))
    if held:
        found = _groups(*(np.concatenate(x) for x in zip(*held, strict=True)))
        if found is not None:
            yield found
    trim()


def _meet_packed(batches):
    """``_meet`` of blocks whose keys are packed, and (doc, th, number, line) of the occurrences among them."""
    codec = zstandard.ZstdDecompressor()
    names = ["key", "id", "lead", "length", "doc", "th", "number", "line"]
    places: list[pa.RecordBatch] = []
    kind: list[pa.DataType] = []

    def unpacked():
        for batch in batches:
            kind[:] = [batch.schema.field("ids").type.value_type]
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                none = pc.is_null(some.column("keys"))
                for ids, *raw in zip(*(some.filter(none).column(c) for c in ("ids", "ths", "numbers", "lines")), strict=True):
                    own = [ids.values, *(pa.array(np.frombuffer(x.as_buffer(), t)) for x, t in zip(raw, (np.int64, np.int32, np.int64), strict=True))]
                    places.append(pa.RecordBatch.from_arrays([*(pa.nulls(len(own[0]), pa.int64()) for _ in range(4)), *own], names=names))
                some = some.filter(pc.invert(none))
                if some.num_rows:
                    keys = [_unpacked_keys(codec.decompress(x.as_buffer())).tobytes() for x in some.column("keys")]
                    yield some.set_column(some.schema.get_field_index("keys"), "keys", pa.array(keys, pa.binary()))

    for found in _meet(unpacked()):
        yield from places
        places.clear()
        yield pa.RecordBatch.from_arrays([*found.columns, *(pa.nulls(found.num_rows, t) for t in (kind[0], pa.int64(), pa.int32(), pa.int64()))], names=names)
    yield from places


def _bodies(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """(line, body): the normalised text of lines, each from one place ``at`` (id, th, number)."""
    source = _texts(docs, key)

    def cut(batches):
        for batch in batches:
            found, bodies, size = [], [], 0
            texts = batch.column("text").cast(pa.large_binary())
            for text, numbers, ids in zip(texts, batch.column("numbers").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                lines = text.as_py().split(b"\n")
                found += ids
                bodies += [normalise(lines[n]).decode("utf-8", "replace") for n in numbers]
                size += sum(len(x) for x in bodies[-len(ids) :])
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(bodies, pa.string())], names=["line", "body"])
                    found, bodies, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(bodies, pa.string())], names=["line", "body"])
        trim()

    # A document's places come from all over: they are dealt once, then gathered, which is less work than gathering twice.
    places = wanted.select(F.col("at.id").alias("wid"), F.col("at.th").alias("wth"), F.struct(F.col("at.number").alias("number"), "line").alias("w")).repartition("wid", "wth").groupBy("wid", "wth").agg(F.collect_list("w").alias("w")).select("wid", "wth", F.col("w.number").alias("numbers"), F.col("w.line").alias("lines"))
    joined = source.join(places.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth"))).select("text", "numbers", "lines")
    # rows that are equal in id and text give the same lines again: one of each stays
    return joined.mapInArrow(cut, "line long, body string").groupBy("line").agg(F.first("body").alias("body"))


def _rebuild(docs: DataFrame, key: str, gone: DataFrame, counts: tuple[str, str]) -> DataFrame:
    """Documents without the lines in ``gone`` (gid, gth, numbers), with the numbers of lines and of kept lines."""
    names = docs.columns
    others = [n for n in names if n != "text"]
    source = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64("text").alias("th"), F.struct(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(others))).alias("row"), F.col("text"))
    kind = dict(source.dtypes)["row"]
    marked = source.join(gone.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left")

    def run(batches):
        for batch in batches:
            at, n = 0, batch.num_rows
            texts, total, kept, size = [], [], [], 0
            for i, (value, numbers) in enumerate(zip(batch.column("text").cast(pa.large_binary()), batch.column("numbers").to_pylist(), strict=True)):
                raw = value.as_py()
                lines = [] if raw is None else raw.split(b"\n")
                full = sum(1 for x in lines if x.strip())
                drop = set(numbers or ())
                if drop:
                    raw = b"\n".join(x for k, x in enumerate(lines) if k not in drop) if full > len(drop) else b""
                texts.append(raw)
                total.append(full)
                kept.append(full - len(drop))
                size += len(raw or b"")
                if size > 1 << 23 or i == n - 1:
                    yield pa.RecordBatch.from_arrays([batch.column("row").slice(at, i + 1 - at), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(kept, pa.int64())], names=["row", "text", "total", "kept"])
                    texts, total, kept, size, at = [], [], [], 0, i + 1
        trim()

    out = marked.select("row", "text", "numbers").mapInArrow(run, f"row {kind}, text string, total long, kept long")
    values = {n: F.col("row").getField(f"c{k}") for k, n in enumerate(others)} | {"text": F.col("text")}
    made = []
    for c in counts:
        made.append(fresh(c, [*names, *made]))
    return out.select(*(values[n].alias(n) for n in names), F.col("total").alias(made[0]), F.col("kept").alias(made[1]))


def dedup_lines(docs: DataFrame, key: str = "doc_id", counts: tuple[str, str] = ("n_lines", "n_kept")) -> DataFrame:
    """Documents with one occurrence of each group of similar lines, and the numbers of lines and of kept lines."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines", sweep=True)
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    targets = max(partitions_for(spark), -(-size // TARGET))
    dealt = _blocks(docs, key, 4 * targets).repartition(targets, "target").sortWithinPartitions("target")
    kind = dict(docs.dtypes)[key]
    both = scratch.write(dealt.mapInArrow(_meet_packed, f"key long, id long, lead long, length long, doc {kind}, th long, number int, line long"), "met")
    found = both.where("line IS NOT NULL").select(F.col("doc").alias("id"), "th", "number", "line")
    met = scratch.write(both.where("line IS NULL").select("key", "id", "lead", "length").distinct(), "met")
    scratch.release()
    lines = scratch.write(found.groupBy("line").agg(F.min(F.struct("id", "th", "number")).alias("at"), F.count("*").alias("n")), "places")
    wanted = met.select("id").unionByName(met.select(F.col("lead").alias("id"))).distinct()
    bodies = scratch.write(_bodies(docs, key, lines.join(wanted, lines["line"] == wanted["id"], "left_semi")), "bodies")
    scratch.release()

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda c, body: bodies.select(F.col("line").alias(c), F.col("body").alias(body))
        return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(_similar_pairs, "a long, b long")

    comps = link(scratch, met, verify, rounds=2, met=True, in_lists=lambda lists: in_lists(lists, bodies), rank=lines.select(F.col("line").alias("id"), (-F.col("n")).alias("rank")))
    scratch.drop(bodies)
    known = lines
    if comps is not None:
        rooted = lines.join(comps, lines["line"] == comps["id"]).select("line", "at", "n", "root")
        stays = rooted.groupBy("root").agg(F.min("at").alias("stay"))
        linked = rooted.join(stays, "root").select("line", "stay")
        known = lines.join(comps, lines["line"] == comps["id"], "left_anti")
    repeated = known.where("n > 1").select("line", F.col("at").alias("stay"))
    hot = scratch.write(repeated if comps is None else repeated.unionByName(linked), "stays")
    gone = found.join(hot, "line").where(~F.struct("id", "th", "number").eqNullSafe(F.col("stay"))).select(F.col("id").alias("gid"), F.col("th").alias("gth"), "number").repartition("gid", "gth").groupBy("gid", "gth").agg(F.collect_set("number").alias("numbers"))
    gone = scratch.write(gone, "gone")
    scratch.drop(both, lines, hot)
    scratch.release()
    return _rebuild(docs, key, gone, counts)
