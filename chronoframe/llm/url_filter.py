"""Operator 8: URL filters by a bit-parallel wildcard automaton.

All glob rules are packed, one after another, into one multiword Shift-And mask. A batch of canonical URLs (host, A-Z
lower-cased, followed by the path) goes through the automaton together, one byte column at a time, so every rule is
simulated over every URL at once. In a glob, ``*`` stands for any bytes but ``/`` and ``**`` for any bytes.

Defined results: null url or no ``://``: empty host and path, no rule, the default verdict. Several rules of one length
that fit: the first in the list. Extra columns are dropped; repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import utf8_buffers


@dataclass(frozen=True)
class Rule:
    """A rule on a host, its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"]


class ShiftAnd:
    """Globs packed into 64-bit words; ``match`` gives, for each URL of a batch, which globs fit the whole of it."""

    def __init__(self, globs: Sequence[str]):
        loops_any, loops_host, tokens, starts = [], [], [], []
        for g in globs:
            raw, at = g.encode(), len(tokens)
            starts.append(at)
            tokens.append(None)  # the state before the first byte
            i = 0
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    loops_any.append(len(tokens) - 1)
                    i += 2
                elif raw[i : i + 1] == b"*":
                    loops_host.append(len(tokens) - 1)
                    i += 1
                else:
                    tokens.append(raw[i])
                    i += 1
        self.size = len(tokens)
        self.words = max(1, -(-self.size // 64))
        self.starts = self._bits(starts)
        self.ends = [(s - 1) for s in starts[1:]] + [self.size - 1]
        self.take = np.stack([self._bits([i for i, t in enumerate(tokens) if t == c]) for c in range(256)])
        any_loop, host_loop = self._bits(loops_any), self._bits(loops_host)
        self.stay = np.stack([any_loop | (host_loop if c != 0x2F else np.uint64(0)) for c in range(256)])

    def _bits(self, where: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for i in where:
            out[i >> 6] |= np.uint64(1 << (i & 63))
        return out

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        base, length = offsets[:-1][order], length[order]
        state = np.tile(self.starts, (n, 1))
        alive = n
        for j in range(int(length[0]) if n else 0):
            alive = int(np.searchsorted(-length, -j, side="left"))  # URLs longer than j
            c = data[base[:alive] + j]
            d = state[:alive]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:alive] = (moved & self.take[c]) | (d & self.stay[c])
        hit = np.empty((n, len(self.ends)), bool)
        for k, e in enumerate(self.ends):
            hit[order, k] = (state[:, e >> 6] >> np.uint64(e & 63)) & np.uint64(1)
        return hit


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) for every row: the longest fitting rule and its verdict, else ``default``."""
    globs = [g for r in rules for g in r.globs()]
    owner = np.array([i for i, r in enumerate(rules) for _ in r.globs()], np.int64)
    machine = ShiftAnd(globs) if globs else None
    weight = np.array([len(r.name) * (len(rules) + 1) + len(rules) - i for i, r in enumerate(rules)], np.int64)
    names = pa.array([r.name for r in rules] + [None], pa.string())
    verdicts = pa.array([r.verdict for r in rules] + [default], pa.string())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.full(batch.num_rows, len(rules))
            if machine is not None and batch.num_rows:
                hit = machine.match(*utf8_buffers(batch.column("canonical")))
                score = np.where(hit, weight[owner], -1)
                top = score.argmax(axis=1)
                best = np.where(score.max(axis=1) >= 0, owner[top], len(rules))
            pick = pa.array(best)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("host"), batch.column("path"), names.take(pick), verdicts.take(pick)], names=[key, "host", "path", "rule", "verdict"])

    parts = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    kind = dict(parts.dtypes)[key]
    return parts.withColumn("canonical", F.concat("host", "path")).mapInArrow(judge, f"{key} {kind}, host string, path string, rule string, verdict string")
