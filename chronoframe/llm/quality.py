"""Operator 10: quality from random-indexing word vectors and a two-layer network.

Words (runs of letters, of digits, of marks) are hashed to a fixed number of slots. Each slot has a fixed sparse random
index vector; its word vector is the sum of the index vectors of the words around it, over all documents. A document is
the mean, spread and mean step of its words' vectors. A two-layer network, trained in numpy on a bounded sample of
labelled rows, scores it; a temperature fitted on rows kept apart calibrates the probabilities.

Defined results: null and empty texts are scored as a text without words; with no labelled row of both kinds the score
is the share of label 1 (0.5 if none). Repeated rows stay repeated; a null doc_id is never learned from; of the texts of
one labelled doc_id the least counts. Extra columns stay as they are; should one be called like a result, the result gets
an underscore more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import RUNS, chunks, fresh, sum_tables, table_blocks, trim, utf8_buffers, word_hashes


@dataclass(frozen=True)
class Settings:
    slots: int = 1 << 14
    size: int = 32
    reach: int = 2
    #: Labelled rows that the network is fitted on, at most: the least by a hash of doc_id.
    labelled_rows: int = 20000
    hidden: int = 32
    steps: int = 1500
    batch: int = 256
    rate: float = 3e-3
    seed: int = 11


def index_vectors(s: Settings) -> np.ndarray:
    rng = np.random.default_rng(s.seed)
    return rng.choice(np.array([-1, 0, 1], np.float32), (s.slots, s.size), p=(0.1, 0.8, 0.1))


def _slots(data, offsets, s: Settings):
    words, at = word_hashes(data, offsets, fold=False, classes=RUNS)
    return (words & np.uint64(s.slots - 1)).astype(np.int64), at


def context_sums(docs: DataFrame, s: Settings) -> np.ndarray:
    """Sums of the index vectors around each slot's words, over every text."""
    index = index_vectors(s)

    def run(batches):
        table = np.zeros((s.slots, s.size), np.float64)
        for batch in batches:
            data, off = utf8_buffers(batch.column(0))
            for i, j in chunks(off, 1 << 18):
                w, at = _slots(data[off[i] : off[j]], off[i : j + 1] - off[i], s)
                if not len(w):
                    continue
                text = np.repeat(np.arange(j - i), np.diff(at))
                around = np.zeros((len(w), s.size), np.float32)
                for d in range(1, s.reach + 1):
                    same = (text[d:] == text[:-d])[:, None]
                    around[d:] += index[w[:-d]] * same
                    around[:-d] += index[w[d:]] * same
                order = np.argsort(w, kind="stable")
                first = np.flatnonzero(np.concatenate(([True], np.diff(w[order]) != 0)))
                table[w[order][first]] += np.add.reduceat(around[order], first, axis=0)
        yield table_blocks(table, 1 << 13)
        trim()

    sums = sum_tables(docs.select("text").mapInArrow(run, "block int, data binary"), np.float64)
    flat = np.concatenate([sums[k] for k in sorted(sums)]) if sums else np.zeros(s.slots * s.size)
    table = flat.reshape(s.slots, s.size)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray, s: Settings) -> np.ndarray:
    """Mean, spread and mean step of the word vectors of each text, and the logarithm of their number."""
    n = len(offsets) - 1
    out = np.zeros((n, 3 * s.size + 1), np.float32)
    for i, j in chunks(offsets, 1 << 18):
        w, at = _slots(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], s)
        count = np.diff(at)
        full = np.flatnonzero(count > 0)
        if not len(full):
            continue
        starts, c = at[:-1][full], count[full][:, None].astype(np.float32)
        v = vectors[w]
        mean = np.add.reduceat(v, starts, axis=0) / c
        square = np.add.reduceat(v * v, starts, axis=0) / c
        step = np.zeros_like(v)
        np.abs(v[1:] - v[:-1], out=step[1:])
        step[starts] = 0
        rows = i + full
        out[rows, : s.size] = mean
        out[rows, s.size : 2 * s.size] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[rows, 2 * s.size : 3 * s.size] = np.add.reduceat(step, starts, axis=0) / np.maximum(c - 1, 1)
        out[rows, -1] = np.log1p(c[:, 0])
    return out


@dataclass
class Model:
    settings: Settings
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: dict[str, np.ndarray] | None
    temperature: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        h = np.maximum(z @ self.layers["W"] + self.layers["b"], 0)
        return (h @ self.layers["v"] + self.layers["c"]).astype(np.float64)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _fit(x: np.ndarray, y: np.ndarray, s: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(s.seed + 1)
    p = {"W": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], s.hidden)), "b": np.zeros(s.hidden), "v": rng.normal(0, 0.1, s.hidden), "c": np.zeros(1)}
    m, q = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, s.steps + 1):
        i = rng.integers(0, len(x), s.batch)
        xb, yb = x[i], y[i]
        pre = xb @ p["W"] + p["b"]
        h = np.maximum(pre, 0)
        d = (1 / (1 + np.exp(-np.clip(h @ p["v"] + p["c"], -40, 40))) - yb) / len(i)
        dh = d[:, None] * p["v"] * (pre > 0)
        g = {"W": xb.T @ dh + 1e-4 * p["W"], "b": dh.sum(0), "v": h.T @ d + 1e-4 * p["v"], "c": d.sum(keepdims=True)}
        rate = s.rate * (1 - step / (s.steps + 1))
        for k, gk in g.items():
            m[k] = 0.9 * m[k] + 0.1 * gk
            q[k] = 0.99 * q[k] + 0.01 * gk * gk
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.99**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in p.items()}


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, s: Settings = Settings(), key: str = "doc_id") -> Model:
    """Word vectors from all texts; the network from at most ``labelled_rows`` labelled rows."""
    vectors = context_sums(docs, s)
    known = labels.where(may_learn & F.col("quality").isin(0, 1)).select(F.col(key).alias("k"), "quality")
    ids = known.groupBy("k").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("k"), "k").limit(s.labelled_rows)
    texts = docs.select(F.col(key).alias("id"), F.col("text").alias("body")).join(F.broadcast(ids), F.col("id") == F.col("k"))
    rows = texts.groupBy("k", "quality").agg(F.min("body").alias("text"))

    def features(batches):
        for batch in batches:
            x = pooled(*utf8_buffers(batch.column("text")), vectors, s)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], names=["k", "quality", "x"])

    got = sorted((r["k"], r["quality"], bytes(r["x"])) for r in rows.select("k", "quality", "text").mapInArrow(features, f"k {dict(ids.dtypes)['k']}, quality int, x binary").collect())
    y = np.array([g[1] for g in got], np.float64)
    width = 3 * s.size + 1
    if len(set(y.tolist())) < 2:
        return Model(s, vectors, np.zeros(width), np.ones(width), None, 1.0, float(y.mean()) if len(y) else 0.5)
    x = np.stack([np.frombuffer(g[2], np.float32) for g in got])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    apart = np.arange(len(x)) % 6 == 0
    z = (x - centre) / scale
    model = Model(s, vectors, centre, scale, _fit(z[~apart], y[~apart], s), 1.0, float(y.mean()))
    logit = model.logits(x[apart])
    grid = np.geomspace(0.25, 8, 61)
    loss = [np.mean(np.logaddexp(0, -(2 * y[apart] - 1) * logit / t)) for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7, out: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Every row, with score and prediction of its whole text. The text alone goes to the workers."""

    @F.arrow_udf("double")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.scores(pooled(*utf8_buffers(texts), model.vectors, model.settings)).astype(np.float64))
        trim()

    names = [fresh(out[0], docs.columns)]
    names.append(fresh(out[1], [*docs.columns, *names]))
    found = docs.withColumn(names[0], told.asNondeterministic()("text"))
    return found.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))
