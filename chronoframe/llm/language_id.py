"""Operator 9: language identification by a byte convolutional network.

Byte embeddings, filters of several widths, max pooling over a window, a softmax; trained in numpy on labelled text and
applied to all fixed-length windows of every text. A document's probabilities are the means over its windows, weighted
by their bytes. Convolution over bytes is a sum of table rows: tables of byte pairs are made once for a trained model.

Defined results: null text, or none of its characters a letter: ``und``, score 0; so too if nothing was learned.
Repeated rows stay repeated; ``doc_id`` null: never learned from; of rows with one doc_id that are learned from, the least
by (lang, text) counts. Very long texts go through in bounded groups of windows. Extra columns stay as they are; should
one be called like a result, the result gets an underscore more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh, trim, utf8_buffers

WINDOW = 512
WIDTHS = (2, 3, 4)


@dataclass(frozen=True)
class Settings:
    #: Labelled documents per language that the network is fitted on, at most; the least by a hash of doc_id.
    rows_per_language: int = 1500
    #: Labelled documents of all languages together, at most (at least one of each language).
    most_rows: int = 60000
    #: Windows of a document that reach the driver, at most, from anywhere in its whole text.
    windows_per_row: int = 4
    embedding: int = 8
    filters: int = 16
    batch: int = 128
    steps: int = 700
    rate: float = 4e-3
    seed: int = 7


class ByteCnn:
    def __init__(self, labels: list[str], settings: Settings = Settings()):
        rng = np.random.default_rng(settings.seed)
        e, f = settings.embedding, settings.filters
        self.labels, self.settings = labels, settings
        self.p = {"E": rng.normal(0, 0.5, (256, e))}
        for w in WIDTHS:
            self.p[f"K{w}"] = rng.normal(0, 1 / np.sqrt(w * e), (w, e, f))
            self.p[f"b{w}"] = np.zeros(f)
        self.p["V"] = rng.normal(0, 0.1, (f * len(WIDTHS), len(labels)))
        self.p["c"] = np.zeros(len(labels))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.p["E"][0] = 0
        self.tables = None

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Max-pooled responses of windows (rows of bytes), and where each maximum is."""
        out, where = [], {}
        for w in WIDTHS:
            t = x.shape[1] - w + 1
            z = sum(np.take(self.p["E"] @ self.p[f"K{w}"][j], x[:, j : j + t], axis=0) for j in range(w))
            where[w] = z.argmax(axis=1)
            out.append(np.take_along_axis(z, where[w][:, None, :], 1)[:, 0] + self.p[f"b{w}"])
        return np.concatenate(out, axis=1), where

    def fit(self, texts: list[bytes], y: np.ndarray) -> ByteCnn:
        """Steps over pieces of the texts (here: windows): a batch draws texts of each label, and a place anywhere in each."""
        s = self.settings
        rng = np.random.default_rng(s.seed + 1)
        by = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        size = np.array([len(t) for t in texts])
        first = np.cumsum(size) - size
        data = np.concatenate((np.frombuffer(b"".join(texts), np.uint8), np.zeros(WINDOW, np.uint8)))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        lengths = np.array([12, 24, 48, 96, 200, WINDOW])
        for step in range(1, s.steps + 1):
            pick = np.concatenate([rng.choice(i, -(-s.batch // len(by))) for i in by])
            wide = int(lengths[rng.integers(len(lengths))])
            at = (rng.random(len(pick)) * np.maximum(1, size[pick] - wide + 1)).astype(np.int64)
            reach = np.arange(wide)
            xb = data[(first[pick] + at)[:, None] + reach] * (at[:, None] + reach < size[pick][:, None])
            xb = np.pad(xb, ((0, 0), (0, 4)))
            pre, where = self._pooled(xb)
            hid = np.maximum(pre, 0)
            logit = hid @ self.p["V"] + self.p["c"]
            prob = np.exp(logit - logit.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            d = prob
            d[np.arange(len(pick)), y[pick]] -= 1
            d /= len(pick)
            g = {"V": hid.T @ d + 1e-4 * self.p["V"], "c": d.sum(0), "E": np.zeros_like(self.p["E"])}
            dh = (d @ self.p["V"].T) * (pre > 0)
            f = s.filters
            for k, w in enumerate(WIDTHS):
                dz = dh[:, k * f : (k + 1) * f]
                g[f"b{w}"] = dz.sum(0)
                gk = np.zeros_like(self.p[f"K{w}"])
                for j in range(w):
                    b = np.take_along_axis(xb, where[w] + j, 1)  # rows x filters
                    gk[j] = np.einsum("nfe,nf->ef", self.p["E"][b], dz)
                    np.add.at(g["E"], b, dz[..., None] * self.p[f"K{w}"][j].T[None])
                g[f"K{w}"] = gk
            rate = s.rate * (1 - step / (s.steps + 1))
            for k, dk in g.items():
                m[k] = 0.9 * m[k] + 0.1 * dk
                v2[k] = 0.99 * v2[k] + 0.01 * dk * dk
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
            self.p["E"][0] = 0
        return self

    def prepare(self) -> None:
        """Tables of byte pairs, so that a filter of width 4 is the sum of two rows."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        t = {w: [self.p["E"] @ self.p[f"K{w}"][j] for j in range(w)] for w in WIDTHS}
        self.tables = {2: [(0, True, pair(*t[2]))], 3: [(0, True, pair(t[3][0], t[3][1])), (2, False, t[3][2])], 4: [(0, True, pair(t[4][0], t[4][1])), (2, True, pair(t[4][2], t[4][3]))]}

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        if self.tables is None:
            self.prepare()
        out = np.empty((len(windows), len(self.labels)), np.float32)
        for at in range(0, len(windows), 64):
            x = windows[at : at + 64].astype(np.int32)
            x = np.pad(x, ((0, 0), (0, 4)))
            pairs = (x[:, :-1] << 8) | x[:, 1:]
            hid = []
            for w in WIDTHS:
                n = x.shape[1] - w + 1
                z = None
                for shift, two, table in self.tables[w]:
                    part = np.take(table, (pairs if two else x)[:, shift : shift + n], axis=0)
                    z = part if z is None else np.add(z, part, out=z)
                hid.append(np.maximum(z.max(axis=1) + self.p[f"b{w}"], 0))
            logit = np.concatenate(hid, axis=1) @ self.p["V"] + self.p["c"]
            e = np.exp(logit - logit.max(1, keepdims=True))
            out[at : at + 64] = e / e.sum(1, keepdims=True)
        return out

    def __getstate__(self):
        return self.__dict__ | {"tables": None}


_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(raw: bytes) -> bool:
    """Whether a text has a letter (Unicode category L)."""
    return bool(_ASCII_LETTER.search(raw)) or (not raw.isascii() and any(map(str.isalpha, raw.decode("utf-8", "ignore"))))


def windows_of(data: np.ndarray) -> np.ndarray:
    n = -(-len(data) // WINDOW)
    return np.pad(data, (0, n * WINDOW - len(data))).reshape(n, WINDOW)


def learnable(key: Column, parts: int, held: int) -> Column:
    """True on rows to learn from, by crc32 of the key as text; null keys are never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % parts != held, F.lit(False))


def training_windows(docs: DataFrame, may_learn: Column, settings: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """(label, k, n, piece) of a bounded sample: at most ``windows_per_row`` windows of bytes from each of the least documents by a hash of the key.

    A language has at most ``rows_per_language`` documents, all have ``most_rows`` together, so the rows are bounded whatever the
    texts' lengths and the number of languages. A window's place is drawn by a hash over all places of the whole text, on the
    executors; a text of at most one window is one row. Empty texts have none.
    """
    labelled = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    each = max(1, min(settings.rows_per_language, settings.most_rows // max(1, labelled.select("lang").distinct().count())))
    hashed = labelled.select(F.col(key).alias("k"), F.col("lang").alias("label"), F.xxhash64(key).alias("h"))
    # Least in each of 64 parts of a language first, so that no task sorts a whole language.
    part = Window.partitionBy("label", F.pmod(F.spark_partition_id(), F.lit(64))).orderBy("h", "k")
    fewer = hashed.groupBy("label", "k").agg(F.first("h").alias("h")).withColumn("r", F.row_number().over(part)).where(F.col("r") <= each)
    chosen = fewer.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h", "k"))).where(F.col("r") <= each)
    ids = chosen.select("k").distinct()  # most_rows, or one a language
    rows = labelled.select(F.col(key).alias("k"), F.col("lang").alias("label"), F.col("text").alias("body")).join(F.broadcast(ids), "k", "left_semi")
    bodies = rows.groupBy("k").agg(F.min(F.struct("label", "body")).alias("s")).select("k", "s.label", F.encode("s.body", "utf-8").alias("raw")).where(F.length("raw") > 0)
    many = F.least(F.lit(settings.windows_per_row), F.ceil(F.length("raw") / WINDOW).cast("int"))
    dealt = bodies.withColumn("n", F.explode(F.sequence(F.lit(1), many)))
    share = F.pmod(F.xxhash64("k", "n"), F.lit(1 << 30)) / float(1 << 30)
    at = F.floor(share * F.greatest(F.lit(1), F.length("raw") - WINDOW + 1)).cast("int")
    return dealt.select("label", "k", "n", F.substring("raw", at + 1, F.lit(WINDOW)).alias("piece"))


def train(docs: DataFrame, may_learn: Column, settings: Settings = Settings(), key: str = "doc_id") -> ByteCnn | None:
    """Fit on ``training_windows``, which alone reach the driver."""
    got = sorted((r["label"], r["k"], r["n"], bytes(r["piece"])) for r in training_windows(docs, may_learn, settings, key).collect())
    if not got:
        return None
    labels = sorted({g[0] for g in got})
    return ByteCnn(labels, settings).fit([g[3] for g in got], np.array([labels.index(g[0]) for g in got]))


def languages(texts: pa.Array, model: ByteCnn | None) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    data, off = utf8_buffers(texts)
    count = len(texts)
    langs, scores = [], np.zeros(count)
    group: list[tuple[int, np.ndarray]] = []
    total = np.zeros((count, len(model.labels) if model else 1))
    known = np.zeros(count, bool)
    held = 0

    def flush():
        if group:
            prob = model.probabilities(np.concatenate([w for _, w in group]))
            at = 0
            for i, w in group:
                weight = (w != 0).sum(axis=1, keepdims=True)
                total[i] += (prob[at : at + len(w)] * weight).sum(axis=0)
                at += len(w)
            group.clear()

    for i in range(count):
        raw = data[off[i] : off[i + 1]]
        known[i] = model is not None and len(raw) > 0 and has_letter(raw.tobytes())
        if not known[i]:
            continue
        for at in range(0, len(raw), 1024 * WINDOW):
            w = windows_of(raw[at : at + 1024 * WINDOW])
            group.append((i, w))
            held += len(w)
            if held >= 1024:
                flush()
                held = 0
    flush()
    for i in range(count):
        if known[i] and total[i].sum() > 0:
            k = int(total[i].argmax())
            langs.append(model.labels[k])
            scores[i] = min(1.0, total[i][k] / total[i].sum())
        else:
            langs.append("und")
    return langs, scores


def classify(docs: DataFrame, model: ByteCnn | None, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row, with language and score of its whole text. The text alone goes to the workers."""

    @F.arrow_udf("struct<lang string, score double>")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, scores = languages(texts, model)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang", "score"])
        trim()

    names = [fresh(out[0], docs.columns)]
    names.append(fresh(out[1], [*docs.columns, *names]))
    held = fresh("told", [*docs.columns, *names])
    found = docs.withColumn(held, told.asNondeterministic()("text"))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns), F.col(held)["lang"].alias(names[0]), F.col(held)["score"].alias(names[1]))
