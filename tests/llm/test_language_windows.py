"""Training windows of op9 drawn on the executors, and its documents' scores written out plainly."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chronoframe.llm import language_id
from chronoframe.llm.language_id import WIDTHS, WINDOW, ByteCnn, Settings

SCHEMA = "doc_id long, lang string, text string"


def _windows(spark, rows, settings=Settings()):
    return language_id.training_windows(spark.createDataFrame(rows, SCHEMA), F.lit(True), settings).collect()


def test_windows_come_from_anywhere_in_whole_texts(spark):
    text = "".join(f"{i:07d} " for i in range(20000))  # every window of it is told by its numbers
    got = _windows(spark, [(k, "a", text) for k in range(200)])
    at = [text.encode().index(bytes(r["piece"])) for r in got]
    assert len(got) == 200 * 4 and {len(r["piece"]) for r in got} == {WINDOW}
    assert min(at) < 0.02 * len(text) and max(at) > 0.98 * len(text)
    assert np.histogram(at, 4, (0, len(text)))[0].min() > 150


def test_windows_are_bounded_by_rows_whatever_the_languages(spark):
    many = [(k, f"l{k % 300}", f"text of number {k}") for k in range(3000)]
    got = _windows(spark, many, Settings(most_rows=600))
    assert len(got) == 600 and len({r["label"] for r in got}) == 300
    got = _windows(spark, many, Settings(most_rows=10))
    assert len(got) == 300  # one a language at least


def test_windows_of_short_empty_null_and_repeated_rows(spark):
    rows = [(1, "a", "kurz"), (1, "a", "kurz"), (1, "b", "aber"), (2, "a", ""), (3, None, "x"), (4, "a", None), (5, "c", "é" * 400)]
    got = sorted((r["k"], r["label"], r["n"], bytes(r["piece"])) for r in _windows(spark, rows))
    assert [g[:3] for g in got] == [(1, "a", 1), (5, "c", 1), (5, "c", 2)] and got[0][3] == b"kurz"
    assert all(len(g[3]) == WINDOW for g in got[1:])
    assert _windows(spark, []) == []


def _plain(model, text):
    """Probabilities of a text: each window, filter, place and byte in turn."""
    raw = text.encode()
    total = np.zeros(len(model.labels))
    for at in range(0, len(raw), WINDOW):
        piece = raw[at : at + WINDOW]
        x = np.frombuffer(piece + bytes(WINDOW - len(piece) + 4), np.uint8)
        hidden = []
        for w in WIDTHS:
            kernel = model.p[f"K{w}"].astype(np.float64)
            best = np.full(model.settings.filters, -np.inf)
            for place in range(len(x) - w + 1):
                best = np.maximum(best, sum(model.p["E"][x[place + j]].astype(np.float64) @ kernel[j] for j in range(w)))
            hidden.append(np.maximum(best + model.p[f"b{w}"], 0))
        logit = np.concatenate(hidden) @ model.p["V"] + model.p["c"]
        e = np.exp(logit - logit.max())
        total += e / e.sum() * sum(b != 0 for b in piece)
    return total / total.sum()


def test_scores_of_whole_texts_equal_the_plain_sum_over_windows():
    rng = np.random.default_rng(3)
    model = ByteCnn(["x", "y", "z"], Settings(seed=5))
    model.p["V"] = rng.normal(0, 1, model.p["V"].shape).astype(np.float32)
    texts = ["a", "schön", "one two " * 64, "one two " * 64 + "x", "Wörter und Wörter " * 90, "".join(map(chr, rng.integers(32, 1000, 1700)))]
    langs, scores = language_id.languages(pa.array(texts), model)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        want = _plain(model, text)
        assert lang == model.labels[int(want.argmax())] and abs(score - want.max()) < 1e-4
