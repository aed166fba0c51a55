"""Of lines over 60 characters that are similar, how many meet: few or many words, short or long ones, one to three edits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.llm import line_dedup
from chronoframe.llm.shared import Scratch

from .test_ops import keys_of, meets

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def word(rng, n, letters=LETTERS):
    return "".join(rng.choice(letters) for _ in range(n))


def change(rng, w):
    p, c = rng.randrange(len(w)), rng.choice(LETTERS)
    return {"other": w[:p] + c + w[p + 1 :], "more": w[:p] + c + w[p:], "less": w[:p] + w[p + 1 :] or c}[rng.choice(("other", "more", "less"))]


def recall(make, n=100, seed=1):
    rng, met, tries = random.Random(seed), [], 0
    while len(met) < n and tries < 40 * n:
        tries += 1
        a, b = make(rng)
        if a != b and max(len(a), len(b)) > line_dedup.SHORT and line_dedup.within(a, b, line_dedup.most_edits(max(len(a), len(b)))):
            met.append(meets(a, b))
    assert len(met) > n // 3
    return np.mean(met)


@pytest.mark.parametrize(("words", "letters", "edits"), [(1, 70, 1), (2, 32, 1), (3, 25, 1), (4, 20, 1), (5, 16, 1), (6, 14, 1), (8, 8, 2), (10, 6, 2), (12, 6, 2), (10, 6, 3), (12, 5, 3), (16, 5, 3), (20, 5, 3), (24, 4, 3), (27, 4, 3), (40, 1, 2), (40, 5, 3), (90, 5, 3), (2, 400, 3)])
def test_recall_by_words_letters_and_edits(words, letters, edits):
    def make(rng):
        line = [word(rng, max(1, letters + (rng.randint(-1, 1) if letters > 3 else 0))) for _ in range(words)]
        other = list(line)
        for _ in range(edits):
            i = rng.randrange(words)
            other[i] = change(rng, other[i])
        return " ".join(line), " ".join(other)

    assert recall(make) >= 0.9


def test_recall_of_addresses_and_scripts_without_spaces():
    def address(rng):
        a = f"https://www.{word(rng, 12)}.com/{word(rng, 20)}/{word(rng, 15)}?id={word(rng, 18, '0123456789')}"
        return a, change(rng, a)

    def script(rng):
        a = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(80))
        i = rng.randrange(80)
        return a, a[:i] + chr(0x4E00 + rng.randrange(3000)) + a[i + 1 :]

    assert recall(address) >= 0.9 and recall(script) >= 0.9


@pytest.mark.parametrize(("a", "b"), [("=" * 80, "=" * 82), ("-" * 70, "-" * 71), ("ha " * 40, "ha " * 41), ("0 " * 40 + "1", "0 " * 41 + "1"), ("=-" * 50, "=-" * 52), ("ab " * 100 + "c", "ab " * 103)])
def test_repeated_words_and_separators_meet(a, b):
    assert meets(line_dedup.normalise(a.encode()).decode(), line_dedup.normalise(b.encode()).decode())


def test_case_and_white_space_change_no_key():
    line = "The Quick brown FOX jumps over the lazy dog and then it sleeps all the day long"
    assert keys_of(line) == keys_of("  " + line.lower().replace(" ", " \t ") + " ")


def test_many_copies_of_a_document_are_linear_work(spark):
    """1,000 rows that are equal in id and text: each line's body is fetched once, whatever the copies."""
    a = "one line that is long enough to have blocks of pieces and not only segments of its text"
    b = a.replace("pieces", "piecez")
    docs = spark.createDataFrame([(1, f"{a}\nx y z")] * 1000 + [(2, f"{b}\nx y z")] * 1000, "doc_id long, text string").repartition(4)
    found = line_dedup.occurrences(docs, "doc_id").groupBy("line").agg(F.min(F.struct("id", "th", "number")).alias("at"))
    assert found.count() == 3 and line_dedup._bodies(docs, "doc_id", found).count() == 3
    got = {(r["doc_id"], r["text"], r["n_kept"]): r["n"] for r in line_dedup.dedup_lines(docs).groupBy("doc_id", "text", "n_kept").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, f"{a}\nx y z", 2): 1000, (2, "", 0): 1000}


def shapes_of(lines):
    raw = [x.encode() for x in lines]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    start = np.cumsum([0, *(len(x) + 1 for x in raw[:-1])])
    return line_dedup.shapes(data, start, np.array([len(x) for x in lines]), np.arange(len(lines)))


def test_shapes_rule_out_no_similar_lines():
    rng, lines = random.Random(5), []
    for n in (5, 20, 60, 130, 400, 3000, 20000):
        for letters in (LETTERS, "ab", "éèà ça", "漢字仮名 x", "A b C"):
            a = " ".join(word(rng, 7, letters) for _ in range(max(1, n // 8))).strip() or "a"
            b = a
            for _ in range(rng.randint(0, line_dedup.most_edits(len(a)))):
                b = change(rng, b)
            lines.append((a, b))
    similar = np.array([line_dedup.within(a, b, line_dedup.most_edits(max(len(a), len(b)))) for a, b in lines])
    p, q = (shapes_of(x) for x in zip(*lines, strict=True))
    assert similar.sum() > 15 and line_dedup.shapes_allow(p[similar], q[similar]).all()
    assert not line_dedup.shapes_allow(*(shapes_of([x]) for x in ("the cat sat on the mat again today", "pull good moon books from boxes now")))[0]


def test_lists_fall_into_the_parts_that_may_be_similar():
    """Lines that share a key by chance alone go no further; what edits connect, and texts that are not UTF-8, stay together."""
    rng = random.Random(6)
    odd = [word(rng, 90) for _ in range(40)]
    near = [odd[0][:k] + "q" + odd[0][k + 1 :] for k in range(10)]
    lines = np.arange(1, 51, dtype=np.uint64)
    keys = np.full(50, 9, np.uint64)
    got = line_dedup._groups(keys, lines, shapes_of(odd + near)).to_pylist()
    part = next({r["id"] for r in got if r["key"] == k} for k in {r["key"] for r in got if r["id"] == 41})
    assert {1, *range(41, 51)} <= part and len(part) < 20
    assert line_dedup._groups(keys[:2], lines[:2], np.concatenate((shapes_of(["abcd " * 10]), shapes_of(["uvwx " * 10])))) is None
    assert line_dedup._groups(keys[:2], lines[:2], np.full(2, line_dedup.UNKNOWN, np.uint64)).num_rows == 1
    at = np.sort(np.array([rng.getrandbits(64) for _ in range(500)], np.uint64))
    assert (line_dedup._unpacked_keys(line_dedup._packed_keys(at)) == at >> np.uint64(16) << np.uint64(16)).all()


def test_a_swept_write_leaves_no_shuffle_files(spark):
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")
    before = held()
    out = Scratch(spark, "swept", sweep=True).write(spark.range(1000).repartition(7, "id"))
    assert held() == before and out.count() == 1000
    kept = spark.range(1000).repartition(7, "id").write
    kept.format("noop").mode("overwrite").save()
    assert held() > before


def test_one_by_one_and_in_batches_distances_are_held_alike():
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abcé ") for _ in range(rng.randint(20, 160)))
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 5)):
            at = rng.randrange(len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "xy"])
        pairs.append(sorted((a, "".join(b)), key=len))
    most = [line_dedup.most_edits(len(b)) for _, b in pairs]
    want = [line_dedup.edit_distance(a, b) <= k for (a, b), k in zip(pairs, most, strict=True)]
    assert 50 < sum(want) < 350
    assert [len(b) - len(a) <= k and line_dedup._banded_one(a, b, k) for (a, b), k in zip(pairs, most, strict=True)] == want
    held = line_dedup.Lines([x for p in pairs for x in p])
    i = np.arange(0, 2 * len(pairs), 2)
    assert line_dedup.within_many(held.code, held.start[i], held.chars[i], held.start[i + 1], held.chars[i + 1], np.array(most), lambda k: pairs[k]).tolist() == want
