"""Cross-tokenizer alignment, decontamination by a positional index, centroid clustering: brute force and odd tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoframe.llm import alignment, clustering, decontamination, queries, shared

from .test_ops import CLASHES, SF, empty_documents, odd_documents

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


# ---------------------------------------------------------------- 11


def plain_alignment(texts):
    """Whole texts encoded at once; links from byte ranges one by one."""
    side = alignment.Sides(A, B)
    docs, count = [], Counter()
    for text in texts:
        a = b = []
        if text:
            want = (" " + text).encode()
            a, b = side.a.encode(" " + text, add_special_tokens=False).ids, side.b.encode(text)
            if b"".join(side.a_bytes[i] for i in a) != want or b"".join(side.b_bytes[i] for i in b) != want:
                a = b = []
        spans = []
        for ids, raw in ((a, side.a_bytes), (b, side.b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(raw[i]), i))
                at += len(raw[i])
            spans.append(out)
        links, j = [], 0
        for lo, hi, x in spans[0]:
            while j and spans[1][j - 1][1] > lo:
                j -= 1
            while j < len(spans[1]) and spans[1][j][0] < hi:
                if spans[1][j][1] > lo:
                    links.append((x, spans[1][j][2]))
                j += 1
        both = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        groups, lo = [], 0
        for hi in both:
            groups.append("|".join(",".join(str(i) for s, e, i in side_ if lo <= s and e <= hi) for side_ in spans) if len(both) < 400 else "")
            lo = hi
        count.update(links)
        docs.append((len(a), len(b), len(both), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a and len(both) < 400 else "" if not a else None))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(n_a, n_b, g, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), h) for n_a, n_b, g, links, h in docs]


def rows_by_text(docs, out):
    want = Counter((r["doc_id"], *t) for r, t in zip(docs, plain_alignment([r["text"] for r in docs]), strict=True))
    got = Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in out)
    hashed = {x[:-1] for x in want if x[-1] is None}
    strip = lambda c: Counter((*x[:-1], None if x[:-1] in hashed else x[-1]) for x in c.elements())
    assert strip(want) == strip(got)


@pytest.mark.parametrize("what", ["sf", "odd", "empty"])
def test_alignment_against_whole_texts(spark, what):
    docs = {"sf": lambda s: queries.table(s, SF, "documents").orderBy("doc_id").limit(250), "odd": odd_documents, "empty": empty_documents}[what](spark)
    out = alignment.align_documents(docs, A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows_by_text(docs.select("doc_id", "text").collect(), out.collect())


def test_alignment_of_spaces_marks_and_scripts(spark):
    texts = [" a", "a ", "a  b", "a \n b", "\n", " ", "a▁b c", "x ▁y", "<s> hi </s> <0x41>", "日本語 テキスト です", "it's can't we'll 's", "　a b c", "1 2 33 444 5555", "é ñ a", "\U0001f600 \U0001f600\U0001f468‍\U0001f469", "\x00 \x01", "<|endoftext|> x <|endoftext|>", "the the the the", "a" * 70 + " " + "ab " * 40 + "b" * 65]
    rng = random.Random(4)
    texts += ["".join(rng.choice(" abcDE'’.,\n\t12ñß▁日") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    docs = [{"doc_id": i, "text": t} for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string").withColumns({c: F.lit(1) for c in (*CLASHES, "stripe", "chunk", "doc", "data", "n_a")})
    rows_by_text(docs, alignment.align_documents(frame, A, B).collect())


def test_units_give_what_whole_texts_give():
    """Units learned together, apart or again after clear() are the same."""
    side = alignment.Sides(A, B)
    texts = ["the cat's hat", "x" * 200 + " yz", None, "hat the  cat", ""]
    whole = alignment.align_texts(side, texts)
    assert whole[0][:, 3].tolist() == [whole[2][3][whole[2][0] == d].sum() for d in range(5)]
    again = alignment.align_texts(side, texts)
    side.clear()
    apart = [alignment.align_texts(side, [t]) for t in texts]
    assert (again[0] == whole[0]).all() and again[1] == whole[1] == [a[1][0] for a in apart] and (again[2] == whole[2]).all()
    assert (np.concatenate([a[0] for a in apart]) == whole[0]).all()
    keys, sums = alignment._sum_up(np.array([5, 1, 5, 1, 2]), np.array([1, 2, 3, 4, 5]))
    assert keys.tolist() == [1, 2, 5] and sums.tolist() == [6, 5, 4]
    assert list(alignment._sum_up(np.zeros(0, np.int64), np.zeros(0, np.int64))[0]) == []


def test_units_with_white_edges_beside_each_other():
    """They are encoded alone, and a space beside one that is known already is no cut; no text here has a mark of B's."""
    rng = random.Random(11)
    texts = [" ", "  ", " . ", "x. ", " .", "a b\t", "\tfoo bar", "b\t \tfoo", "\u3000 a", "\n"]
    texts += ["".join(rng.choice("   \t\n\x85\u3000ab.'’1") for _ in range(rng.randint(1, 30))) for _ in range(600)]
    side = alignment.Sides(A, B)
    together = alignment.align_texts(side, texts)
    side.clear()
    one_by_one = [alignment.align_texts(side, [t]) for t in texts]  # units stay known from text to text
    want = plain_alignment(texts)
    for sums, digests in ((together[0], together[1]), (np.concatenate([o[0] for o in one_by_one]), [o[1][0] for o in one_by_one])):
        assert [tuple(s) for s in sums.tolist()] == [w[:4] for w in want]
        assert digests == [w[6] for w in want]


def test_counts_are_the_same_for_many_shares(spark):
    docs = queries.table(spark, SF, "documents").orderBy("doc_id").limit(60)
    scratch = shared.Scratch(spark, "t")
    stored = scratch.write(alignment.links(docs.repartition(5), A, B), "links").where("stripe >= 0").select("stripe", "chunk", "data")
    size = alignment.Sides(A, B).a_size
    counted = {}
    for r in alignment.counts(stored, size).collect():
        for b, a, n in np.frombuffer(r["data"], alignment.PAIR).tolist():
            assert (r["stripe"], b, a) not in counted
            counted[r["stripe"], b, a] = n
    plain = Counter()
    for r in stored.collect():
        for _, b, a, n in np.frombuffer(r["data"], alignment.LINK).tolist():
            plain[r["stripe"], b, a] += n
    assert counted == dict(plain)


# ---------------------------------------------------------------- 12

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_decontamination(docs, items, size=10):
    where = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else []:
            where.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(k) for k in where}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                owners = where.get(tuple(w[s : s + n]))
                if owners is not None:
                    hit.update(range(s, s + n))
                    found |= owners
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return Counter(out)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and then sleeps all day"), (2, "One  TWO"), (3, "a a a a a a a a a a a a"), (4, None), (5, ""), (6, "ñandú Ñandú é ß 12"), (6, "second text of six with more than ten words in it now really"), (None, "nobody owns this passage of eleven words at all here now"), (7, "e"), (8, "a a a a a a a a a a a a"), (9, "-- ?!")]


@pytest.mark.parametrize("what", ["odd", "planted", "empty", "no items"])
def test_decontamination_against_brute_force(spark, what):
    items = ITEMS
    if what == "odd":
        docs = odd_documents(spark)
    elif what == "empty":
        docs = empty_documents(spark)
    else:
        rng = random.Random(2)
        vocabulary = [f"w{i}" for i in range(30)] + ["a", "e", "the"]
        rows = []
        for i in range(120):
            w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
            for _ in range(rng.randint(0, 3)):
                text = rng.choice(items)[1] or ""
                at = rng.randint(0, len(w))
                w[at:at] = text.upper().split(" ") if rng.random() < 0.3 else text.split(" ")
            if rng.random() < 0.2:
                w += ["a"] * rng.randint(8, 30)
            rows.append((i if i % 17 else None, rng.choice([" ", "\n", "-", "  ?"]).join(w)))
        rows += [(500, "a " * 30000), (501, rows[3][1]), (501, rows[3][1]), (502, None)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "pos", "term", "word", "window", "start", "item")})
    if what == "no items":
        items = [(4, None), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit("x"))
    got = decontamination.decontaminate(docs, bench)
    assert Counter(tuple(r) for r in got.collect()) == plain_decontamination([tuple(r) for r in docs.select("doc_id", "text").collect()], items)


def test_large_test_sets_give_the_same(spark, monkeypatch):
    docs, bench = queries.table(spark, SF, "documents").limit(200), queries.table(spark, SF, "benchmark")
    few = Counter(tuple(r) for r in decontamination.decontaminate(docs, bench).collect())
    monkeypatch.setattr(decontamination, "FEW", 0)
    assert few == Counter(tuple(r) for r in decontamination.decontaminate(docs, bench).collect())


def test_decontamination_runs_no_python(spark):
    plan = queries.QUERIES["op12_decontamination"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("within", [1, 3, 12])
def test_proximity_against_brute_force(spark, within):
    rng = random.Random(within)
    vocabulary = [f"v{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    items = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 3)))) for i in range(8)] + [(9, "v1 v1 v2"), (10, "v3 zzz")]
    scratch = shared.Scratch(spark, "t")
    offsets, owners, terms = decontamination.windows_of(spark.createDataFrame(items, "item_id long, text string"), scratch)
    index = decontamination.build_index(spark.createDataFrame(docs, "doc_id long, text string"), terms, scratch)
    got = {(r["item"], r["key"], r["pos"]) for r in decontamination.proximity_matches(index, offsets, within).join(owners, "window").join(index.texts, "row").collect()}
    times = Counter(w for _, t in docs for w in words(t))
    want = set()
    for item, text in items:
        w = words(text)
        if any(not times[x] for x in w):
            continue
        rare = min(range(len(w)), key=lambda i: (times[w[i]], i))
        for doc, t in docs:
            d = words(t)
            want |= {(item, doc, p) for p, x in enumerate(d) if x == w[rare] and all(y in d[max(0, p - within) : p + within + 1] for y in w)}
    assert got == want


# ---------------------------------------------------------------- 13


def plain_clusters(rows, k=40, rounds=5, dim=64):
    kept = [(i, np.array([int(np.floor(256.0 * float(x))) for x in e], object)) for i, e in rows if e is not None and len(e) == dim and all(x is not None and np.isfinite(x) for x in e)]
    starts = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), list(r[1])))[:k]
    c = [x for _, x in starts]

    def told(x):
        far = [int(((x - y) ** 2).sum()) for y in c]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        where = [told(x)[0] for _, x in kept]
        for j in range(len(c)):
            own = [x for (_, x), w in zip(kept, where, strict=True) if w == j]
            if own:
                c[j] = sum(own) // len(own)
    where = [told(x) for _, x in kept]
    inertia = Counter()
    for j, d in where:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), (j, d) in zip(kept, where, strict=True))


@pytest.mark.parametrize("what", ["odd", "few", "empty"])
def test_clustering_against_brute_force(spark, what):
    rng = np.random.default_rng(6)
    rows = []
    if what != "empty":
        base = rng.normal(0, 0.2, (5, 64))
        rows = [(i, [float(np.float32(x)) for x in base[i % 5] + rng.normal(0, 0.02, 64)]) for i in range(60 if what == "odd" else 9)]
    if what == "odd":
        rows += [(100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 65), (104, [float("nan")] + [0.1] * 63), (105, [float("inf")] + [0.1] * 63), (106, [None] + [0.1] * 63), (107, [0.0] * 64), (107, [0.0] * 64), (107, [0.25] * 64), (None, [0.1] * 64), (108, [-1000.0] * 64), *rows[:3]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("cluster", "distance", "inertia", "label", "x")}).repartition(3)
    got = Counter(tuple(r) for r in clustering.cluster(table).collect())
    assert got == plain_clusters(rows)


def test_components_beyond_the_bound_are_held(spark):
    rows = [(1, [1e30] * 64), (2, [-1e30] * 64), (3, [0.0] * 64)]
    got = {r["vec_id"]: r["distance"] for r in clustering.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1, rounds=0).collect()}
    assert len(got) == 3 and all(0 <= d < 1 << 63 for d in got.values()) and max(got.values()) in (1 << 62, 1 << 60)
