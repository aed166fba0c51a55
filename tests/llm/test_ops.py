"""Each operator against brute force, exact round trips or held-out accuracy, and on odd tables."""

import base64
import hashlib
import io
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoframe.llm import bpe, embedding_dedup, language_id, line_dedup, media, ngram_join, packing, quality, queries, shared, url_filter, warc

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def components_of(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


#: Names that operators use within, as extra columns of a table.
CLASHES = ("id", "th", "key", "n", "root", "score", "number", "__row", "__th", "__once", "__text", "n_lines", "n_kept", "piece", "start", "length", "row", "told", "lang_pred", "predicted", "packed", "numbers")


def odd_documents(spark):
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(40000))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "One  TWO"), (6, "a b c d e"), (7, "a b c d e f"), (8, "A B C D E"), (9, long), (10, long + " more"), (11, "x" * 300000), (12, "é" * 2000 + " ñ\u00a0ü \U0001f600"), (None, "a b c d e"), (4, "one two"), (13, "12 34 !!"), (14, "end<|endoftext|>end it's İstanbul Σας")]
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS).withColumns({c: F.lit(1) for c in CLASHES})


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- shared


def test_word_hashes_do_not_depend_on_slices():
    text = ("Aa bb\tcc\n" * 50 + "z" * 700 + " q" + "y" * 400).encode()
    data = np.frombuffer(text + b"next one", np.uint8)
    offsets = np.array([0, len(text), len(text), len(data)])
    whole = shared.word_hashes(data, offsets)
    for size in (7, 64, 333, 1024):
        part = shared.word_hashes(data, offsets, slice_bytes=size)
        assert (part[0] == whole[0]).all() and (part[1] == whole[1]).all()
    assert whole[1].tolist() == [0, 152, 152, 154]
    assert len(set(whole[0].tolist())) == 7
    assert (shared.word_hashes(np.frombuffer(b"AB", np.uint8), np.array([0, 2]))[0] == shared.word_hashes(np.frombuffer(b"ab", np.uint8), np.array([0, 2]))[0]).all()


def test_runs_split_letters_digits_and_marks():
    data = np.frombuffer("ab12*** é!".encode(), np.uint8)
    assert shared.word_hashes(data, np.array([0, len(data)]), classes=shared.RUNS)[1].tolist() == [0, 5]


@pytest.mark.parametrize("few", [0, 1000])
def test_components(spark, few):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 50)]
    got = {r["id"]: r["root"] for r in shared.components(shared.Scratch(spark, "t"), spark.createDataFrame(links, "a long, b long"), few=few).collect()}
    want = components_of({x for p in links for x in p}, links)
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(sum(v == r for v in want.values()) == 1 for k, r in want.items() if k not in got)


# ---------------------------------------------------------------- 1


def jaccard_brute(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    pairs = {(a, b) for v in lists.values() for a in v for b in v if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = components_of(range(len(rows)), links)
    least = {}
    for i, c in comp.items():
        if rows[i][0] is not None:
            least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], len(sets[i]), least.get(comp[i])) for i in comp), key=str)


@pytest.mark.parametrize("what", ["sf", "odd", "near", "empty"])
def test_ngram_join(spark, what):
    if what == "sf":
        docs = queries.table(spark, SF, "documents")
    elif what == "near":
        rng = np.random.default_rng(5)
        base = [f"v{i}" for i in range(120)]
        rows = []
        for i in range(150):  # one group of near copies, chains of short texts, a passage in many texts
            words = list(base)
            for j in rng.integers(0, 120, int(rng.integers(0, 5))):
                words[j] = f"n{rng.integers(1000)}"
            rows.append((i, " ".join(words)))
        rows += [(200 + i, " ".join(f"s{j}" for j in range(int(rng.integers(0, 3)), int(rng.integers(8, 19))))) for i in range(120)]
        rows += [(400 + i, " ".join(base[:60] + [f"u{i}_{j}" for j in range(60)])) for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    else:
        docs = odd_documents(spark) if what == "odd" else empty_documents(spark)
    got = sorted((tuple(r) for r in ngram_join.join_documents(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == jaccard_brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_light_sets_need_no_verification():
    rng = np.random.default_rng(9)
    for _ in range(300):
        universe = rng.integers(1, 1 << 60, 14, dtype=np.uint64)
        s, t = (np.sort(rng.choice(universe, int(rng.integers(1, 12)), replace=False)) for _ in range(2))
        common = len(np.intersect1d(s, t))
        linked = 100 * common >= 80 * (len(s) + len(t) - common)
        c = ngram_join.needed_overlap(len(s), len(t))
        share = {k for k in ngram_join.subsets(s, 12) if k[1] == c} & {k for k in ngram_join.subsets(t, 12) if k[1] == c}
        assert bool(share) == linked


def test_keep_one(spark):
    kept = ngram_join.keep_one(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 6, 7, 9, 11, 12, 13, 14], key=str)


# ---------------------------------------------------------------- 2


def test_tokens_are_the_librarys(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = [r["text"] for r in queries.table(spark, SF, "documents").select("text").limit(300).collect()]
    texts += [r["text"] or "" for r in odd_documents(spark).collect()] + ["don't WE'LL 's x'sy ²½ ªº µ ÀÉ a\u0301b a \u0301 x\r\ny\u2028z\x1c\x85q \u3000 ａ", "İ ſ Ω ς ΑΣ ß ẞ", "a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|> x", "x<|ENDOFTEXT|>y <|end oftext|> é<|endoftext|>\u0301a"]
    for t in texts:
        assert packing.token_ids(t, path) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def check_packed(rows, docs, path, sequence=4096):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in by_sequence.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at and length > 0
            at += length
        assert at <= sequence
    for doc_id, text in docs.items():
        ids = packing.token_ids(text, path) + (1).to_bytes(4, "little")
        got = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got] == [(k, at // 4, len(ids[at : at + 4 * sequence]) // 4, zlib.crc32(ids[at : at + 4 * sequence])) for k, at in enumerate(range(0, len(ids), 4 * sequence))]
    return len(by_sequence), -(-sum(r["length"] for r in rows) // sequence)


def test_packing(spark):
    path = queries.tokenizer_path("word_bpe_49k.json")
    docs = queries.table(spark, SF, "documents")
    used, least = check_packed(queries.op2_packing(spark, SF).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, path)
    assert used <= least + 2
    odd = odd_documents(spark).where("doc_id is not null and doc_id <> 4")
    check_packed(packing.pack_documents(odd, path).collect(), {r["doc_id"]: r["text"] for r in odd.collect()}, path)
    assert packing.pack_documents(odd_documents(spark), path).where("doc_id = 4 or doc_id is null").count() == 3
    assert packing.pack_documents(empty_documents(spark), path).count() == 0


def test_best_two_fit_replaces_the_smallest():
    number, offset = packing.pack(np.array([60, 30, 7, 6, 25, 20, 14]), 100)
    fill = np.bincount(number, weights=[60, 30, 7, 6, 25, 20, 14])
    assert fill.max() <= 100 and len(fill) == 2
    rng = np.random.default_rng(1)
    for _ in range(30):
        x = rng.integers(1, 101, int(rng.integers(1, 400)))
        number, offset = packing.pack(x, 100)
        fill = np.bincount(number, weights=x)
        assert fill.max() <= 100 and (fill > 0).all() and len(fill) <= -(-x.sum() // 100) * 1.25 + 1


# ---------------------------------------------------------------- 3


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bit_parallel_edit_distance():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a, b = ("".join("abcé"[i] for i in rng.integers(0, 4, int(rng.integers(0, 14)))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == edit_distance(a, b)


def test_line_dedup_against_brute_force(spark):
    """What stays is what all similar pairs of lines leave, by edit distance alone."""
    rng = np.random.default_rng(8)
    lines = [" ".join(f"word{rng.integers(500)}" for _ in range(int(rng.integers(3, 40)))) for _ in range(60)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(4):
            line = lines[rng.integers(60)].split()
            if rng.random() < 0.4:
                line[rng.integers(len(line))] += "s"
            text.append(" ".join(line).upper() if rng.random() < 0.2 else "  " + " ".join(line))
        rows.append((i, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    norm = lambda x: line_dedup.normalise(x.encode()).decode()
    distinct = sorted({norm(x) for _, t in rows for x in t.split("\n")})
    links = [(a, b) for a in distinct for b in distinct if a < b and edit_distance(a, b) <= 0.1 * max(len(a), len(b)) + 1e-9]
    assert links
    comp = components_of(distinct, links)
    seen, th = set(), {r["doc_id"]: r["th"] for r in docs.select("doc_id", F.xxhash64("text").alias("th")).collect()}
    for i, text in sorted(rows, key=lambda r: (r[0], th[r[0]])):
        keep = []
        for line in text.split("\n"):
            if comp[norm(line)] not in seen:
                seen.add(comp[norm(line)])
                keep.append(line)
        assert got[i]["text"] == "\n".join(keep) and (got[i]["n_lines"], got[i]["n_kept"]) == (4, len(keep))


def edited(rng, line, edits, letters="abcdef é"):
    line = list(line)
    for _ in range(edits):
        at = int(rng.integers(max(1, len(line))))
        line[at : at + int(rng.integers(2))] = [letters[rng.integers(len(letters))]] if rng.random() < 0.7 else []
    return line_dedup.normalise("".join(line).encode()).decode()


def keys_of(line):
    raw = np.frombuffer(line.encode(), np.uint8)
    return set(line_dedup.entries(raw, np.array([0, len(raw)]), line_dedup.Seen())[0].tolist())


def meets(a, b):
    return bool(keys_of(a) & keys_of(b))


def test_short_similar_lines_always_meet():
    rng = np.random.default_rng(31)
    tried = 0
    for _ in range(3000):
        a = edited(rng, "".join("abcdef é"[i] for i in rng.integers(0, 8, int(rng.integers(10, 64)))), 0)
        b = edited(rng, a, int(rng.integers(1, 8)))
        longer = max(len(a), len(b))
        if a != b and 0 < longer <= line_dedup.SHORT and edit_distance(a, b) <= 0.1 * longer + 1e-9:
            tried += 1
            assert meets(a, b), (a, b)
    assert tried > 500


@pytest.mark.parametrize("words", [5, 9, 12, 20, 30, 40, 80])
@pytest.mark.parametrize("change", ["word", "letter"])
def test_recall_of_lines_with_one_change(words, change):
    """Of similar lines that differ in one word or one letter, at least 0.95 meet, whatever their length."""
    rng = np.random.default_rng(32)
    vocabulary = ["".join("abcdefghij"[i] for i in rng.integers(0, 10, int(rng.integers(2, 9)))) for _ in range(3000)]
    met = []
    while len(met) < 300:
        a = [vocabulary[i] for i in rng.integers(0, 3000, words)]
        b, at = list(a), int(rng.integers(words))
        b[at] = vocabulary[rng.integers(3000)] if change == "word" else b[at][:-1] + "z"
        x, y = " ".join(a), " ".join(b)
        if x != y and line_dedup.within(x, y, line_dedup.most_edits(max(len(x), len(y)))):
            met.append(meets(x, y))
    assert np.mean(met) >= 0.95


def test_recall_against_all_pairs(spark):
    """Of all pairs of lines of the documents that are similar by edit distance, at least 0.95 meet."""
    lines = set()
    for r in queries.table(spark, SF, "documents").select("text").collect():
        lines |= {line_dedup.normalise(x).decode() for x in (r["text"] or "").encode().split(b"\n")}
    lines = sorted(lines - {""}, key=lambda x: (len(x), x))
    held = line_dedup.Lines(lines)
    similar = []
    for i in range(len(lines)):
        j = np.arange(i + 1, np.searchsorted(held.chars, held.chars[i] / 0.9 + 2))
        similar += [(lines[i], lines[k]) for k in j[held.similar(np.full(len(j), i), j)]]
    assert len(similar) > 200
    keys = {x: keys_of(x) for x in {x for p in similar for x in p}}
    assert np.mean([bool(keys[a] & keys[b]) for a, b in similar]) >= 0.95


def test_filters_of_line_pairs_lose_none():
    rng = np.random.default_rng(33)
    letters = "abcdef é日"
    for _ in range(300):
        a = "".join(letters[i] for i in rng.integers(0, 9, int(rng.integers(1, 90))))
        b = edited(rng, a, int(rng.integers(0, 12)))
        d = edit_distance(a, b)
        held = line_dedup.Lines([a, b])
        assert held.similar(np.array([0]), np.array([1]))[0] == (d <= line_dedup.most_edits(max(len(a), len(b))))
        assert line_dedup.aligned(a.split(" "), b.split(" "), 999) >= d
        assert all(line_dedup.within(a, b, most) == (d <= most) for most in range(14))


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "aé漢😀 ", "".join(chr(0x4E00 + i) for i in range(600))])
def test_batches_of_edit_distances(letters):
    """Lines of one to forty machine words of diagonals, in one batch, as the plain distance has it."""
    rng = np.random.default_rng(38)
    lines = []
    for length in (1, 3, 9, 50, 300, 660, 2600) * 3:
        x = "".join(letters[i] for i in rng.integers(0, len(letters), int(rng.integers(1, length + 1))))
        lines += [x, *(edited(rng, x, int(rng.integers(0, len(x) * 0.14 + 2))) or "a" for _ in range(3))]
    i, j = np.array([(i, j) for i in range(len(lines)) for j in range(i) if i // 4 == j // 4 or len(lines[i] + lines[j]) < 150]).T
    want = [line_dedup.edit_distance(lines[x], lines[y]) <= line_dedup.most_edits(max(len(lines[x]), len(lines[y]))) for x, y in zip(i, j, strict=True)]
    assert any(want) and not all(want)
    assert line_dedup.Lines(lines).similar(i, j).tolist() == want


def test_groups_of_sorted_targets():
    """Blocks of a target, however many and in however many batches, give the groups of its entries."""
    rng = np.random.default_rng(37)
    keys, lines, target = rng.integers(0, 900, 4000).astype(np.uint64), rng.integers(0, 60, 4000).astype(np.uint64), np.sort(rng.integers(0, 5, 40))
    keys[:900] = 7  # one key with very many
    keys = keys // np.uint64(5) * np.uint64(5) + np.repeat(target, 100).astype(np.uint64)  # a key has one target
    blocks = [pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *(pa.array([x[i : i + 100].tobytes()], pa.binary()) for x in (keys, lines))], names=["target", "keys", "lines"]) for t, i in zip(target.tolist(), range(0, 4000, 100), strict=True)]
    got = sorted(tuple(r.values()) for b in line_dedup._meet(iter(blocks)) for r in b.to_pylist())
    assert got == sorted(tuple(r.values()) for r in line_dedup._groups(keys, lines).to_pylist()) and len(got) > 1000


def test_lists_are_compared_by_blocks(spark, monkeypatch):
    """Lists longer than a block give the links of all pairs across components."""
    rng = np.random.default_rng(38)
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    base = " ".join(f"w{i}" for i in range(12))
    bodies = [edited(rng, base, int(rng.integers(1, 6)), "xyz") for _ in range(60)]
    rows = [(k, i, i % 50, n) for k, n in ((1, 45), (2, 15), (3, 2)) for i in rng.choice(60, n, replace=False).tolist()]
    got = {tuple(sorted(r)) for r in line_dedup.in_lists(spark.createDataFrame(rows, "key long, id long, comp long, length long"), spark.createDataFrame(list(enumerate(bodies)), "line long, body string")).collect()}
    want = {tuple(sorted((i, j))) for k, i, c, _ in rows for k2, j, c2, _ in rows if k == k2 and i < j and c != c2 and edit_distance(bodies[i], bodies[j]) <= 0.1 * max(len(bodies[i]), len(bodies[j])) + 1e-9}
    assert got == want and want


def test_scripts_without_spaces_meet():
    rng = np.random.default_rng(39)
    met = []
    for _ in range(100):
        a = "".join(chr(0x4E00 + i) for i in rng.integers(0, 2000, int(rng.integers(70, 200))))
        at = int(rng.integers(len(a)))
        met.append(meets(a, a[:at] + "々" + a[at + 1 :]))
    assert np.mean(met) >= 0.95


def test_line_dedup_links_all_short_similar_lines(spark):
    """By edit similarity alone: one typo in a short line flips many SimHash bits, yet the lines are linked."""
    rng = np.random.default_rng(34)
    lines = []
    for _ in range(60):
        a = " ".join("".join("abcdefghij"[i] for i in rng.integers(0, 10, int(rng.integers(3, 9)))) for _ in range(int(rng.integers(3, 9))))[: line_dedup.SHORT - 6].strip()
        lines += [a, *(edited(rng, a, int(rng.integers(1, 4)), "abcdefghij") for _ in range(3))]
    lines = [x for x in dict.fromkeys(lines) if x]
    links = [(a, b) for a in lines for b in lines if a < b and edit_distance(a, b) <= 0.1 * max(len(a), len(b)) + 1e-9]
    comp = components_of(lines, links)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_kept"] for r in line_dedup.dedup_lines(docs).collect()}
    seen = set()
    for i, line in enumerate(lines):
        assert got[i] == (comp[line] not in seen), line
        seen.add(comp[line])
    assert 60 <= len(seen) < len(lines)


def test_line_dedup_by_edit_similarity_alone(spark):
    """Links are those of all pairs by edit similarity alone."""
    rng = np.random.default_rng(35)
    lines = []
    for _ in range(60):
        words = [f"word{rng.integers(500)}" for _ in range(int(rng.integers(14, 60)))]
        lines.append(" ".join(words))
        for _ in range(2):
            some = list(words)
            some[rng.integers(len(some))] += "s"
            lines.append(" ".join(some))
    lines = list(dict.fromkeys(lines))
    links = [(a, b) for a in lines for b in lines if a < b and line_dedup.within(a, b, int(0.1 * max(len(a), len(b)) + 1e-9))]
    comp = components_of(lines, links)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_kept"] for r in line_dedup.dedup_lines(docs).collect()}
    seen = set()
    for i, line in enumerate(lines):
        assert got[i] == (comp[line] not in seen), line
        seen.add(comp[line])


def test_line_dedup_on_odd_rows(spark):
    odd = odd_documents(spark)
    got = line_dedup.dedup_lines(odd)
    assert got.columns == [*odd.columns, "n_lines_", "n_kept_"] and got.count() == odd.count()
    assert got.where("n_lines <> 1 or n_kept <> 1 or __th <> 1").count() == 0
    by = {r["doc_id"]: r for r in got.where("doc_id is not null").collect()}
    assert by[1]["text"] is None and by[2]["text"] == "" and by[3]["text"] == " \t\n " and by[5]["text"] == "" and by[4]["text"] == "one two"
    assert by[5]["n_kept_"] == 0 and by[11]["n_kept_"] == 1
    assert line_dedup.dedup_lines(empty_documents(spark)).count() == 0


# ---------------------------------------------------------------- 4


def test_png_round_trip():
    for raw in (b"", b"a", b"x" * 64, bytes(range(256)) * 9):
        payload = media.payload_of(raw)
        assert len(payload) % 64 == 0 and len(payload) >= 64 and payload.startswith(raw)
        assert media.from_png(media.to_png(payload)) == payload
    damaged = bytearray(media.to_png(payload))
    damaged[60] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        media.from_png(bytes(damaged))


@pytest.mark.parametrize("what", ["sf", "odd", "empty"])
def test_media(spark, what):
    docs = {"sf": lambda: queries.table(spark, SF, "documents"), "odd": lambda: odd_documents(spark), "empty": lambda: empty_documents(spark)}[what]()
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "format", "width", "height", "depth", "digest"]
    found = media.media_columns(docs)
    assert set(names) | {"shard", "offset", "length"} == set(found.columns)
    got = sorted((tuple(r) for r in found.select(names).collect()), key=str)
    want = []
    for r in docs.select("doc_id", "text").collect():
        raw = (r["text"] or "").encode()
        p = media.payload_of(raw)
        m = media.to_png(p)
        shares = [p.count(bytes([b])) / len(p) for b in set(p)]
        feature = f"png:64x{len(p) // 64}x8:mean={sum(p) / len(p):.4f}:entropy={-sum(x * math.log2(x) for x in shares):.4f}:max={max(p)}"
        digest = hashlib.sha256(p).hexdigest()
        want.append((r["doc_id"], len(raw), len(p), digest, zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature, "png", 64, len(p) // 64, 8, digest.upper()))
    assert got == sorted(want, key=str)


def test_shards_are_tar_files_and_headers_suffice(spark):
    from pyarrow import fs

    scratch = shared.Scratch(spark, "media")
    rows, index = media.store(queries.table(spark, "/root/testdata/sf0.001", "documents"), scratch)
    system, base = fs.FileSystem.from_uri(scratch.folder("shards"))
    held = {}
    for f in system.get_file_info(fs.FileSelector(base)):
        with system.open_input_stream(f.path) as s:
            held |= dict(media.tar_members(s.read()))
    assert {hashlib.sha256(media.from_png(v)).hexdigest() + ".png" for v in held.values()} == set(held)
    meta = media.metadata(index, scratch.folder("shards")).collect()
    assert {bytes(m["digest"]).hex() + ".png" for m in meta} == set(held) and all((m["format"], m["width"], m["depth"]) == ("png", 64, 8) for m in meta)
    assert rows.select("digest").distinct().count() == index.count()


# ---------------------------------------------------------------- 5


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc(spark):
    long, other = "é" * 600, "y" * 1000
    rows = [(1, "http://a/", long), (2, None, long), (9, "http://c/\r\nX: y", long), (3, "u", None), (4, "u", ""), (5, "u", "s" * 999), (6, "u", "s" * 999), (7, "u", other), (7, "u", other), (8, "u", "z\r\n\r\nWARC/1.1\r\n" * 90), (None, "u", other)]
    got = sorted((tuple(r) for r in warc.archive(pages_of(spark, rows)).collect()), key=str)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        top = max((k for k, _, h in rows if k is not None and (h or "") == (html or "")), default=None) if len(raw) >= 1000 else i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if top == i else "revisit", None if top == i else top))
    assert got == sorted(want, key=str)
    assert warc.archive(pages_of(spark, [])).count() == 0


def test_warc_of_long_pages_has_a_dictionary():
    rng = np.random.default_rng(40)
    words = [f"word{rng.integers(10**6)}" for _ in range(3000)]
    pages = [" ".join(words[i] for i in rng.integers(0, 3000, 40000)).encode() for _ in range(3)]
    long = [warc.record(i, f"http://h/{i}", x, "d", len(x), None) for i, x in enumerate(pages)]
    short = [warc.record(i, f"http://h/{i}", pages[0][600 * i : 600 * i + 600], "d", 600, None) for i in range(3, 60)]

    class Sink(io.BytesIO):
        def close(self):
            pass

    sink = Sink()
    w = warc.Writer(sink, sample=300_000)  # full after two records
    for r in long + short:
        w.add(r)
    w.close()
    raw = sink.getvalue()
    assert int.from_bytes(raw[4:8], "little") > 1000
    assert list(warc.read_archive(io.BytesIO(raw))) == long + short


def test_archive_has_a_leading_dictionary_and_single_frames():
    import zstandard

    class Sink(io.BytesIO):
        def close(self):
            pass

    sink = Sink()
    w = warc.Writer(sink, sample=20000)
    records = [warc.record(i, f"http://h/{i}", f"<html>body of page {i} {'text ' * (i % 7)}</html>".encode(), "d", 1, None) for i in range(300)]
    for r in records:
        w.add(r)
    w.close()
    raw = sink.getvalue()
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_MAGIC
    size = int.from_bytes(raw[4:8], "little")
    assert size > 0
    assert list(warc.read_archive(io.BytesIO(raw))) == records
    frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size])).decompressobj()
    assert frame.decompress(raw[8 + size :]) == records[0]
    plain = sum(len(zstandard.ZstdCompressor(level=6).compress(r)) for r in records)
    assert len(raw) - size < plain
    with pytest.raises(Exception):
        list(warc.read_archive(io.BytesIO(raw[:-5])))


# ---------------------------------------------------------------- 6


@pytest.mark.parametrize("what", ["sf", "odd", "empty"])
def test_byte_bpe(spark, what):
    import public_tokenizers
    import tiktoken

    path = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = {"sf": lambda: queries.table(spark, SF, "documents"), "odd": lambda: odd_documents(spark), "empty": lambda: empty_documents(spark)}[what]()
    got = sorted((tuple(r) for r in bpe.encode_texts(docs, path, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = e.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_safe_boundaries_change_nothing():
    import public_tokenizers

    path = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    rng = np.random.default_rng(4)
    parts = ["word", " ", "  ", "\n", "\n\n ", "'s", "12", "é", "\u00a0", "!?", "\t", "\x1c", "日本", "\u2003", "'", "。", "語", "’s", "́"]
    text = "".join(parts[i] for i in rng.integers(0, len(parts), 4000))
    encoding = bpe.codec(path, public_tokenizers.PATTERN)[0]
    for most in (1, 5, 50):
        cut = list(bpe.pieces(text, most))
        assert "".join(cut) == text and len(cut) > 50
        assert [i for p in cut for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)
    ids = bpe.encode(text, path, public_tokenizers.PATTERN)
    assert bpe.decode(ids, path, public_tokenizers.PATTERN) == text.encode()
    assert bpe.decode(ids[:1000], path, public_tokenizers.PATTERN) + bpe.decode(ids[1000:], path, public_tokenizers.PATTERN) == text.encode()


# ---------------------------------------------------------------- 7


@pytest.mark.parametrize("cell", [2000, 40])
def test_embedding_dedup(spark, cell):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        x = rng.normal(size=12)
        if i % 3 == 0 and rows:
            x = np.array(rows[int(rng.integers(len(rows)))][2]) + rng.normal(size=12) * 0.12
        rows.append((i, int(i % 2), [float(np.float32(v)) for v in x]))
    rows += [(500 + i, 1, rows[7][2]) for i in range(30)] + [(600, 1, None), (601, 1, [0.0] * 12), (602, 1, [float("nan")] * 12), (603, 1, [None] * 12), (604, None, rows[7][2]), (605, 1, [1.0, 2.0]), (606, 1, [2.0, 4.0]), (607, 1, []), (None, 1, rows[7][2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("id", F.lit(0))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df, cell=cell).collect()}

    def good(r):
        return r[1] is not None and r[2] and all(v is not None and np.isfinite(v) for v in r[2]) and any(r[2])

    links, n = [], defaultdict(int)
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            p, q = rows[a], rows[b]
            if good(p) and good(q) and p[1] == q[1] and len(p[2]) == len(q[2]):
                x, y = np.array(p[2]), np.array(q[2])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links.append((a, b))
                    n[a] += 1
                    n[b] += 1
    comp = components_of(range(len(rows)), links)
    least = {}
    for i, c in comp.items():
        if rows[i][0] is not None:
            least[c] = min(least.get(c, 10**9), rows[i][0])
    assert got == {rows[i][0]: (n[i], least[comp[i]], rows[i][0] == least[comp[i]]) for i in comp}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


# ---------------------------------------------------------------- 8


def test_shift_and_against_regular_expressions():
    rng = np.random.default_rng(2)
    globs = ["a*b", "**b", "ab**", "*.com/en/**", "a**b*", "*", "**", "", "abc" * 30 + "**"]
    urls = ["", "ab", "a/b", "aab", "abc" * 30, "abc" * 40 + "/x", "x.com/en/1", "x/y.com/en/1", "ébc"] + ["".join("ab/."[i] for i in rng.integers(0, 4, int(rng.integers(0, 12)))) for _ in range(400)]
    raw = [u.encode() for u in urls]
    hit = url_filter.ShiftAnd(globs).match(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
    for k, g in enumerate(globs):
        pattern = re.compile("".join(".*" if t == "**" else "[^/]*" if t == "*" else re.escape(t) for t in re.findall(r"\*\*|\*|[^*]", g)).encode(), re.S)
        assert hit[:, k].tolist() == [bool(pattern.fullmatch(x)) for x in raw]


def test_url_filter(spark):
    urls = {1: None, 2: "no scheme", 3: "HTTP://A.Example.COM/en/7x?q#f", 4: "http://com/en/", 5: "http://xcom/en/1", 6: "x://b.net/de/8", 7: "x://b.example.net/de/8/9", 8: "x://foo/a.com/en/1", 9: "x://u@org/es/#y", 10: "://org?x=/es/", 11: "x://org/ES/", 12: "a://b.com/en/?://c.org/es/", 13: "x://b.com/en/\nmore", 14: ""}
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.filter_urls(spark.createDataFrame(list(urls.items()), "page_id long, url string").withColumn("rule", F.lit(1)), queries.URL_RULES).collect()}
    assert got[1] == got[2] == got[14] == ("", "", None, "allow")
    assert got[3] == ("a.example.com", "/en/7x", "example.com/en/7", "allow")
    assert got[4] == ("com", "/en/", "com/en/", "block") and got[5] == ("xcom", "/en/1", None, "allow")
    assert got[6][2:] == ("net/de/", "allow") and got[7][2:] == ("example.net/de/8", "block")
    assert got[8][2:] == (None, "allow") and got[9] == ("u@org", "/es/", None, "allow") and got[10] == ("org", "", None, "allow")
    assert got[11][2:] == (None, "allow") and got[12] == ("b.com", "/en/", "com/en/", "block") and got[13][1] == "/en/\nmore"
    assert url_filter.filter_urls(pages_of(spark, []), queries.URL_RULES).count() == 0
    assert url_filter.filter_urls(queries.table(spark, SF, "pages"), []).where("verdict = 'allow'").count() == 250


# ---------------------------------------------------------------- 9


def test_language_id_is_right_on_rows_held_out(spark):
    told = queries.op9_language_id(spark, SF).join(queries.table(spark, SF, "documents").select("doc_id", "lang", "n_chars"), "doc_id").where("held_out").collect()
    assert len(told) > 250
    assert np.mean([r["lang_pred"] == r["lang"] for r in told if r["n_chars"] > 60]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in told)


def test_language_id_on_odd_rows(spark):
    docs = queries.table(spark, SF, "documents")
    model = language_id.train(docs, language_id.learnable(F.col("doc_id"), 3, 1), language_id.Settings(steps=60))
    got = {r["doc_id"]: (r["lang_pred_"], r["score_"]) for r in language_id.classify(odd_documents(spark), model).collect()}
    assert got[1] == got[2] == got[3] == got[13] == ("und", 0.0) and got[12][0] in model.labels and len(got) == 15
    assert language_id.classify(empty_documents(spark), model).count() == 0
    nothing = language_id.train(empty_documents(spark), language_id.learnable(F.col("doc_id"), 3, 1))
    assert nothing is None and language_id.classify(odd_documents(spark), nothing).where("lang_pred_ <> 'und'").count() == 0


def test_pair_tables_equal_the_plain_convolution():
    model = language_id.ByteCnn(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    pre, _ = model._pooled(np.pad(x, ((0, 0), (0, 4))))
    logit = np.maximum(pre, 0) @ model.p["V"] + model.p["c"]
    e = np.exp(logit - logit.max(1, keepdims=True))
    assert np.allclose(model.probabilities(x), e / e.sum(1, keepdims=True), atol=1e-5)


# ---------------------------------------------------------------- 10


def test_quality_is_right_on_rows_held_out(spark):
    labels = queries.table(spark, SF, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    told = queries.op10_quality(spark, SF).join(labels, "doc_id").where("held_out and quality is not null").collect()
    assert len(told) > 60
    assert np.mean([r["predicted"] == r["quality"] for r in told]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in told)


def test_quality_on_odd_rows(spark):
    model = quality.train(queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels"), language_id.learnable(F.col("doc_id"), 4, 2), quality.Settings(steps=50))
    got = quality.score(odd_documents(spark), model).collect()
    by = {r["doc_id"]: r["score_"] for r in got}
    assert len(got) == 16 and by[1] == by[2] == by[3] and all(0 <= r["score_"] <= 1 for r in got)
    assert quality.score(empty_documents(spark), model).count() == 0
    none = quality.train(empty_documents(spark), spark.createDataFrame([], "doc_id long, quality int"), language_id.learnable(F.col("doc_id"), 4, 2))
    assert {r["score_"] for r in quality.score(odd_documents(spark), none).collect()} == {0.5}


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(12)
    for _ in range(200):
        u = rng.integers(1, 1 << 63, 3000, dtype=np.uint64)
        s, t = (np.unique(rng.choice(u, int(rng.integers(1, 2500)))) for _ in range(2))
        bits = [np.frombuffer(ngram_join.parity_bits(x), np.uint8) for x in (s, t)]
        assert ngram_join.least_difference(*bits) <= len(np.setxor1d(s, t)) and ngram_join.least_difference(bits[0], bits[0]) == 0
