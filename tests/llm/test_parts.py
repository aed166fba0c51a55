"""Lists of the n-gram join fall into parts: none between linked sets, many between sets that meet by chance."""

import numpy as np

from chronoframe.llm import ngram_join


def test_parts_keep_linked_sets_together_and_let_chance_go():
    rng = np.random.default_rng(41)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, int(rng.integers(12, 200)), dtype=np.uint64)
        sets += [base, np.append(base[int(len(base) * 0.07) :], rng.integers(0, 1 << 63, int(len(base) * 0.07), dtype=np.uint64))]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    mark = np.array([ngram_join.mark_of(s) for s in sets]).view(np.int64)
    part = ngram_join.parts_of(np.full(len(sets), 3), n, n, mark)
    linked = 0
    for i, s in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(s, sets[j]))
            if 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                linked += 1
                assert part[i] == part[j]
    assert linked >= 50 and (mark < 0).any() and len(np.unique(part)) > 20
