import random
from collections import Counter, defaultdict

import pytest

from tidemart.llm import jaccard_join


def brute(rows, threshold=0.8, size=5):
    """doc_id -> (class_id, copy_of, n_links) by comparing all pairs of sets."""
    sets = {}
    for d, t in rows:
        w = (t or "").encode().split()
        n = min(size, len(w))
        sets[d] = frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()
    by = defaultdict(list)
    for d, s in sets.items():
        by[s].append(d)
    reps = {min(v): s for s, v in by.items()}
    up = {r: r for r in reps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = Counter()
    for a in reps:
        for b in reps:
            if a < b and reps[a] and reps[b] and len(reps[a] & reps[b]) >= threshold * len(reps[a] | reps[b]) - 1e-12:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (find(min(v)), min(v), links[min(v)]) for v in by.values() for d in v}


def near_copies(rng, n, base, edits):
    words = [f"w{rng.randrange(500)}" for _ in range(base)]
    out = []
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(base)] = f"e{rng.randrange(100_000)}"
        out.append(" ".join(own))
    return out


def corpus():
    rng = random.Random(4)
    texts = near_copies(rng, 60, 120, 4) + near_copies(rng, 25, 60, 3) + near_copies(rng, 4, 300, 6)
    texts += [texts[0]] * 20 + ["", None, "  \n", "one two", "one  two", "one two three four five"]
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts, strict=True))


def result(df):
    return {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in df.collect()}


def test_equals_all_pairs(make_docs):
    rows = corpus()
    assert result(jaccard_join.join(make_docs(rows))) == brute(rows)


def test_parts_of_a_large_component_give_the_same(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_DOCS", 9)
    rows = corpus()
    assert result(jaccard_join.join(make_docs(rows))) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(make_docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, "z"), (3, "q r")]
    got = sorted(((r.doc_id is None, r.doc_id, r.class_id, r.copy_of, r.n_links)
                  for r in jaccard_join.join(make_docs(rows)).collect()), key=str)
    assert got == sorted([(False, 1, 1, 1, 0), (False, 1, 1, 1, 0), (True, None, None, None, 0), (False, 2, 1, 1, 0),
                          (False, 3, 3, 3, 0), (False, 3, 3, 3, 0)], key=str)
    assert jaccard_join.join(make_docs([])).count() == 0


def test_banding_reaches_the_recall():
    for s, recall in ((0.8, 0.9999), (0.5, 0.99), (0.95, 0.999)):
        bands, rows = jaccard_join.banding(s, recall)
        assert 1 - (1 - s ** rows) ** bands >= recall and bands * rows <= jaccard_join.MAX_HASHES


def test_a_recall_out_of_reach_is_refused():
    with pytest.raises(ValueError, match="can't find"):
        jaccard_join.banding(0.05, 0.9999)
    assert jaccard_join.banding(0.8, 0.9999) == (24, 5)


def test_linking_sets_takes_few_bytes_a_gram():
    import tracemalloc
    from fractions import Fraction

    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    sets = [np.unique(np.append(base, rng.integers(0, 1 << 63, 600, dtype=np.uint64))) for _ in range(200)]
    tracemalloc.start()
    try:
        links = jaccard_join.linked(sets, Fraction(1, 2))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert links.sum() == 200 * 199
    assert most < 40 * sum(map(len, sets))
