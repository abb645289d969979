import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidemart.llm import lm_scoring as lm

PATH = public_tokenizers.path("byte_bpe_50k.json")


def by_recursion(word, weights):
    """Sum over all segmentations, one by one."""
    if not word:
        return 1.0
    return sum(weights[word[:n]] * by_recursion(word[n:], weights) for n in range(1, len(word) + 1) if word[:n] in weights)


def small_lattice(rng):
    pieces = [b" ", b"a", b"b", b"c", b" a", b" ab", b"ab", b"bc", b"abc", b"ca", b"cab", b"bb"]
    p = np.array([rng.random() for _ in pieces])
    return pieces, p / p.sum()


def test_marginals_by_enumeration():
    rng = random.Random(1)
    pieces, p = small_lattice(rng)
    lattice = lm.Lattice(pieces, np.log(p))
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 10))) for _ in range(80)] + [b"ab" * 40]
    got = lattice.log_marginals(words)
    weights = dict(zip(pieces, p.tolist(), strict=True))
    for w, g in list(zip(words, got, strict=True))[:-1]:
        assert math.isclose(math.exp(g), by_recursion(b" " + w, weights), rel_tol=1e-9)
    assert np.isfinite(got[-1])  # longer than the batched words


def test_expected_counts_by_enumeration():
    rng = random.Random(2)
    pieces, p = small_lattice(rng)
    weights = dict(zip(pieces, p.tolist(), strict=True))

    def uses(word):
        if not word:
            yield 1.0, Counter()
        for n in range(1, len(word) + 1):
            if word[:n] in weights:
                for q, c in uses(word[n:]):
                    yield q * weights[word[:n]], c + Counter([word[:n]])

    words, want = [b"abcab", b"cabb", b"a" * 60], Counter()
    for w in words[:2]:
        all_ways = list(uses(b" " + w))
        total = sum(q for q, _ in all_ways)
        for q, c in all_ways:
            for k, n in c.items():
                want[k] += 3 * n * q / total
    got = lm.Lattice(pieces, np.log(p)).expected(words[:2], np.array([3.0, 3.0]))
    assert np.allclose(got, [want[x] for x in pieces])
    assert lm.Lattice(pieces, np.log(p)).expected(words[2:], np.array([1.0])).sum() > 60


def corpus():
    rng = random.Random(3)
    syllables = ["tion", "er", "ou", "Sch", "é", "an", "th", "日"]
    vocab = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(150)]
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(120)]


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 25])
def test_scores(make_docs, block_bytes):
    rows = corpus() + [(900, None), (901, ""), (None, "no id"), (902, "x\x0by\u2003z\x1c q"), (902, "again"),
                       (903, "unseen" * 5000), (903, "unseen" * 5000)]
    got = lm.score(make_docs(rows), PATH, block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), "END"]
    counts = Counter(w for d, t in rows if not out(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, t in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))
        want[d, out(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(-math.inf < r.score < 0 for r in got)
    known = [r for r in got if r.held_out and r.n_known == r.n_tokens]
    assert sum(r.score for r in known) > 1.02 * sum(r.base_score for r in known)


def test_weights_sum_to_one():
    """All one-word strings over a tiny piece set: mass tends to one with length."""
    pieces = [b" ", b"a", b" a", b"aa"]
    first = np.array([p[0] == 32 for p in pieces])
    log_p, log_stop = lm.normalised(np.array([1.0, 2.0, 3.0, 1.5]), first, 4.0)
    words = [b"a" * n for n in range(1, 60)]
    mass = np.exp(lm.Lattice(pieces, log_p).log_marginals(words) + log_stop).sum()
    empty = math.exp(log_p[0] + log_stop)  # a space alone, which no word is
    assert math.isclose(mass + empty, 1.0, rel_tol=1e-9)


def test_no_training_rows_and_empty_table(make_docs):
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    got = lm.score(make_docs([(held, "a b")]), PATH).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)]
    assert got[0].score < 0
    assert lm.score(make_docs([]), PATH).count() == 0


def test_pieces_score_sums_all_segmentations(make_docs):
    """The vocabulary's scores alone, over segmentations spelt out one by one."""
    pieces = lm.usable_pieces(PATH)
    log_p, log_stop = lm.vocabulary_scores(pieces)
    weight = dict(zip(pieces, np.exp(log_p).tolist(), strict=True))

    def total(rest):
        return 1.0 if not rest else sum(weight[rest[:n]] * total(rest[n:]) for n in range(1, len(rest) + 1) if rest[:n] in weight)

    rows = [(1, "cat cats"), (2, "Dog's"), (3, ""), (4, "zq")]
    ends = sum(1 for d, _ in rows if zlib.crc32(str(d).encode()) % 7 != 2)
    words = {d: lm.words_of(t.encode()) for d, t in rows}
    tokens = sum(len(w) + 1 for d, w in words.items() if zlib.crc32(str(d).encode()) % 7 != 2)
    for r in lm.score(make_docs(rows), PATH).collect():
        want = math.log10(ends / tokens) + sum(
            math.log10(total(b" " + w) * math.exp(log_stop) * (1 - ends / tokens)) for w in words[r.doc_id])
        assert abs(r.pieces_score - want) < 1e-6
