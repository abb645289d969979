"""Substring dedup against every window of every document."""

import hashlib
import random
import re
from collections import Counter

import pytest

from tidemart.llm import substring_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    """(id, n_words, n_removed, kept text, spans, longest doubled length) of each row."""
    texts = [WORDS.findall(t or "") for _, t in rows]

    def flags(n):
        count = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
        return [[i for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1] for w in texts]

    out, longest, n = [], [0] * len(rows), window
    while any(f := flags(n)):
        longest = [n if x else old for x, old in zip(f, longest, strict=True)]
        n *= 2
    for (i, _), w, begins, most in zip(rows, texts, flags(window), longest, strict=True):
        gone = sorted({k for b in begins for k in range(b, b + window)})
        spans = [k for k in gone if k - 1 not in set(gone)]
        runs = [(s, next(n for n in range(1, len(w) + 1) if s + n not in set(gone))) for s in spans]
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in set(gone)), runs, most))
    return out


def run(df, **more):
    got = substring_dedup.dedup(df, with_text=True, longest=True, **more).collect()
    for r in got:
        assert r["kept_sha256"] == hashlib.sha256(r["kept"].encode()).hexdigest()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"], [tuple(s) for s in r["spans"]],
                    r["longest_repeat"]) for r in got), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 3)))
    some = lambda n: [word() for _ in range(n)]
    passage, near, long = some(35), some(34), some(300)
    out = [some(rng.randint(0, 120)) for _ in range(40)]
    out += [some(rng.randint(0, 40)) + passage + some(rng.randint(0, 40)) for _ in range(15)]
    out += [some(5) + near + some(5) for _ in range(6)]
    out += [long] * 4 + [long[:200] + some(3) + long[200:], some(30) + long[20:110]]
    once = some(50)
    out.append(once + some(3) + once)  # repeated within one document only
    out.append(["x"] * 36)  # windows that overlap themselves
    out.append(["y"] * 35)
    texts = ["  \t".join(w) + "\n" * (i % 3) for i, w in enumerate(out)] + [None, "", " \t\n", "  a b "]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, " ".join(passage)), (None, " ".join(passage)), (None, None)]


@pytest.mark.parametrize("block_bytes", [1, 3_000, 1 << 23])
def test_equals_all_windows(make_docs, rows, block_bytes):
    assert run(make_docs(rows), block_bytes=block_bytes) == sorted(brute(rows), key=str)


@pytest.mark.parametrize(("window", "base"), [(35, 35), (35, 1), (7, 3), (1, 9)])
def test_any_window_and_first_level(make_docs, rows, window, base):
    some = rows[:25] + rows[40:44] + rows[-4:]
    assert run(make_docs(some), window=window, base=base) == sorted(brute(some, window), key=str)


def test_repeated_rows_and_empty_table(make_docs):
    text = " ".join(map(str, range(40)))
    got = run(make_docs([(1, text)] * 50, partitions=5), block_bytes=200)
    assert got == [(1, 40, 40, "", [(0, 40)], 35)] * 50
    assert run(make_docs([])) == []


def test_levels():
    assert substring_dedup.levels(35, 9) == [9, 18, 35]
    assert substring_dedup.levels(35, 9, 300) == [9, 18, 35, 70, 140, 280]
    assert substring_dedup.levels(35, 35) == [35]


def test_query_returns_the_contract_columns(spark):
    from tidemart.llm.queries import QUERIES
    got = QUERIES["op13_substring_dedup"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t, _, _ in brute(rows)}
    assert {tuple(r) for r in got.collect()} == want
