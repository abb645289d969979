import random
import re
from collections import Counter

import numpy as np

from tidemart.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def corpus(n=300):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 5, 19, 20, 60, 300]))]
        bad = i % 3 == 0
        if bad:
            words = [w + rng.choice(["***", "###"]) for w in words]
        text = "".join(w + rng.choice([" ", " ", "\n", "\t", " ", "\x1c"]) for w in words)
        if i % 7 == 0:
            text = text + text
        rows.append((i, text))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_counts_by_brute_force():
    rows, _ = corpus()
    for _, t in [*rows, (0, ""), (0, "a " * 9), (0, "a b c d e f g h " * 2), (0, "x\n\nx\n \n x")]:
        assert q.counts(t.encode())[:5] == brute(t), t


def test_judge(spark, make_docs):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (None, "a b"), (1002, "x y " * 20), (1002, "x y " * 20)]
    got = q.judge(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t in rows}
    truth = dict(labels)
    for r in got:
        n, chars, symbols, dup, repeat = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert not (r.kept and r.base_failed)
        if not r.base_failed and r.doc_id in truth:
            assert r.kept == (truth[r.doc_id] == 1)


def test_the_expression_says_what_the_rules_say(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(q.features())))
    bad = (x[:, 1] > 0.7) & (x[:, 4] <= 0.6) | (x[:, 0] > 0.95)
    rules = q.learn(x, bad)
    assert rules
    hit = np.zeros(len(x), dtype=bool)
    for r in rules:
        hit |= q.covered(r, x)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(q.features()))
    kept = [r[0] for r in df.select(q.expression(rules)).collect()]
    assert kept == (~hit).tolist()
    assert (hit & ~bad).sum() <= 0.05 * hit.sum() and (hit & bad).sum() > 0.8 * bad.sum()


def test_no_labels_and_empty_table(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = q.judge(make_docs([(1, "w " * 10), (2, " ".join(f"w{i}" for i in range(30)))]), none)
    assert sorted((r.doc_id, r.kept) for r in got.collect()) == [(1, False), (2, True)]
    nulls = spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")
    assert q.judge(make_docs([]), nulls).count() == 0
