import math
import random
import zlib

import numpy as np

from tidemart.llm import toxicity


def corpus(n=900):
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(600)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(
                    ["Zounds", "blast!", "quorl" + rng.choice(vocab), "drat,"]))
        rows.append((i, " ".join(words)))
        if i % 10 < 8:
            labels.append((i, i % 2, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark, make_docs):
    rows, labels = corpus()
    extra = [(5000, None), (5001, ""), (None, "no id"), (5002, "zounds " * 30_000), (5003, "x"), (5003, "x")]
    got = toxicity.score(make_docs(rows + extra), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) + len(extra)
    wrong = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 5000:
            wrong += r.predicted != int(r.doc_id % 4 == 0)
    assert wrong <= 0.02 * len(rows)


def test_labels_of_held_out_rows_are_not_used(spark, make_docs):
    rows, labels = corpus(400)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    scores = [{r.doc_id: r.score for r in toxicity.score(make_docs(rows), spark.createDataFrame(x, schema)).collect()}
              for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_without_labels_and_empty_table(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(make_docs([(1, "a"), (2, None)]), none).collect()
    assert len({r.score for r in got}) == 1 and all(r.predicted == 0 for r in got)
    assert toxicity.score(make_docs([]), none).count() == 0


def test_thinned_classes_keep_their_share(spark, make_docs, monkeypatch):
    """Words in a fifth of the toxic and a thirtieth of the clean rows, one toxic in ten: alone, no ground for toxic."""
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    hints = ["mild", "sour", "rude"]
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 10 == 0
        words = [rng.choice(vocab) for _ in range(20)] + [h for h in hints if rng.random() < (0.2 if toxic else 1 / 30)]
        rows.append((i, " ".join(words + ["zounds"] * (toxic and rng.random() < 0.6))))
        labels.append((i, int(toxic)))
    probes = [(10_000 + k, t) for k, t in enumerate([*hints, "nothing", "zounds"])]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = []
    for cap in (10_000, 250):
        monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", cap)
        got.append({r.doc_id: r for r in toxicity.score(make_docs(rows + probes), labels).collect()})
    assert [got[0][d].predicted for d, _ in probes] == [got[1][d].predicted for d, _ in probes]
    assert [got[1][d].predicted for d, _ in probes] == [0, 0, 0, 0, 1]
    assert sum(got[0][d].predicted != got[1][d].predicted for d, _ in rows) <= 0.01 * len(rows)


def plain_label_model(votes, given, counts, rounds):
    """The documented model, row by row and voter by voter."""
    wrong, n, m = toxicity.LABEL_ERROR, len(votes), len(votes[0])
    post = [min(1 - wrong, max(wrong, float(y))) for y in given]
    every = sum(counts)
    prior = (sum(c for c, y in zip(counts, given, strict=True) if y) + 1) / (every + 2)
    for _ in range(rounds):
        on, off = sum(c * p for c, p in zip(counts, post, strict=True)), sum(c * (1 - p) for c, p in zip(counts, post, strict=True))
        hit = [(sum(counts[i] * post[i] * votes[i][j] for i in range(n)) + 0.5) / (on + 1) for j in range(m)]
        false = [min(hit[j], (sum(counts[i] * (1 - post[i]) * votes[i][j] for i in range(n)) + 0.05) / (off + 1)) for j in range(m)]
        rest = [[(votes[i][j] - post[i] * hit[j] - (1 - post[i]) * false[j]) * math.sqrt(counts[i] / every) for j in range(m)]
                for i in range(n)]
        size = [math.sqrt(sum(rest[i][j] ** 2 for i in range(n)) + 1e-12) for j in range(m)]
        weight = []
        for j in range(m):
            both = [1.0 if j == k else min(1, max(0, sum(rest[i][j] * rest[i][k] for i in range(n)) / size[j] / size[k])) for k in range(m)]
            weight.append(1 / sum(x for x in both if x > 0.2))
        new = []
        for i in range(n):
            z = math.log(prior / (1 - prior)) + (1 if given[i] else -1) * math.log((1 - wrong) / wrong)
            z += sum(weight[j] * math.log(hit[j] / false[j] if votes[i][j] else (1 - hit[j]) / (1 - false[j])) for j in range(m))
            new.append(1 / (1 + math.exp(-min(60, max(-60, z)))))
        post = new
    return post


def test_label_model_equals_a_plain_one():
    rng = np.random.default_rng(3)
    given = (rng.random(80) < 0.3).astype(int)
    votes = (rng.random((80, 6)) < np.where(given[:, None] == 1, 0.6, 0.05)).astype(float)
    votes[:, 5] = votes[:, 4]  # a voter that repeats another
    counts = np.where(given == 1, 1.0, 4.0)
    for rounds in (1, 4):
        got = toxicity.label_model(votes, given, counts, rounds)
        assert np.allclose(got, plain_label_model(votes.tolist(), given.tolist(), counts.tolist(), rounds), atol=1e-6)


def test_logistic_is_the_optimum():
    """At the returned weights the penalised likelihood has no slope, found by differences."""
    rng = np.random.default_rng(4)
    x, target, counts = (rng.random((60, 4)) < 0.4).astype(float), rng.random(60), rng.integers(1, 5, 60).astype(float)
    w, bias = toxicity.logistic(x, target, counts)

    def loss(v):
        z = x @ v[:-1] + v[-1]
        return -(counts * (target * z - np.log1p(np.exp(z)))).sum() + 0.05 * (v[:-1] ** 2).sum() + 0.5e-6 * v[-1] ** 2

    best = np.append(w, bias)
    for step in np.eye(5) * 1e-4:
        assert abs(loss(best + step) - loss(best - step)) / 2e-4 < 1e-5


def test_alike_voters_count_before_any_selection(spark, make_docs):
    """Three marks of one word vote alike and become one voter; a weaker word found elsewhere stays."""
    rows = [(i, "plain words here " + ("zoundsly " if i < 30 else "") + ("quorl" if 30 <= i < 50 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i < 50)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(make_docs(rows).select("doc_id", "text"), labels)
    assert sorted(v.rstrip("*%") for v in model.voters) == ["quor", "zoun"]
