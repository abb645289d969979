"""Toxicity by weak supervision.

Voters are words (a lexicon) and patterns that are far more frequent in toxic
training rows: words with a given beginning that occur at all, twice or more, or
as one word in a hundred. Each voter says toxic where it is found and nothing
elsewhere. A generative label model estimates each voter's hit
rates among toxic and clean documents by expectation maximisation over the vote
matrix, and the correlation of each pair of voters given the label; voters that
repeat each other share their weight. Its posterior labels train a logistic
regression, which scores every document. The sample takes at most
SAMPLE_PER_CLASS rows of a class; each row counts as often as the labels of its
class were thinned, so the prior and the rates are those of all training labels.

Only ``text`` and the labels of the training rows are used. Defined results: a
null text is empty, and every text gets a score. Without toxic training rows
there are no voters, and each score is the prior. Repeated rows score alike; of
voters that tie, being found in the same texts, the first by name stands for all. A
very long text is scored whole, by its words. An empty table gives no rows. Extra
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import keyed, pin, release

SAMPLE_PER_CLASS = 10_000  # labelled training rows of each class that the models are fitted on
MAX_VOTERS = 400  # the strongest, of those found in unlike texts; bounds the vote matrix that the driver fits on
MIN_DOCS = 5  # toxic training rows that a voter must be found in
MIN_EVIDENCE = 20.0  # likelihood ratio statistic, far beyond chance for millions of candidates
LABEL_ERROR = 0.01  # share of given labels taken to be wrong
MIN_LIFT = 3.0  # times as frequent in toxic rows as in clean rows
PREFIXES = (4, 5, 6, 7)
DENSE = 100  # words to one of a dense beginning
FLUSH = 400_000  # counted candidates that a task holds before it emits them
WORDS = re.compile(r"[^\W\d_]+").findall


def marks(beginning: str, times: int, words: int) -> list[str]:
    """The pattern voters that a beginning found ``times`` times among ``words`` words makes."""
    return ([beginning + "*"] + [beginning + "**"] * (times > 1) + [beginning + "%"] * (times > 1 and times * DENSE >= words))


def candidates(text: str, beginnings: set[str] | None = None) -> set[str]:
    """Words and pattern voters of a text; with ``beginnings``, only patterns of these."""
    words = WORDS(text.lower())
    seen, found = Counter(words), Counter()
    for w, k in seen.items():
        for n in PREFIXES:
            if len(w) > n and (beginnings is None or w[:n] in beginnings):
                found[w[:n]] += k
    return seen.keys() | {m for p, k in found.items() for m in marks(p, k, len(words))}


def beginning(voter: str) -> str:
    """The beginning that a pattern voter looks for; empty for a word."""
    return voter.rstrip("*%") if voter[-1] in "*%" else ""


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


@dataclass
class Model:
    voters: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def scorer(self):
        weights = dict(zip(self.voters, self.weights, strict=True))
        starts = {beginning(v) for v in self.voters} - {""}

        def score(text: str) -> float:
            z = self.bias + math.fsum(weights[v] for v in candidates(text, starts) & weights.keys())
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))

        return score


def training_rows(docs: DataFrame, labels: DataFrame, label_id: str, label_col: str) -> DataFrame:
    """(doc_id, text, toxic, weight) of a bounded sample of the labelled training rows, first by a hash of the id.

    ``weight`` is the number of training labels of the class that a row of the sample stands for.
    """
    known = (labels.select(labels[label_id].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
             .where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(~held_out(F.col("doc_id"))))
    totals = {r["toxic"]: r["n"] for r in known.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS)
             .withColumn("weight", F.lit(max(1.0, totals.get(y, 0) / SAMPLE_PER_CLASS))) for y in (0, 1)]
    # at most 2 * SAMPLE_PER_CLASS ids: safe to broadcast, so no text is shuffled
    return docs.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")


def find_voters(rows: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Candidates much more frequent in toxic rows, strongest first; one of those found in the same texts.

    ``texts`` adds up hashes of the texts that have a candidate, which tells such candidates, so that
    copies of a voter take no place among the ``MAX_VOTERS``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found: tuple[Counter, Counter, Counter]) -> pa.RecordBatch:
            names = list(found[2])
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([found[1][v] for v in names], pa.int64()),
                 pa.array([found[0][v] for v in names], pa.int64()),
                 pa.array([found[2][v] for v in names], pa.decimal128(38, 0))], ["voter", "toxic", "clean", "texts"])

        found = (Counter(), Counter(), Counter())
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = candidates(text)
                found[y].update(own)
                found[2].update(dict.fromkeys(own, xxhash.xxh3_64_intdigest(text)))
                if len(found[2]) > FLUSH:
                    yield emit(found)
                    found = (Counter(), Counter(), Counter())
        yield emit(found)
        del found
        release()  # the worker lives on beside later stages and the executor's other tasks

    share = n_toxic / (n_toxic + n_clean)
    both = F.col("toxic") + F.col("clean")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (both * p))).otherwise(0.0)
    table = (rows.select("text", "toxic").mapInArrow(count, "voter string, toxic long, clean long, texts decimal(38,0)")
             .groupBy("voter").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "texts")))
             .where(F.col("toxic") >= MIN_DOCS)
             .withColumn("evidence", 2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share)))
             .withColumn("lift", (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1)))
             .where((F.col("evidence") >= MIN_EVIDENCE) & (F.col("lift") >= MIN_LIFT)))
    one = table.groupBy("texts", "toxic", "clean", "evidence").agg(F.min("voter").alias("voter"))
    return [r["voter"] for r in one.orderBy(F.desc("evidence"), "voter").limit(MAX_VOTERS).collect()]


def votes(rows: DataFrame, voters: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The vote matrix of the bounded sample, and its labels; one packed row per document goes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = {beginning(v) for v in voters} - {""}
        for b in batches:
            packed = []
            for text in b.column(0).to_pylist():
                has = candidates(text, starts)
                packed.append(np.packbits([v in has for v in voters]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), b.column(1)], ["votes", "toxic"])

    got = sorted(rows.select("text", "toxic").mapInArrow(run, "votes binary, toxic int").collect(),
                 key=lambda r: (r["toxic"], r["votes"]))
    bits = np.array([np.frombuffer(r["votes"], dtype=np.uint8) for r in got]).reshape(len(got), -1)
    return np.unpackbits(bits, axis=1)[:, :len(voters)].astype(np.float64), np.array([r["toxic"] for r in got])


def label_model(v: np.ndarray, given: np.ndarray, counts: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior probability of the toxic label for each row of votes, where row i stands for ``counts[i]`` rows.

    Hit rates start from the given labels and are then estimated from the
    posterior; the given label itself is one more voter, wrong in LABEL_ERROR
    of the rows. The residual correlation of two voters given the label says how much
    they repeat each other; each voter's log ratio is divided by the sum of its
    positive correlations, so that a group of copies counts as one.
    """
    own = np.where(given == 1, 1, -1) * math.log((1 - LABEL_ERROR) / LABEL_ERROR)
    post = np.clip(given.astype(float), LABEL_ERROR, 1 - LABEL_ERROR)
    toxic, every = counts[given == 1].sum(), counts.sum()
    prior = (toxic + 1) / (every + 2)
    for _ in range(rounds):
        on, off = counts * post, counts * (1 - post)
        rate1 = (on @ v + 0.5) / (on.sum() + 1)
        rate0 = np.minimum((off @ v + 0.05) / (off.sum() + 1), rate1)
        left = (v - (post[:, None] * rate1 + (1 - post)[:, None] * rate0)) * np.sqrt(counts / every)[:, None]
        spread = np.sqrt((left ** 2).sum(axis=0) + 1e-12)
        alike = np.clip(left.T @ left / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(alike, 1)
        weight = 1 / np.where(alike > 0.2, alike, 0).sum(axis=1)
        z = (v * (np.log(rate1 / rate0) * weight)).sum(axis=1)
        z += ((1 - v) * (np.log((1 - rate1) / (1 - rate0)) * weight)).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(z + own + math.log(prior / (1 - prior)), -60, 60)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post


def logistic(x: np.ndarray, target: np.ndarray, counts: np.ndarray, penalty: float = 0.1,
             rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft labels of rows that stand for ``counts`` rows each, by Newton steps."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(xb.shape[1])
    ridge = np.full(xb.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(xb @ w, -30, 30)))
        step = np.linalg.solve((xb * (counts * (p * (1 - p) + 1e-9))[:, None]).T @ xb + np.diag(ridge),
                               xb.T @ (counts * (target - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "toxic") -> Model:
    rows = pin(training_rows(docs, labels, label_id, label_col), "toxic-sample")
    found = {r["toxic"]: r for r in rows.groupBy("toxic").agg(
        F.count("*").alias("n"), F.first("weight").alias("weight")).collect()}
    toxic, clean = (found[y]["n"] if y in found else 0 for y in (1, 0))
    weight = np.array([found[y]["weight"] if y in found else 1.0 for y in (0, 1)])
    voters = find_voters(rows, toxic, clean) if toxic and clean else []
    if not voters:
        return Model(bias=math.log((toxic * weight[1] + 1) / (clean * weight[0] + 1)) if toxic + clean else -4.0)
    v, y = votes(rows, voters)
    _, first = np.unique(v, axis=1, return_index=True)  # voters that vote alike on every row count once
    voters, v = [voters[i] for i in sorted(first)], v[:, sorted(first)]
    counts = weight[y]
    weights, bias = logistic(v, label_model(v, y, counts), counts)
    return Model(voters, weights.tolist(), bias)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, in one pass; the model is one weight a voter."""
    rows = keyed(docs, id_col, text_col)
    model = fit(rows, labels, label_id, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([of(t) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])
        release()

    return (rows.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
