"""Language-model scoring over subword lattices.

A text is a sequence of words and an end mark, and its probability is the sum
over all ways to make it up. A word is either one edge, with its discounted
training frequency, or any segmentation into pieces of an existing public
vocabulary; the forward recursion in log space sums over all of them. Pieces
that begin with a space begin a word, so the recursion runs word by word and a
word is computed once wherever it stands. The vocabulary's own scores (a
piece's rank) start the piece weights, and expectation maximisation over the
lattices of all distinct training words fits them: as the discount takes the
same from every word, the pieces model the words that are still to come. All
weights sum to one, so scores are log probabilities of texts. Beside that score,
``pieces_score`` is the lattice's alone under the vocabulary's own scores, nothing
learned but the share of ends: the marginal probability of all segmentations.

Word counts are exact. Tasks count their own words, buckets by a word's hash
merge the counts, and blocks of documents ask the buckets for just the words
that they hold, so no task sees the whole word list.

Defined results: a null or empty text is the end mark alone; bytes outside any
longer piece are pieces themselves, so every text has a positive probability.
Without training documents all counts are 0 and the start scores are used.
Repeated rows score alike; a null id counts as training. There are no ties: all
segmentations count. A very long text is one row of a block, by its distinct words;
words of ``VECTOR_LENGTH`` bytes and more go one by one. An empty table gives no
rows. Extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import bpe
from tidemart.llm.common import block_of, keyed, pin, text_bytes

BLOCK_BYTES = 32 << 20  # text in a block of documents, and behind a bucket of words
FLUSH = 600_000  # distinct words that a counting task holds before it emits them
ROUNDS = 2  # of expectation maximisation
SMOOTH = 0.01  # added to each piece's expected count
VECTOR_LENGTH = 48  # words up to this many bytes are worked on in batches of equal length
BATCH = 4096
END = b""  # stands for the end mark among the words, which are never empty
HASH = np.uint64(0x9E3779B97F4A7C15)
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double, pieces_score double")


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space; bytes methods know no other letters or spaces."""
    return text.lower().split()


def usable_pieces(vocabulary: str) -> list[bytes]:
    """Pieces that can occur: no capitals, and no white space but a space in front."""
    tokens, _, special = bpe.load(vocabulary)
    barred = set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\v\f\r ")
    skip = set(special.values())
    return [t for i, t in enumerate(tokens) if t and i not in skip and not barred & set(t[1:] if t[0] == 32 else t)]


class Lattice:
    """Forward and backward recursions over the segmentations of words; a word starts with a space."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.pieces, self.log_p = pieces, log_p
        self.longest = max(map(len, pieces))
        keys = np.array([int(self.hashed(np.frombuffer(p, dtype=np.uint8)[None, :])[0]) for p in pieces], dtype=np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.index = {p: i for i, p in enumerate(pieces)}
        self.beginnings = {p[:n] for p in pieces for n in range(1, len(p) + 1)}

    @staticmethod
    def hashed(m: np.ndarray) -> np.ndarray:
        h = np.zeros(len(m), dtype=np.uint64)
        for k in range(m.shape[1]):
            h = (h + m[:, k] + np.uint64(1)) * HASH
        return h

    def edges(self, m: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each start the (end, piece ids, their log probabilities) over all rows; -inf where no piece fits."""
        out = []
        n = m.shape[1]
        for i in range(n):
            h, here = np.zeros(len(m), dtype=np.uint64), []
            for j in range(i, min(n, i + self.longest)):
                h = (h + m[:, j] + np.uint64(1)) * HASH
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                hit = self.keys[at] == h
                if hit.any():
                    ids = np.where(hit, self.order[at], -1)
                    here.append((j + 1, ids, np.where(hit, self.log_p[ids], -np.inf)))
            out.append(here)
        return out

    @staticmethod
    def forward(edges: list, rows: int) -> np.ndarray:
        alpha = np.full((len(edges) + 1, rows), -np.inf)
        alpha[0] = 0
        for i, here in enumerate(edges):
            for j, _, lp in here:
                alpha[j] = np.logaddexp(alpha[j], alpha[i] + lp)
        return alpha

    @staticmethod
    def backward(edges: list, rows: int) -> np.ndarray:
        beta = np.full((len(edges) + 1, rows), -np.inf)
        beta[-1] = 0
        for i in range(len(edges) - 1, -1, -1):
            for j, _, lp in edges[i]:
                beta[i] = np.logaddexp(beta[i], beta[j] + lp)
        return beta

    def long_edges(self, word: bytes) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """Edges of one long word; a start is left as soon as no piece begins so."""
        out = []
        for i in range(len(word)):
            here = []
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                piece = word[i:j]
                if piece not in self.beginnings:
                    break
                k = self.index.get(piece)
                if k is not None:
                    here.append((j, np.array([k]), self.log_p[k:k + 1]))
            out.append(here)
        return out

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list]]:
        """(indices, edges) for groups of words of equal length, with a space in front."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for n in np.unique(sizes).tolist():
            which = np.flatnonzero(sizes == n)
            if n >= VECTOR_LENGTH:
                for k in which.tolist():
                    yield np.array([k]), self.long_edges(b" " + words[k])
                continue
            for at in range(0, len(which), BATCH):
                some = which[at:at + BATCH]
                raw = np.frombuffer(b"".join(b" " + words[k] for k in some.tolist()), dtype=np.uint8)
                yield some, self.edges(raw.reshape(len(some), n + 1))

    def log_marginals(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, summed over its segmentations."""
        out = np.zeros(len(words))
        for which, edges in self.batches(words):
            out[which] = self.forward(edges, len(which))[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is used, in expectation over the segmentations of the counted words."""
        out = np.zeros(len(self.pieces))
        for which, edges in self.batches(words):
            alpha, beta = self.forward(edges, len(which)), self.backward(edges, len(which))
            ids, weights = [], []
            for i, here in enumerate(edges):
                for j, k, lp in here:
                    ids.append(k)
                    weights.append(np.where(k >= 0, counts[which] * np.exp(alpha[i] + lp + beta[j] - alpha[-1]), 0))
            out += np.bincount(np.maximum(np.concatenate(ids), 0), np.concatenate(weights), len(self.pieces))
        return out


def count_words(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, words, counts) of the training rows' words and ends: one row per bucket, words sorted and joined."""

    def emit(found: Counter) -> pa.RecordBatch:
        parts: list[list[bytes]] = [[] for _ in range(buckets)]
        for w in found:
            parts[zlib.crc32(w) % buckets].append(w)
        full = [i for i, p in enumerate(parts) if p]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([b"\n".join(sorted(parts[i])) for i in full], pa.binary()),
             pa.array([np.array([found[w] for w in sorted(parts[i])], dtype="<i8").tobytes() for i in full], pa.binary())],
            ["bucket", "words", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t in b.column(0).cast(pa.binary()):
                found.update(words_of(t.as_py()))
                found[END] += 1
                if len(found) > FLUSH:
                    yield emit(found)
                    found = Counter()
        yield emit(found)

    def merge(part: pa.Table) -> pa.Table:
        total: Counter = Counter()
        for words, counts in zip(part["words"].to_pylist(), part["counts"].to_pylist(), strict=True):
            for w, c in zip(words.split(b"\n"), np.frombuffer(counts, dtype="<i8").tolist(), strict=True):
                total[w] += c
        names = sorted(total)
        spread = Counter(total.values())
        return pa.table({
            "bucket": pa.array([part["bucket"][0].as_py()], pa.int32()),
            "words": pa.array([b"\n".join(names)], pa.binary()),
            "counts": pa.array([np.array([total[w] for w in names], dtype="<i8").tobytes()], pa.binary()),
            "kinds": pa.array([len(names)], pa.int64()), "total": pa.array([sum(total.values())], pa.int64()),
            "once": pa.array([spread[1]], pa.int64()), "twice": pa.array([spread[2]], pa.int64()),
            "ends": pa.array([total[END]], pa.int64())})

    # a task's rows are already summed, so a bucket gets each word once per task
    return (docs.where("not held_out").select("text").mapInArrow(count, "bucket int, words binary, counts binary")
            .groupBy("bucket").applyInArrow(
                merge, "bucket int, words binary, counts binary, kinds long, total long, once long, twice long, ends long"))


def normalised(weights: np.ndarray, first: np.ndarray, stops: float) -> tuple[np.ndarray, float]:
    """(log probabilities, that of a word's end): pieces that begin a word sum to one, all others with the end."""
    rest = weights[~first].sum() + stops
    return np.log(np.where(first, weights / weights[first].sum(), weights / rest)), math.log(stops / rest)


def vocabulary_scores(pieces: list[bytes]) -> tuple[np.ndarray, float]:
    """Piece log probabilities and that of a word's end by the vocabulary's own scores, a piece's rank."""
    first = np.array([p[0] == 32 for p in pieces])
    rank = 1 / (np.arange(len(pieces)) + 1.0)
    return normalised(rank, first, rank[first].sum())


def fit(counted: DataFrame, pieces: list[bytes], rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Piece log probabilities and that of a word's end, by expectation maximisation over all training words."""
    first = np.array([p[0] == 32 for p in pieces])
    log_p, log_stop = vocabulary_scores(pieces)
    for _ in range(rounds):
        now = log_p

        def expect(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(pieces, now)
            for b in batches:
                sums = np.zeros(len(pieces))
                for words in b.column(0).to_pylist():
                    real = [w for w in words.split(b"\n") if w]
                    sums += lattice.expected(real, np.ones(len(real)))
                used = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], ["piece", "n"])

        # one row per piece of the vocabulary at most
        got = (counted.select("words").mapInArrow(expect, "piece int, n double")
               .groupBy("piece").agg(F.sum("n").alias("n")).collect())
        sums = np.full(len(pieces), SMOOTH)
        for r in got:
            sums[r["piece"]] += r["n"]
        log_p, log_stop = normalised(sums, first, sums[first].sum())
    return log_p, log_stop


def score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
          folds: int = 7, fold: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of every whole text; what is learned comes from the rows that are not held out."""
    rows = keyed(docs, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id"), folds, fold))
    blocks = max(1, -(-text_bytes(rows) // block_bytes))
    rows = rows.withColumn("block", block_of(blocks, "doc_id", "text"))
    counted = pin(count_words(rows, blocks), "words")
    sums = counted.agg(*(F.sum(c) for c in ("kinds", "total", "once", "twice", "ends"))).first()
    kinds, total, once, twice, ends = (x or 0 for x in sums)
    pieces = usable_pieces(vocabulary)
    given_p, given_stop = vocabulary_scores(pieces)
    log_p, log_stop = fit(counted, pieces)
    # a text's words and its end, by the share of ends among all tokens
    end_share = ends / total if total else 0.01
    # what each known word gives up for words that were not seen; without training all but the end mark
    discount = min(0.95, once / (once + 2 * twice)) if once else 0.5
    log_new = math.log(discount * kinds / total if total else 0.99)
    log_end = math.log((ends - discount) / total if total else 0.01)
    scale = math.log10(total + kinds + 1)
    to_10 = 1 / math.log(10)

    def ask(part: pa.Table) -> pa.Table:
        seen: set[bytes] = set()
        for t in part["text"].cast(pa.binary()):
            seen.update(words_of(t.as_py()))
        parts: list[list[bytes]] = [[] for _ in range(blocks)]
        for w in seen:
            parts[zlib.crc32(w) % blocks].append(w)
        full = [i for i, p in enumerate(parts) if p]
        return pa.table({"block": pa.array([part["block"][0].as_py()] * len(full), pa.int32()),
                         "bucket": pa.array(full, pa.int32()),
                         "asked": pa.array([b"\n".join(sorted(parts[i])) for i in full], pa.binary())})

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        lists = [x.split(b"\n") for x in asked["asked"].to_pylist()]
        kinds_here = sorted({w for x in lists for w in x})
        place = {w: i for i, w in enumerate(kinds_here)}
        c, p = np.zeros(len(place), dtype="<i8"), Lattice(pieces, log_p).log_marginals(kinds_here)
        alone = Lattice(pieces, given_p).log_marginals(kinds_here) + (given_stop + math.log(1 - end_share))
        for words, counts in zip(known["words"].to_pylist(), known["counts"].to_pylist(), strict=True):
            for w, k in zip(words.split(b"\n"), np.frombuffer(counts, dtype="<i8").tolist(), strict=True):
                i = place.get(w)
                if i is not None:
                    c[i] = k
        known_edge = np.where(c > 0, np.log(np.maximum(c - discount, 1e-300) / max(total, 1)), -np.inf)
        p = np.logaddexp(known_edge, p + (log_stop + log_new))
        at = [np.fromiter((place[w] for w in x), dtype=np.int64, count=len(x)) for x in lists]
        return pa.table({"block": asked["block"], "words": asked["asked"],
                         "counts": pa.array([c[i].tobytes() for i in at], pa.binary()),
                         "logs": pa.array([p[i].astype("<f8").tobytes() for i in at], pa.binary()),
                         "alone": pa.array([alone[i].astype("<f8").tobytes() for i in at], pa.binary())})

    def sum_up(part: pa.Table, told: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        for x in told["words"].to_pylist():
            for w in x.split(b"\n"):
                place[w] = len(place)
        c = np.frombuffer(b"".join(told["counts"].to_pylist()), dtype="<i8")
        p, alone = (np.frombuffer(b"".join(told[c].to_pylist()), dtype="<f8") * to_10 for c in ("logs", "alone"))
        base, known = np.log10(c + 1.0) - scale, (c > 0).astype(np.int64)
        out = []
        for t in part["text"].cast(pa.binary()):
            words = words_of(t.as_py())
            at = np.fromiter((place[w] for w in words), dtype=np.int64, count=len(words))
            out.append((len(words) + 1, int(known[at].sum()) + (ends > 0),
                        float(base[at].sum()) + math.log10(ends + 1) - scale, float(p[at].sum()) + log_end * to_10,
                        float(alone[at].sum()) + math.log10(end_share)))
        n, k, b, s, a = zip(*out, strict=True) if out else [()] * 5
        return pa.table({"doc_id": part["doc_id"], "held_out": part["held_out"], "n_tokens": pa.array(n, pa.int64()),
                         "n_known": pa.array(k, pa.int64()), "train_tokens": pa.array([total] * len(n), pa.int64()),
                         "base_score": pa.array(b, pa.float64()), "score": pa.array(s, pa.float64()),
                         "pieces_score": pa.array(a, pa.float64())})

    own = rows.select("block", "doc_id", "text", "held_out")
    questions = own.groupBy("block").applyInArrow(ask, "block int, bucket int, asked binary")
    answers = (questions.groupBy("bucket").cogroup(counted.select("bucket", "words", "counts").groupBy("bucket"))
               .applyInArrow(answer, "block int, words binary, counts binary, logs binary, alone binary"))
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sum_up, SCORES)
