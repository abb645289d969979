"""Quality rules: a decision list learned from labelled statistics by sequential covering.

One pass over the texts makes a row of counts per document. On a bounded sample
of labelled rows, rules for the low-quality class are learned one by one: a
conjunction of thresholds is grown by information gain on two thirds of the
rows, pruned on the other third, and kept if it is precise there; the rows that
it covers are then taken out. The list becomes one Spark conditional expression
over the counts, so every document is judged by built-in functions.

Defined results: a null text has no words; a document that fails the base rules
is not kept, and neither is one that a learned rule covers. Without labelled
rows of both classes the list is empty. Repeated rows are judged alike. Of
thresholds with the same gain the first by column and value is taken, and the first
rule of the list that covers a document decides. A very long text is counted whole,
by its words. An empty table gives no rows. Extra columns, whatever their names, are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import keyed, pin

SAMPLE_ROWS = 40_000  # labelled rows that the list is learned from, the first by a hash of the id
MIN_PRECISION = 0.95  # a rule must reach it on the pruning rows, so that clean documents stay
MAX_CONDITIONS = 4
WINDOW = 8
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
NOT_CHARACTERS = SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
UPPER = bytes(range(65, 91))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
          "n_stops", "n_adjacent"]
STATISTICS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` words that is found twice or more in the text.

    Windows are numbered exactly, by doubling: pairs of numbered spans are
    numbered again, so that equal numbers mean equal spans.
    """
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    size = 1
    while size < window:
        size *= 2
        pairs = ids[:-(size // 2)] * n + ids[size // 2:]
        kinds, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(kinds) == len(pairs):
            return 0
    starts = np.flatnonzero(counts[ids] > 1)
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one text in UTF-8."""
    words = text.split()  # of bytes: splits at exactly the ASCII white space
    lines = [line for line in text.split(b"\n") if line.strip()]
    less = len(text)
    return (len(words), len(text.translate(None, NOT_CHARACTERS)), less - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            less - len(text.translate(None, UPPER)), less - len(text.translate(None, b"!?")),
            less - len(text.translate(None, b".")), sum(map(eq, words, words[1:])))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts per document, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [counts(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            cols = zip(*rows, strict=True) if rows else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             ["doc_id", *COUNTS])

    return keyed(docs, id_col, text_col).mapInArrow(run, STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def features() -> dict[str, Column]:
    """The statistics that conditions may test."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "marks_per_word": F.col("n_marks") / words,
        "stops_per_word": F.col("n_stops") / words,
        "adjacent_share": F.col("n_adjacent") / words,
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: int
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.feature]
        return v > self.threshold if self.above else v <= self.threshold


def covered(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Adds the condition of highest information gain until only bad rows are covered."""
    rule, inside = [], np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        best, found = 1e-9, None
        for f in range(x.shape[1]):
            v = x[inside, f]
            cuts = np.unique(np.quantile(v[bad[inside]], np.linspace(0, 1, 33)))
            cuts = np.unique(np.concatenate([cuts, np.nextafter(cuts, -np.inf)]))
            order = np.argsort(v)
            at = np.searchsorted(v[order], cuts, side="right")
            bads = np.concatenate([[0], np.cumsum(bad[inside][order])])[at]
            for above in (False, True):
                p1 = p - bads if above else bads
                n1 = (len(v) - at if above else at) - p1
                gain = np.where(p1 > 0, p1 * (np.log2(np.maximum(p1, 1) / np.maximum(p1 + n1, 1)) - np.log2(p / (p + n))), 0)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, found = gain[k], Condition(f, above, float(cuts[k]))
        if found is None:
            break
        inside_now = found.holds(x)
        # the middle of the empty stretch around the cut, so that what lies between the classes is split evenly
        v = x[inside, found.feature]
        low, high = v[v <= found.threshold].max(initial=-np.inf), v[v > found.threshold].min(initial=np.inf)
        if np.isfinite(low) and np.isfinite(high):
            found = Condition(found.feature, found.above, float((low + high) / 2))
        rule.append(found)
        inside &= inside_now
    return rule


def prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The prefix of the rule with the best (bad - good) / (bad + good) on rows that it wasn't grown on."""

    def worth(r: list[Condition]) -> float:
        c = covered(r, x)
        p, n = int((c & bad).sum()), int((c & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), len(r)), default=[])


def learn(x: np.ndarray, bad: np.ndarray) -> list[list[Condition]]:
    """Sequential covering: rules for the bad rows, in the order in which they were found."""
    rules: list[list[Condition]] = []
    part = np.arange(len(x)) % 3
    while bad.any() and not bad.all():
        own, other = part < 2, part == 2
        if not bad[own].any():
            break
        rule = prune(grow(x[own], bad[own]), x[other], bad[other])
        hit = covered(rule, x) if rule else np.zeros(len(x), dtype=bool)
        p, n = int((hit & other & bad).sum()), int((hit & other & ~bad).sum())
        if not p or p / (p + n) < MIN_PRECISION:
            break
        rules.append(rule)
        x, bad, part = x[~hit], bad[~hit], part[~hit]
    return rules


def expression(rules: list[list[Condition]]) -> Column:
    """The decision list as one ordered conditional: true if the document is good."""
    names = list(features())
    chain = None
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            v = F.col(names[c.feature])
            test = test & ((v > c.threshold) if c.above else (v <= c.threshold))
        chain = F.when(test, F.lit(False)) if chain is None else chain.when(test, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Counts, base_failed and kept of every document; rules are learned from ``labels`` (1 good, 0 bad)."""
    stats = pin(statistics(docs, id_col, text_col), "statistics")
    named = stats.select("*", *(c.alias(k) for k, c in features().items()), base_failed().alias("base_failed"))
    known = (labels.select(labels[label_id].alias("label_id"), labels[label_col].cast("int").alias("label"))
             .where("label is not null").groupBy("label_id").agg(F.min("label").alias("label")))
    names = list(features())
    sample = (named.where(~F.col("base_failed")).join(known, named["doc_id"] == known["label_id"])
              .orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(SAMPLE_ROWS)
              .select(*names, "label").toPandas())
    rules = learn(sample[names].to_numpy(dtype=float), sample["label"].to_numpy() == 0)
    return (named.withColumn("kept", ~F.col("base_failed") & expression(rules))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"))
