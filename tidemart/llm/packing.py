"""Best-fit packing with exact complements.

Sequences are planned on the histogram of piece lengths, which has at most
``capacity`` entries however many pieces there are. Going from the longest
length down, the gap that a length leaves is looked up among the single
lengths, then in further rounds among the sums of two and of three that are
still available, and whole batches of such combinations, as many as the counts
allow, fill sequences exactly. What no combination completes is placed best-fit, longest first. The
plan gives every length consecutive rank ranges; the pieces are then numbered
within their length by Spark and each looks its place up by its rank.

Numbering never gathers a length in one task: pieces are numbered within
(length, salt) groups of about ``GROUP`` rows and shifted by the group counts.

Defined results: a null text is empty; an empty document is one piece, the end
id alone; repeated rows are packed once each; an empty table packs to no rows.
Pieces that tie in length take their places by a hash and then by id, piece and
digest. A very long text is encoded whole in one task and cut there. Extra columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm import bpe
from tidemart.llm.common import keyed, per_process, pin, release

GROUP = 20_000  # pieces numbered together
WORDS = 300_000  # entries of a worker's memo table, emptied when full; results don't depend on it
RANKS = 1 << 44  # more than the pieces of one length
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class WordTokens:
    """Ids of a text, memoised by word: the pre-split pattern never matches past a word's end."""

    def __init__(self, vocabulary: str):
        import tiktoken

        tokens, _, special = bpe.load(vocabulary)
        ids = set(special.values())
        self.special = special
        self.encode_word = tiktoken.Encoding(
            "pieces", pat_str=bpe.PATTERN, special_tokens={},
            mergeable_ranks={t: i for i, t in enumerate(tokens) if t and i not in ids}).encode_ordinary
        self.words = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
        self.odd_space = re.compile(r"[^\S \n]").search
        self.parts = re.compile("(" + "|".join(map(re.escape, special)) + ")").split if special else lambda t: [t]
        self.memo: dict[str, bytes] = {}

    def word(self, text: str) -> bytes:
        ids = np.array(self.encode_word(text), dtype="<u4").tobytes()
        if len(self.memo) >= WORDS:
            self.memo.clear()
        if len(text) <= 64:
            self.memo[text] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        out, get, word = [], self.memo.get, self.word
        for part in self.parts(text):
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
            elif self.odd_space(part):
                out.append(word(part))
            else:
                out += [get(w) or word(w) for w in self.words(part)]
        return b"".join(out)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids: all of ``capacity`` but the first, which may be shorter."""
    first = total - capacity * ((total - 1) // capacity)
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_process(("words", vocabulary), lambda: WordTokens(vocabulary))
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py()) + end
                rows += [(doc, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]))
                         for i, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(cols)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
        release()  # the worker lives on beside later stages and the executor's other tasks

    return keyed(docs, id_col, text_col).mapInArrow(run, PIECES)


def fill(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The shortest of the plans that use exact complements of up to one, two or three pieces."""
    plans = [fill_with(counts, capacity, most) for most in (3, 2, 1)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def fill_with(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences for the counted lengths, as (lengths of one sequence, how many such sequences)."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, k in counts.items():
        left[n] = k
    out: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> bool:
        """As many sequences of these lengths as the counts allow."""
        need = {n: lengths.count(n) for n in lengths}
        times = min(int(left[n]) // k for n, k in need.items())
        if times:
            out.append((lengths, times))
            for n, k in need.items():
                left[n] -= k * times
        return times > 0

    def pair_sums(total: int) -> np.ndarray:
        """The larger parts of available pairs with this sum, longest first."""
        there = left[:total + 1] > 0
        big = np.flatnonzero(there & there[::-1])
        return big[(2 * big >= total) & (big < total)][::-1]

    take(capacity)
    # pieces of up to half the capacity are what the others' gaps are filled with
    longest_first = range(capacity - 1, capacity // 2 - (capacity % 2 == 0), -1)
    for a in longest_first:
        if left[a]:
            take(a, capacity - a)
    for a in longest_first:
        for b in pair_sums(capacity - a).tolist() if left[a] and most >= 2 else ():
            if not left[a]:
                break
            take(a, b, capacity - a - b)
    for a in longest_first:
        gap = capacity - a
        for b in np.flatnonzero(left[:gap - 1])[::-1].tolist() if left[a] and most >= 3 else ():
            for c in pair_sums(gap - b).tolist() if left[a] and left[b] else ():
                if c <= b and left[a] and left[b]:
                    take(a, b, c, gap - b - c)
    # residuals: best fit, longest first, in batches of equal open sequences by their free room
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {capacity: []}
    for a in range(capacity, 0, -1):
        todo = int(left[a])
        while todo:
            room = min((r for r, held in open_by_room.items() if r >= a and held), default=capacity)
            if open_by_room.get(room):
                held, n = open_by_room[room].pop()
            else:
                held, n = (), todo
            each = min(room // a, todo)
            times = min(n, todo // each)
            if n > times and held:
                open_by_room[room].append((held, n - times))
            open_by_room.setdefault(room - each * a, []).append((held + (a,) * each, times))
            todo -= each * times
    return out + [x for stacks in open_by_room.values() for x in stacks]


def places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> np.ndarray:
    """Rows (length * RANKS + first rank, first sequence, offset), sorted: where each rank of a length goes."""
    used, rows, sequence = [0] * (capacity + 1), [], 0
    for lengths, times in plan:
        offset = 0
        for n in lengths:
            rows.append((n * RANKS + used[n], sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)


def pack(cuts: DataFrame, capacity: int = 1024) -> DataFrame:
    """Rows of ``pieces`` with sequence_id and offset. ``cuts`` is read three times: give a written table."""
    groups = max(1, -(-cuts.count() // GROUP))
    salted = cuts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    counted = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    # at most `capacity` lengths, whatever the input
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(fill(counts, capacity), capacity)
    before = counted.select(
        "length", "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(order) - 1)
              .join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column(5).to_numpy(zero_copy_only=False)
            key = b.column(3).to_numpy(zero_copy_only=False) * RANKS + rank
            at = table[np.searchsorted(table[:, 0], key, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(at[:, 1] + key - at[:, 0]), pa.array(at[:, 2])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PACKED)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack whole documents; the pieces are written once to the shared folder."""
    return pack(pin(pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces"), capacity)
