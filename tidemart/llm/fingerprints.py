"""Document fingerprints from prefix polynomial hashes.

A text's prefix array P[i] = sum of c_j * B^j over its first i code points, modulo
a prime, makes the hash of any span a difference of two entries, so that spans
are compared in constant time and the longest common extension of two places is
found by binary search. Two primes of 31 bits keep every product inside 64 bits.

A fingerprint is the length, the hash of the whole text, a one-permutation sketch
and the prefix array at up to ``MARKS`` places, every code point of a short text and
multiples of a power of two of a longer one. For the sketch the hashes of all spans
of ``SPAN`` code points are dealt over ``BINS`` bins and the smallest of each bin is
kept, in 16 bits; the share of equal bins estimates how much of their spans two texts
share. Equal prefix hashes at a place mean equal beginnings up to there, so binary
search over the marks that two texts have in common finds how far they agree.
Likeness is the larger of the two: the share of spans, or of the longer text that the
common beginning makes up.

Defined results: a null text is empty; the empty text and texts shorter than a
span have one span, the whole text; equal texts have equal fingerprints and
likeness 1. Rows that repeat a document id are ordered by text, null ids come last.
A very long text is worked on in stretches. An empty table gives no rows. Extra
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import keyed, n_blocks

# two primes below 2^31 and a base for each, larger than any code point
PRIMES = ((2_147_483_629, 1_640_531_527), (2_147_483_587, 1_181_783_497))
SPAN = 16
BINS = 128
MARKS = 64
STEP = 1 << 15  # code points worked on at a time, so that arrays stay in cache
EMPTY_BIN = 0xFFFF
OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo prime, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, factor = 1, base % prime
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(factor) % np.uint64(prime)
        factor = factor * factor % prime
        done += more
    return out[:n]


class Prefixes:
    """Prefix arrays of one text (code points as an integer array)."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        p64 = points.astype(np.uint64)
        self.sums, self.pows = [], []
        for prime, base in PRIMES:
            pw = powers(base, prime, self.n + 1)
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum((p64 + np.uint64(1)) * pw[:-1] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums % np.uint64(prime))
            self.pows.append(pw)

    def spans(self, start: np.ndarray, size: int) -> np.ndarray:
        """64-bit hashes of the spans text[s:s+size]; equal spans have equal hashes wherever they stand."""
        out = np.zeros(len(start), dtype=np.uint64)
        for (prime, _), sums, pw in zip(PRIMES, self.sums, self.pows, strict=True):
            p = np.uint64(prime)
            # scaled to the same power of the base for all places of this text
            out = out << np.uint64(32) | (sums[start + size] + p - sums[start]) % p * pw[self.n - start] % p
        return out

    def span(self, start: int, size: int) -> tuple[int, ...]:
        """Hash of one span, free of its place: (sum over c_j * B^(j-start)) for each prime."""
        out = []
        for (prime, base), sums in zip(PRIMES, self.sums, strict=True):
            d = (int(sums[start + size]) - int(sums[start])) % prime
            out.append(d * pow(pow(base, start, prime), -1, prime) % prime)
        return tuple(out)


def same_span(a: Prefixes, i: int, b: Prefixes, j: int, size: int) -> bool:
    """Whether a[i:i+size] equals b[j:j+size]."""
    return i + size <= a.n and j + size <= b.n and a.span(i, size) == b.span(j, size)


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common prefix of a[i:] and b[j:], by binary search on span hashes."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if same_span(a, i, b, j, mid):
            low = mid
        else:
            high = mid - 1
    return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a hash over all 64 bits."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


class Fingerprinter:
    """Fingerprints of texts, whole, whatever their length: prefix arrays are made stretch by stretch."""

    def __init__(self, span: int = SPAN, bins: int = BINS):
        self.span, self.bins = span, bins
        self.pows = [powers(base, prime, STEP + span + 1) for prime, base in PRIMES]

    def stretch(self, points: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Prefix arrays of one stretch, and the place-free hashes of its spans."""
        n, w, sums_all = len(points), self.span, []
        c = points.astype(np.uint64) + np.uint64(1)
        spans = None
        for (prime, _), pw in zip(PRIMES, self.pows, strict=True):
            p = np.uint64(prime)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(c * pw[:n] % p, out=sums[1:])
            sums_all.append(sums)
            if n >= w:
                part = (sums[w:] - sums[:-w]) % p * pw[STEP + w - np.arange(n - w + 1)] % p
                spans = part if spans is None else spans << np.uint64(32) | part
        return sums_all, spans if spans is not None else np.zeros(0, dtype=np.uint64)

    def __call__(self, text: str) -> str:
        points = code_points(text)
        n, w = len(points), self.span
        whole, marks, grid = [0] * len(PRIMES), [], grid_of(n)
        bins = np.full(self.bins, EMPTY_BIN, dtype=np.uint64)
        for at in range(0, max(n, 1), STEP):
            sums, spans = self.stretch(points[at:at + STEP + w - 1])
            own, (prime, base) = min(STEP, n - at), PRIMES[0]
            places = np.arange((at // grid + 1) * grid, at + own + 1, grid) - at
            inner = sums[0][places] % np.uint64(prime) * np.uint64(pow(base, at, prime))
            marks.append((np.uint64(whole[0]) + inner % np.uint64(prime)) % np.uint64(prime))
            for k, (prime, base) in enumerate(PRIMES):
                whole[k] = (whole[k] + int(sums[k][own]) % prime * pow(base, at, prime)) % prime
            if n < w:
                spans = np.array([whole[0] << 32 | whole[1]], dtype=np.uint64)
            h = mixed(spans)
            # a bin's smallest value: the first of each bin after sorting (bin, value)
            key = np.sort(h % np.uint64(self.bins) << np.uint64(16) | h >> np.uint64(48))
            first = np.flatnonzero(np.diff(key >> np.uint64(16), prepend=np.uint64(self.bins + 1)))
            which = (key[first] >> np.uint64(16)).astype(np.int64)
            bins[which] = np.minimum(bins[which], key[first] & np.uint64(0xFFFF))
        parts = bins.astype(">u2"), np.concatenate(marks).astype(">u4")
        return f"{n:x}:{whole[0]:08x}{whole[1]:08x}:" + ":".join(x.tobytes().hex() for x in parts)


def grid_of(n: int) -> int:
    """The distance of a text's marks: the smallest power of two that needs no more than ``MARKS``."""
    return 1 << max(0, (-(-n // MARKS) - 1).bit_length())


def common_beginning(a: str, b: str) -> int:
    """A length up to which the fingerprinted texts agree: the last mark of both at which their prefix hashes are equal."""
    n, m = (int(s.split(":", 1)[0], 16) for s in (a, b))
    grid = max(grid_of(n), grid_of(m))
    x, y = (np.frombuffer(bytes.fromhex(s.rpartition(":")[2]), dtype=">u4")[grid // grid_of(k) - 1::grid // grid_of(k)]
            for s, k in ((a, n), (b, m)))
    low, high = 0, min(len(x), len(y))
    while low < high:  # the first ``low`` marks are equal, none beyond ``high`` is
        mid = (low + high + 1) // 2
        low, high = (mid, high) if x[mid - 1] == y[mid - 1] else (low, mid - 1)
    return low * grid


def likeness(a: str, b: str) -> float:
    """The larger of the share of equal bins, among those that either text fills, and the common beginning's
    share of the longer text; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s.split(":")[2]), dtype=">u2") for s in (a, b))
    used = (x != EMPTY_BIN) | (y != EMPTY_BIN)
    longer = max(int(s.split(":", 1)[0], 16) for s in (a, b))
    return max(float(((x == y) & used).sum() / max(1, used.sum())), common_beginning(a, b) / max(1, longer))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter()
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([make(t) for t in texts], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows (block, tail, doc_id, text): blocks of neighbouring ids, each with a copy of the row after its last.

    The upper bounds of the blocks are ids that exist, so the row after a
    block's last one is the bound of the block below, and the row after the
    smallest id of all is the largest one. One bound per block goes to the driver.
    """
    blocks = n_blocks(docs, block_bytes)
    shares = ", ".join(str(i / blocks) for i in range(1, blocks)) or "0.5"
    row = docs.agg(F.expr(f"percentile_approx(doc_id, array({shares}), {20 * blocks + 100})").alias("q"),
                   F.max("doc_id").alias("top")).first()
    top = row["top"]
    bounds = sorted({*(row["q"] if blocks > 1 else []), *([] if top is None else [top])} - {None})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(bounds or [0], dtype=np.int64)
        for b in batches:
            ids = b.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            at = np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False))
            at[~known] = 0  # after the smallest id
            tail = np.flatnonzero(known & (edges[np.minimum(at, len(edges) - 1)]
                                           == ids.fill_null(0).to_numpy(zero_copy_only=False)))
            for rows, block, flag in ((None, at, False), (tail, (at[tail] + 1) % len(edges), True)):
                own = b if rows is None else b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int32()), pa.array(np.full(own.num_rows, flag)), *own.columns],
                    ["block", "tail", "doc_id", "text"])

    return docs.mapInArrow(run, "block int, tail boolean, doc_id long, text string")


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       block_bytes: int = 16 << 20) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness to each other and to the next.

    The next document is the one with the next smaller id; after the smallest
    comes the largest. Texts are shuffled once, by id range, and streamed in
    order; a block is never held as a whole.
    """

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter()
        first = held = None  # (block, doc_id, text, fingerprint): a block's first row, and the one that waits

        def against(text: str, mine: str) -> tuple:
            new = edited(held[2], text)
            theirs = make(new)
            return (held[1], len(held[2]), hashlib.sha256(new.encode()).hexdigest(), held[3], theirs,
                    likeness(held[3], theirs), likeness(held[3], mine))

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for b in batches:
            out = []
            for block, tail, doc, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if tail and (held is None or held[0] != block):
                    continue  # a further copy of the tail row
                mine = make(text)
                if held is not None and held[0] == block:
                    out.append(against(text, mine))
                else:
                    first = (block, doc, text, mine)
                held = None if tail else (block, doc, text, mine)
            yield batch(out)
        if held is not None:  # all ids are null, so no block has a bound
            yield batch([against(*first[2:])])

    rows = with_next(keyed(docs, id_col, text_col), block_bytes)
    return (rows.repartition(F.col("block"))
            .sortWithinPartitions("block", "tail", F.col("doc_id").desc_nulls_last(), "text")
            .mapInArrow(run, OUT))
