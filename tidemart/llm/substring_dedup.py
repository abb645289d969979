"""Substring dedup on words by level-wise doubling.

A word goes if it is covered by a window of ``WINDOW`` consecutive words whose
sequence also starts anywhere else, in any document. Windows are tried at lengths
that double from level to level, up to the window (its halves, rounded up: 9, 18
and 35 words). A window takes part in a level only if it is made of two windows,
its first and its last words, that were both repeated one level before, so what
occurs once is dropped at the first level and later levels see repeats alone:

1. blocks of documents send the hash of each distinct candidate window, with a
   mark where it occurs twice in the block,
2. buckets of hashes find those that occur twice in all and answer each block
   with the ones it asked for,
3. the blocks pair neighbouring repeats into the candidates of twice the length,
   and so on until no candidate survives or the window is reached. Then they take
   out the covered words.

With ``longest`` the doubling goes on past the window, to 70, 140 and so on, until
nothing is repeated, which tells how long each document's repeats are.

A window's hash is the mixed pair of its two halves' hashes, so doubling is also
how hashes are made. Below the window four bytes beside the bucket are sent: a
chance meeting only keeps a candidate for longer. From the window on twelve bytes
decide. A block sends and gets every window once, however often it has it, and a
bucket holds it once per block, so neither thousands of copies nor a passage in a
third of all documents gather in a task. Buckets are as many as keep a bucket at
``BUCKET_BYTES``; messages are never more than the windows in them.

Defined results: words are what ASCII white space separates. A null or empty text
has none. Texts shorter than the window lose nothing. Rows count by themselves,
so repeated rows, rows with one id and rows with a null id are further places
where a window may start. There are no ties: all places of a repeated window go.
A very long text is one block's work, in arrays of eight bytes a word. An empty
table gives no rows. Extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import keyed

WINDOW = 35
BASE = 9  # the first level's windows have at most so many words
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
SENT, FULL, TOLD = 4, 12, 8  # bytes of a hash: sent below the window, sent from the window on, answered there
REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string"
ASKED = "block int, bucket int, level int, hashes binary, twice binary"
ANSWER = "block int, bucket int, level int, hashes binary"


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def halves(window: int, base: int = 1) -> list[int]:
    """Lengths that double up to the window, from the first of at most ``base``; the last step may be shorter."""
    out = [window]
    while out[0] > base:
        out.insert(0, -(-out[0] // 2))
    return out


def levels(window: int, base: int, longest: int = 0) -> list[int]:
    """Window lengths of all levels; those past the window double while a text of ``longest`` words can repeat one."""
    out = halves(window, base)
    while 2 * out[-1] <= longest:
        out.append(2 * out[-1])
    return out


class Block:
    """The words of a block's documents, end to end, as hashes."""

    def __init__(self, part: pa.Table):
        texts = [t.as_py() for t in part["text"].cast(pa.binary()).combine_chunks()]
        order = sorted(range(len(texts)), key=lambda i: texts[i])
        self.part, self.texts = part.take(pa.array(order, pa.int64())), [texts[i] for i in order]
        self.block = part["block"][0].as_py() if part.num_rows else 0
        words = [self.word_hashes(t) for t in self.texts]
        self.starts = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)]).astype(np.int64)
        self.words = np.concatenate([np.zeros(0, dtype=np.uint64), *words])
        self.end = np.repeat(self.starts[1:], np.diff(self.starts))

    @staticmethod
    def word_hashes(text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))

    def windows(self, lengths: list[int], lane: int = 0) -> np.ndarray:
        """Hashes of the windows of the last of ``lengths`` at every place; those that leave a text mean nothing."""
        h, have = mixed(self.words + np.uint64(lane)), 1
        for n in lengths:
            if n > have:
                left = h[:max(0, len(h) - (n - have))]
                h, have = mixed(left * np.uint64(0x9E3779B97F4A7C15) + h[n - have:] + np.uint64(n)), n
        return h

    def places(self, length: int) -> np.ndarray:
        """Places of the words where a window of the length lies within its text."""
        at = np.arange(max(0, len(self.words) - length + 1))
        return at[at + length <= self.end[:len(at)]]


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) % buckets


def key_bytes(h: np.ndarray, other: np.ndarray | None, size: int) -> np.ndarray:
    """The last bytes of hashes, and of another lane where one doesn't suffice, as rows."""
    lanes = [h] if other is None else [h, other]
    rows = np.stack([x.astype("<u8") for x in lanes], axis=1).view(np.uint8).reshape(len(h), 8 * len(lanes))
    return np.ascontiguousarray(rows[:, :size])


def as_number(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(data, dtype=np.uint8).reshape(-1, size)
    return out.view("<u8").ravel().astype(np.uint64)


def told_flags(h: np.ndarray, told: list[tuple[int, bytes]], buckets: int, size: int) -> np.ndarray:
    """Which hashes a bucket's answer names."""
    if not told or not len(h):
        return np.zeros(len(h), dtype=bool)
    low = np.uint64((1 << 8 * size) - 1)
    # below eight bytes, the bucket is told apart from the others by what a hash leaves free
    tag = (lambda bucket: np.uint64(0)) if size == 8 else (lambda bucket: bucket.astype(np.uint64) << np.uint64(8 * size))
    names = np.sort(np.concatenate([as_number(x, size) | tag(np.array([b])) for b, x in told]))
    own = h & low | tag(bucket_of(h, buckets))
    return names[np.minimum(np.searchsorted(names, own), len(names) - 1)] == own


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, base: int = BASE,
          block_bytes: int = BLOCK_BYTES, with_text: bool = False, longest: bool = False) -> DataFrame:
    """Per row: n_words, n_removed and kept_sha256, of the words left joined by one space.

    With ``with_text`` also ``kept``, those words, and ``spans``, the removed runs as
    (start, length) in words. With ``longest`` also ``longest_repeat``, the length of
    the last level at which the row still has a repeated window, 0 without any.
    """
    rows = keyed(docs, id_col, text_col)
    size, longest_text = rows.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    buckets = max(1, -(-(size or 0) * SENT // (5 * BUCKET_BYTES)))  # some five bytes a word
    lengths = levels(window, base, (longest_text or 0) // 2 + 1 if longest else 0)
    deciding = lengths.index(window)
    # equal rows spread too: the scan's partition deals them
    own = rows.select(F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(blocks)).cast("int").alias("block"),
                      "doc_id", "text")

    def chain(level: int) -> list[int]:
        return [*halves(lengths[0]), *lengths[1:level + 1]]

    def answered(told: pa.Table | None, level: int) -> list[tuple[int, bytes]]:
        if told is None:
            return []
        return [(b, x) for b, at, x in zip(*(told[c].to_pylist() for c in ("bucket", "level", "hashes")), strict=True)
                if at == level]

    def repeated(block: Block, told: pa.Table | None, level: int) -> np.ndarray:
        """Flags of the places whose window of this level is repeated."""
        at, flags = block.places(lengths[level]), np.zeros(len(block.words) + 1, dtype=bool)
        h = block.windows(chain(level))[at]
        flags[at] = told_flags(h, answered(told, level), buckets, TOLD if level >= deciding else SENT)
        return flags

    def ask(level: int, part: pa.Table, told: pa.Table | None) -> pa.Table:
        block = Block(part)
        at = block.places(lengths[level])
        if level:
            before = repeated(block, told, level - 1)
            at = at[before[at] & before[at + lengths[level] - lengths[level - 1]]]
        h = block.windows(chain(level))[at]
        full = level >= deciding
        other = block.windows(chain(level), lane=1)[at] if full else None
        bucket = bucket_of(h, buckets)
        by = np.lexsort((h, bucket) if other is None else (other, h, bucket))
        h, bucket = h[by], bucket[by]
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        if full:
            other = other[by]
            new[1:] |= other[1:] != other[:-1]
        begin = np.flatnonzero(new)
        twice = np.diff(np.append(begin, len(h))) > 1
        keys = key_bytes(h[begin], other[begin] if full else None, FULL if full else SENT)
        names, cuts = np.unique(bucket[begin], return_index=True)
        ends = np.append(cuts, len(begin))[1:]
        pieces = list(zip(cuts.tolist(), ends.tolist(), strict=True))
        return pa.table({"block": pa.array([block.block] * len(names), pa.int32()), "bucket": pa.array(names, pa.int32()),
                         "level": pa.array([level] * len(names), pa.int32()),
                         "hashes": pa.array([keys[a:b].tobytes() for a, b in pieces], pa.binary()),
                         "twice": pa.array([np.packbits(twice[a:b]).tobytes() for a, b in pieces], pa.binary())})

    def answer(part: pa.Table) -> pa.Table:
        level = part["level"][0].as_py()
        sent, told = (FULL, TOLD) if level >= deciding else (SENT, SENT)
        lists = [np.frombuffer(x, np.uint8).reshape(-1, sent) for x in part["hashes"].to_pylist()]
        flags = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)).astype(bool)
                                for x, n in zip(part["twice"].to_pylist(), lists, strict=True)])
        rows_ = np.concatenate(lists)
        if sent == SENT:
            _, which, times = np.unique(rows_.view("<u4").ravel(), return_inverse=True, return_counts=True)
        else:
            low, high = rows_[:, :8].copy().view("<u8").ravel(), rows_[:, 8:].copy().view("<u4").ravel()
            by = np.lexsort((high, low))
            new = np.append(True, (low[by][1:] != low[by][:-1]) | (high[by][1:] != high[by][:-1]))
            which = np.empty(len(by), dtype=np.int64)
            which[by] = np.cumsum(new) - 1
            times = np.bincount(which)
        often = times > 1
        often[which[flags]] = True
        hit, at, out = often[which], 0, []
        for i, n in enumerate(lists):
            own_hits = n[hit[at:at + len(n)]]
            at += len(n)
            if len(own_hits):
                out.append((i, own_hits[:, :told].tobytes()))
        keep = pa.array([i for i, _ in out], pa.int64())
        return pa.table({"block": part["block"].take(keep), "bucket": part["bucket"].take(keep),
                         "level": part["level"].take(keep), "hashes": pa.array([x for _, x in out], pa.binary())})

    def remove(part: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(part)
        # a told hash of eight bytes decides for candidates and, so many bytes long, for all other windows
        begins = np.flatnonzero(repeated(block, told, deciding))
        marks = np.zeros(len(block.words) + 1, dtype=np.int32)
        np.add.at(marks, begins, 1)
        np.add.at(marks, begins + window, -1)
        gone = np.cumsum(marks[:-1]) > 0
        got = list(without(block, gone))
        out = {"doc_id": block.part["doc_id"], "n_words": pa.array(np.diff(block.starts), pa.int64()),
               "n_removed": pa.array([k for k, _, _ in got], pa.int64()),
               "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for _, x, _ in got], pa.string())}
        if with_text:
            out["kept"] = pa.array([x.decode() for _, x, _ in got], pa.string())
            out["spans"] = pa.array([[{"start": s, "length": n} for s, n in runs] for _, _, runs in got],
                                    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))
        if longest:
            most = np.zeros(len(block.texts), dtype=np.int64)
            for level in range(len(lengths)):
                if level >= deciding:
                    at = np.flatnonzero(repeated(block, told, level))
                    most[np.unique(np.searchsorted(block.starts, at, side="right") - 1)] = lengths[level]
            out["longest_repeat"] = pa.array(most, pa.int64())
        return pa.table(out)

    def first(part: pa.Table) -> pa.Table:
        return ask(0, part, None)

    def further(level: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        return lambda part, told: ask(level, part, told)

    by_block, told, deciders = own.groupBy("block"), None, None
    for level in range(len(lengths)):
        if told is None:
            asked = by_block.applyInArrow(first, ASKED)
        else:
            asked = by_block.cogroup(told.groupBy("block")).applyInArrow(further(level), ASKED)
        told = asked.groupBy("bucket").applyInArrow(answer, ANSWER)
        if level >= deciding:
            deciders = told if deciders is None else deciders.unionByName(told)
    return by_block.cogroup(deciders.groupBy("block")).applyInArrow(
        remove, REMOVED + (", kept string, spans array<struct<start: long, length: long>>" if with_text else "")
        + (", longest_repeat long" if longest else ""))


def without(block: Block, gone: np.ndarray) -> Iterator[tuple[int, bytes, list[tuple[int, int]]]]:
    """(words removed, bytes of those kept, removed runs) of a block's documents."""
    for a, b, text in zip(block.starts[:-1].tolist(), block.starts[1:].tolist(), block.texts, strict=True):
        words, flags = text.split(), gone[a:b]
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        runs, kept, at = [], [], 0
        for s, e in edges.tolist():
            runs.append((s, e - s))
            kept += words[at:s]
            at = e
        yield sum(n for _, n in runs), b" ".join(kept + words[at:]), runs
