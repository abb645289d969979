"""Byte-level BPE: exact backtracking encoder and offset-table decoder.

A chunk of text (one match of the pre-split pattern) is scanned once by an
Aho-Corasick automaton over all token strings, which gives the longest token at
each place. Tokens are then laid from left to right. A token may follow the
last one only if the pair is compatible: merging the two byte strings on their
own would give exactly these two tokens. Where no token fits, the place is
marked dead and the last token is exchanged for its next shorter prefix. Every
place dies at most once, so a chunk costs linear time, and a sequence whose
neighbours are all compatible is the sequence that the merges give.

Defined results: a null or empty text has no ids; the special token's string in a
text is that token's id; rows are never dropped, and repeated rows give equal rows.
There are no ties: the merges fix the tokens. A very long text is encoded whole in
one task, chunk by chunk. An empty table gives no rows. Extra columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemart.llm.common import keyed, per_process

# fixed value: the public pre-split pattern of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNITS, CHUNKS, PAIRS = 250_000, 600_000, 1_000_000  # entries of memo tables, emptied when full; results don't depend on them
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_names() -> dict[str, int]:
    """The vocabulary file's printable stand-in of each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str) -> tuple[list[bytes], list[tuple[int, int, int]], dict[str, int]]:
    """(token bytes by id, merges as (left, right, merged) in rank order, special strings to ids)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    names, vocab = byte_names(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for s, i in vocab.items():
        if s not in special:
            tokens[i] = bytes(names[c] for c in s)
    for s, i in special.items():
        tokens[i] = s.encode()
    merges = []
    for m in spec["model"]["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        merges.append((vocab[left], vocab[right], vocab[left + right]))
    return tokens, merges, special


class Encoder:
    """Encoder of one vocabulary file; ``encode`` takes any text."""

    def __init__(self, path: str):
        self.tokens, merges, self.special = load(path)
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(merges)}
        made = {}
        for r, (a, b, m) in enumerate(merges):
            made.setdefault(m, (a, b, r))
        skip = set(self.special.values())
        usable = [i for i, t in enumerate(self.tokens) if t and i not in skip and (len(t) == 1 or i in made)]
        self.size = [len(t) for t in self.tokens]
        by_bytes = {self.tokens[i]: i for i in usable}
        self.by_text = {t.decode("latin-1"): i for t, i in by_bytes.items()}
        self.shorter = [-1] * len(self.tokens)
        self.automaton = ahocorasick.Automaton()
        for t, i in by_bytes.items():
            self.automaton.add_word(t.decode("latin-1"), i)
            self.shorter[i] = next((by_bytes[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_bytes), -1)
        self.automaton.make_automaton()
        self.made = made
        self.pairs: dict[tuple[int, int], bool] = {}
        self.units: dict[str, bytes] = {}
        self.memo: dict[str, bytes] = {}
        self.chunks = regex.compile(PATTERN)
        self.split_units = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
        self.odd_space = re.compile(r"[^\S \n]").search
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that touch one edge of ``token`` while it is merged, each with the rank that ends it."""
        out, end = [], float("inf")
        while True:
            out.append((token, end))
            if token not in self.made:
                return out[::-1]
            *parts, end = self.made[token]
            token = parts[side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging both byte strings together leaves exactly these two tokens (memoised table)."""
        known = self.pairs.get((left, right))
        if known is None:
            ls, rs, i, j, known = self.edge(left, 1), self.edge(right, 0), 0, 0, True
            while True:
                (a, ends_a), (b, ends_b) = ls[i], rs[j]
                r = self.rank.get((a, b))
                # of equal ranks the leftmost pair is merged first
                if r is not None and r < ends_a and r <= ends_b:
                    known = False
                    break
                if ends_a == ends_b == float("inf"):
                    break
                if ends_a <= ends_b:
                    i += 1
                else:
                    j += 1
            self.pairs[left, right] = known
        return known

    def chunk(self, text: str) -> list[int]:
        """Ids of one pre-split chunk, given as latin-1 text of its bytes."""
        whole = self.by_text.get(text)
        if whole is not None:
            return [whole]
        n, size, shorter, pairs = len(text), self.size, self.shorter, self.pairs
        longest = [-1] * n
        for end, token in self.automaton.iter(text):
            longest[end - size[token] + 1] = token  # ends rise, so the longest is written last
        out: list[int] = []
        dead, pos, token, last = bytearray(n + 1), 0, longest[0], -1
        while pos < n:
            while token >= 0:
                if not dead[pos + size[token]]:
                    if last < 0:
                        break
                    fits = pairs.get((last, token))
                    if self.compatible(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos += size[token]
                last, token = token, longest[pos] if pos < n else -1
            else:
                if not out:
                    raise ValueError("the vocabulary cannot spell this text")
                dead[pos] = 1
                token = out.pop()
                pos -= size[token]
                last, token = out[-1] if out else -1, shorter[token]
        return out

    def unit(self, text: str) -> bytes:
        """Ids, as little-endian unsigned 32-bit integers, of white space and the word after it."""
        memo, parts = self.memo, []
        for c in self.chunks.findall(text):
            ids = memo.get(c)
            if ids is None:
                ids = array("I", self.chunk(c if c.isascii() else c.encode().decode("latin-1"))).tobytes()
                if len(c) <= 64:
                    memo[c] = ids
            parts.append(ids)
        out = b"".join(parts)
        if len(text) <= 64:
            self.units[text] = out
        for table, most in ((self.units, UNITS), (memo, CHUNKS), (self.pairs, PAIRS)):
            if len(table) >= most:
                table.clear()
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text. A chunk never goes past a word's end, so words are encoded and kept one by one."""
        out = []
        for part in self.split_special(text) if self.split_special else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
            elif self.odd_space(part):
                out.append(self.unit(part))
            else:
                get, unit = self.units.get, self.unit
                out += [get(u) or unit(u) for u in self.split_units(part)]
        return b"".join(out)


class Decoder:
    """Offset table: the bytes of all tokens end to end, and where each begins."""

    def __init__(self, path: str):
        tokens = load(path)[0]
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])

    def decode(self, ids: bytes) -> str:
        t = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        begin, size = self.offsets[t], self.offsets[t + 1] - self.offsets[t]
        end = np.cumsum(size)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(begin - (end - size), size)
        return self.blob[at].tobytes().decode("utf-8", errors="replace")


def encoded(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary): ids of every text as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_process(("bpe", vocabulary), lambda: Encoder(vocabulary))
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([enc.encode(t.as_py()) for t in b.column(1)], pa.binary())],
                ["doc_id", "ids"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decoded(ids: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of rows of ``encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = Decoder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([dec.decode(x.as_py()) for x in b.column(1)], pa.string())],
                ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: token count, digest of the ids, digest of the decoded text. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_process(("bpe", vocabulary), lambda: Encoder(vocabulary))
        dec = Decoder(vocabulary)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1):
                ids = enc.encode(t.as_py())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(dec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return keyed(docs, id_col, text_col).mapInArrow(run, ENCODED)
