"""Cross-tokenizer alignment by products of token-byte incidence matrices.

A text is encoded by two tokenizers, A and B. With one row per token and one
column per byte, incidence matrices say which token covers which byte; they are
held in CSR form built here from the tokens' lengths. Gustavson's row products
A B' walk a row of A, gather the rows of B' at its bytes and add them up: an entry
is the number of bytes that an A token and a B token share, so its place is an
overlap link. Bytes where tokens of both end at once cut the text into groups; the
row product of the token-group incidences has a place for each A-B pair of a
group, the shared-group links. Products come in blocks of rows, so what a text's
product holds at once is bounded; the counts of shared-group links follow from
row sizes alone, without the links.

How telling a link is follows from the corpus: the number of documents that hold
its pair of ids. Tasks encode once and keep each document's distinct pairs, packed.
Blocks of documents list their distinct pairs with document counts, which Spark
sums by pair; the highest count of each A id comes from those sums, and each block
gets the counts of its own pairs back. No pair table is sent to every task, and a
pair is one row per block however many documents hold it.

Defined results: null and empty texts have no tokens, nor have texts whose A or B
tokens' bytes, joined, differ from the text with a space before it. Their numbers
are zero and ``groups_sha256`` is ''. Equal counts tie for the highest. Repeated
rows and rows with one or no id are documents by themselves. A very long text is
encoded whole in one task, its products in blocks of rows. An empty table gives no
rows. Extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import bpe
from tidemart.llm.common import keyed, n_blocks, per_process
from tidemart.llm.packing import WordTokens

BLOCK_BYTES = 32 << 20
CHUNK_BYTES = 1 << 20  # text whose matrices are built together; a longer text is a chunk of its own
ROWS = 1 << 15  # rows of a product made at once
SPACE = "▁"  # how pieces write a space
ENCODED = ("block int, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
           "groups_sha256 string, pairs binary, times binary")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string, n_group_links long")
LINKS = "doc_id long, kind string, a_index long, b_index long, a_id int, b_id int, shared_bytes long"


@dataclass
class Csr:
    """A matrix of ones: the columns of row r are ``indices[indptr[r]:indptr[r + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @classmethod
    def of_runs(cls, lengths: np.ndarray) -> Csr:
        """Row r has the next ``lengths[r]`` columns."""
        indptr = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        return cls(indptr, np.arange(indptr[-1]), int(indptr[-1]))

    @classmethod
    def of_owners(cls, owner: np.ndarray, columns: int) -> Csr:
        """Row r has the single column ``owner[r]``."""
        return cls(np.arange(len(owner) + 1), owner, columns)

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> Csr:
        """Counting places per column, then filling them in row order."""
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        order = np.argsort(self.indices, kind="stable")
        return Csr(indptr, np.repeat(np.arange(self.rows), np.diff(self.indptr))[order], self.rows)


def row_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Terms in each row of the product: its entries, where no two of them meet in one place."""
    terms = np.diff(right.indptr)[left.indices]
    return np.diff(np.concatenate([[0], np.cumsum(terms)])[left.indptr])


def row_products(left: Csr, right: Csr, rows: int = ROWS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of ``left`` times ``right``, rows in order, in blocks of rows.

    For each entry (r, k) of a row, row k of ``right`` is added to row r.
    """
    for first in range(0, left.rows, rows):
        last = min(left.rows, first + rows)
        k = left.indices[left.indptr[first]:left.indptr[last]]
        begin, terms = right.indptr[k], np.diff(right.indptr)[k]
        ends = np.cumsum(terms)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - terms), terms)
        r = np.repeat(np.repeat(np.arange(first, last), np.diff(left.indptr[first:last + 1])), terms)
        key = r * right.columns + right.indices[at]
        if (key[1:] < key[:-1]).any():
            key = np.sort(key)
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        value = np.diff(np.append(new, len(key)))
        yield key[new] // right.columns, key[new] % right.columns, value


class Tokenizers:
    """A: a byte-level vocabulary, its special tokens' strings being ordinary text; B: a piece model."""

    def __init__(self, vocabulary: str, pieces: str):
        import sentencepiece

        class Plain(WordTokens):
            def __init__(self):
                super().__init__(vocabulary)
                self.special, self.parts = {}, lambda text: [text]

        self.encode_a = Plain()
        self.a = [t or b"" for t in bpe.load(vocabulary)[0]]
        model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.encode_b = lambda text: model.encode(text, num_threads=1)
        self.b = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode()
                  for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a, self.b))
        self.decimals = decimals(max(len(self.a), len(self.b)))

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the text with a space before it; none where either's bytes differ from it."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        whole = " " + text
        a, b = np.frombuffer(self.encode_a(whole), "<u4").astype(np.int64), self.encode_b(text)
        data, table_a, table_b = whole.encode(), self.a, self.b
        if b"".join([table_b[i] for i in b]) != data or b"".join([table_a[i] for i in a.tolist()]) != data:
            return none, none
        return a, np.array(b, dtype=np.int64)


def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits, length) of the numbers below ``n``, with a free column behind the digits."""
    text = [str(i).encode() for i in range(n)]
    size = max(map(len, text), default=0) + 1
    digits = np.frombuffer(b"".join(t.ljust(size, b"\0") for t in text), dtype=np.uint8).reshape(n, size)
    return digits, np.array([len(t) for t in text], dtype=np.int64)


class Alignment:
    """The tokens of some texts, end to end, and their links."""

    def __init__(self, tokens: list[tuple[np.ndarray, np.ndarray]], of: Tokenizers):
        none = np.zeros(0, dtype=np.int64)
        self.of = of
        self.a, self.b = (np.concatenate([none, *(t[k] for t in tokens)]) for k in (0, 1))
        self.a_starts, self.b_starts = (np.concatenate([[0], np.cumsum([len(t[k]) for t in tokens], dtype=np.int64)]) for k in (0, 1))
        self.token_byte_a, self.token_byte_b = Csr.of_runs(of.a_sizes[self.a]), Csr.of_runs(of.b_sizes[self.b])
        a_ends, b_ends = self.token_byte_a.indptr[1:], self.token_byte_b.indptr[1:]
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.groups = len(common)
        self.a_group, self.b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, shared bytes), in order."""
        return row_products(self.token_byte_a, self.token_byte_b.transposed())

    def group_matrices(self) -> tuple[Csr, Csr]:
        return Csr.of_owners(self.a_group, self.groups), Csr.of_owners(self.b_group, self.groups).transposed()

    def per_text(self, numbers: np.ndarray) -> np.ndarray:
        """Sums over each text's A tokens."""
        return np.diff(np.concatenate([[0], np.cumsum(numbers)])[self.a_starts])

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text.

        A token of group g stands behind all tokens of smaller groups, and B's behind A's of its group.
        """
        digits, sizes = self.of.decimals
        a_before = np.searchsorted(self.b_group, self.a_group)  # B tokens of smaller groups
        b_before = np.searchsorted(self.a_group, self.b_group, side="right")  # A tokens of groups up to its own
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        behind = np.empty(len(ids), dtype=np.uint8)
        for tokens, group, before, last in ((self.a, self.a_group, a_before, b"|"), (self.b, self.b_group, b_before, b";")):
            at = np.arange(len(tokens)) + before
            ids[at] = tokens
            ends = np.append(group[1:] != group[:-1], True)[:len(group)]
            behind[at] = np.where(ends, ord(last), ord(","))
        rows = digits[ids].copy()
        rows[np.arange(len(ids)), sizes[ids]] = behind
        text = rows[np.arange(digits.shape[1]) <= sizes[ids][:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[ids] + 1)])[self.a_starts + self.b_starts]
        return [text[a:max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of texts of about ``CHUNK_BYTES``."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > CHUNK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield first, len(texts)


def counted(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct keys, four bytes each, and how often each occurs, in one byte each if that holds all."""
    names, times = np.unique(keys, return_counts=True)
    return names.astype("<u4").tobytes(), times.astype("u1" if times.max(initial=0) < 256 else "<u4").tobytes()


def uncounted(names: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(names, "<u4").astype(np.int64)
    return keys, np.frombuffer(times, "u1" if len(times) == len(keys) else "<u4").astype(np.int64)


def encoded(docs: DataFrame, vocabulary: str, pieces: str, blocks: int, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per row what it knows by itself, and its distinct pairs a * 2**16 + b with their number of links, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = per_process(("aligned", vocabulary, pieces), lambda: Tokenizers(vocabulary, pieces))
        if max(len(of.a), len(of.b)) > 1 << 16:
            raise ValueError("packed pairs hold vocabularies of up to 65,536 ids")
        for whole in batches:
            texts = whole.column(2).to_pylist()
            for first, last in chunks(texts):
                x = Alignment([of(t) for t in texts[first:last]], of)
                a_token, keys = [], []
                for a, b, _ in x.overlaps():
                    a_token.append(a)
                    keys.append(x.a[a] << 16 | x.b[b])
                a_token, keys = (np.concatenate([np.zeros(0, dtype=np.int64), *p]) for p in (a_token, keys))
                cuts = np.searchsorted(a_token, x.a_starts)
                pairs = [counted(keys[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                in_group = row_sizes(*x.group_matrices())
                last_of = np.append(x.a_group[1:] != x.a_group[:-1], True)[:len(x.a)]
                digests = [hashlib.sha256(g).hexdigest() if g else "" for g in x.group_texts()]
                yield pa.RecordBatch.from_arrays([
                    whole.column(0).slice(first, last - first), whole.column(1).slice(first, last - first),
                    pa.array(np.diff(x.a_starts)), pa.array(np.diff(x.b_starts)), pa.array(x.per_text(last_of.astype(np.int64))),
                    pa.array(np.diff(cuts)), pa.array(x.per_text(in_group)), pa.array(digests, pa.string()),
                    pa.array([p for p, _ in pairs], pa.binary()), pa.array([t for _, t in pairs], pa.binary())],
                    [f.split()[0] for f in ENCODED.split(", ")])

    rows = keyed(docs, id_col, text_col)
    # equal rows spread too: the scan's partition deals them
    block = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(blocks)).cast("int")
    return rows.select(block.alias("block"), "doc_id", "text").mapInArrow(run, ENCODED)


def block_pairs(rows: DataFrame) -> DataFrame:
    """(block, pair, docs): each distinct pair of a block with the number of its documents."""

    def run(part: pa.Table) -> pa.Table:
        keys, docs = np.unique(np.frombuffer(b"".join(part["pairs"].to_pylist()), "<u4"), return_counts=True)
        return pa.table({"block": pa.array(np.full(len(keys), part["block"][0].as_py(), dtype=np.int32)),
                         "pair": pa.array(keys.astype(np.int64)), "docs": pa.array(docs.astype(np.int64))})

    return rows.groupBy("block").applyInArrow(run, "block int, pair long, docs long")


def pair_counts(by_block: DataFrame) -> DataFrame:
    """(pair, docs, best): how many documents hold the pair, and whether no pair of its A id is in more."""
    docs = by_block.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 16))
    most = docs.groupBy("a").agg(F.max("docs").alias("most"))
    return docs.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def counts(docs: DataFrame, vocabulary: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a_id, b_id, documents, best): the corpus's links by pair of ids."""
    rows = encoded(docs, vocabulary, pieces, n_blocks(keyed(docs, id_col, text_col), BLOCK_BYTES), id_col, text_col)
    return pair_counts(block_pairs(rows)).select(
        F.shiftright("pair", 16).cast("int").alias("a_id"), F.pmod("pair", F.lit(1 << 16)).cast("int").alias("b_id"),
        F.col("docs").alias("documents"), "best")


def links(docs: DataFrame, vocabulary: str, pieces: str, kind: str = "overlap", id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per link of a kind, 'overlap' or 'group': token places and ids; shared_bytes of overlaps only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = per_process(("aligned", vocabulary, pieces), lambda: Tokenizers(vocabulary, pieces))
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for first, last in chunks(texts):
                x = Alignment([of(t) for t in texts[first:last]], of)
                found = x.overlaps() if kind == "overlap" else row_products(*x.group_matrices())
                for a, b, shared in found:
                    doc = np.searchsorted(x.a_starts, a, side="right") - 1
                    yield pa.RecordBatch.from_arrays([
                        whole.column(0).slice(first, last - first).take(pa.array(doc)), pa.array([kind] * len(a), pa.string()),
                        pa.array(a - x.a_starts[doc]), pa.array(b - x.b_starts[doc]), pa.array(x.a[a].astype(np.int32)),
                        pa.array(x.b[b].astype(np.int32)),
                        pa.array(shared) if kind == "overlap" else pa.nulls(len(a), pa.int64())],
                        [f.split()[0] for f in LINKS.split(", ")])

    if kind not in ("overlap", "group"):
        raise ValueError(kind)
    return keyed(docs, id_col, text_col).mapInArrow(run, LINKS)


def align(docs: DataFrame, vocabulary: str, pieces: str, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: see ``ALIGNED``."""
    blocks = n_blocks(keyed(docs, id_col, text_col), block_bytes)
    rows = encoded(docs, vocabulary, pieces, blocks, id_col, text_col)
    own = block_pairs(rows)
    told = own.select("block", "pair").join(pair_counts(own), "pair")

    def weigh(part: pa.Table, told: pa.Table) -> pa.Table:
        pair, docs_, best = (told[c].to_numpy() for c in ("pair", "docs", "best"))
        order = np.argsort(pair)
        pair, docs_, best = pair[order], docs_[order], best[order].astype(np.int64)
        n_best, count_sum = [], []
        for names, times in zip(part["pairs"].to_pylist(), part["times"].to_pylist(), strict=True):
            keys, n = uncounted(names, times)
            at = np.searchsorted(pair, keys)
            n_best.append(int((n * best[at]).sum()))
            count_sum.append(int((n * docs_[at]).sum()))
        new = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table({c: new.get(c, None) if c in new else part[c] for c in (f.split()[0] for f in ALIGNED.split(", "))})

    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(weigh, ALIGNED)
