"""Alignment against the two libraries, byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemart.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    # how byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on, in order
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in shown}
    char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    assert set(char) == set(ByteLevel.alphabet())
    return t, char, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    """[(id, first byte, end)] by each library; nothing if the bytes differ."""
    t, char, sp = libraries
    if not text:
        return [], []
    whole, out = (" " + text).encode(), []
    a = [(i, bytes(char[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
         for i in sp.encode(text)]
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    for side in (a, b):
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def brute(rows, libraries):
    split = [tokens(t, libraries) for _, t in rows]
    every = [[(x, y) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in split]
    held = Counter(p for links in every for p in {(x[0], y[0]) for x, y in links})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), (a, b), links in zip(rows, split, every, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, at, in_groups = [], 0, 0
        for end in cuts:
            own = [[str(x[0]) for x in side if at < x[2] <= end] for side in (a, b)]
            groups.append("|".join(",".join(x) for x in own))
            in_groups += len(own[0]) * len(own[1])
            at = end
        n = [held[x[0], y[0]] for x, y in links]
        best = sum(k == most[x[0]] for k, (x, _) in zip(n, links, strict=True))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(groups), len(links), best, sum(n), digest, in_groups))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    texts = ["The quick brown fox", "the the the", "naïve café — 𝔘nicode 😀😀", "▁starts with the space mark", "a▁b",
             "<|endoftext|> and <s> or </s><unk> and <0x41>", "  leading", "trailing  ", "tabs\tand\nlines\r\n", "x", " ", "\n",
             "x" * 400, "日本語のテキスト", "\x00\x01", None, "", "é decomposed ﬁ ligature", "100,000.00 $"]
    texts += ["".join(rng.choices("aeioust nrl,.\n", k=rng.randint(1, 90))) for _ in range(60)]
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(15).collect()
    texts += [r["text"][:700] for r in given] + ["The quick brown fox"] * 4
    return [*enumerate(texts), (None, "The quick brown fox"), (0, "other text"), (0, "other text")]


@pytest.mark.parametrize("block_bytes", [300, 1 << 25])
def test_equals_the_libraries_byte_by_byte(make_docs, rows, libraries, block_bytes):
    got = alignment.align(make_docs(rows), A, B, block_bytes=block_bytes)
    assert got.columns == [f.split()[0] for f in alignment.ALIGNED.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, libraries), key=str)


def test_link_rows(make_docs, rows, libraries):
    some = [(i, t) for i, t in rows if i is not None and i > 0][:60]
    want = []
    for i, t in some:
        a, b = tokens(t, libraries)
        for m, x in enumerate(a):
            for k, y in enumerate(b):
                shared = min(x[2], y[2]) - max(x[1], y[1])
                if shared > 0:
                    want.append((i, "overlap", m, k, x[0], y[0], shared))
    assert sorted(map(tuple, alignment.links(make_docs(some), A, B).collect())) == sorted(want)
    groups = alignment.links(make_docs(some), A, B, kind="group").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in groups} == {r[0]: r[8] for r in brute(some, libraries) if r[8]}


def test_counts(make_docs, libraries):
    some = [(1, "ab cd"), (2, "ab cd"), (3, "ab"), (4, None)]
    got = {(r["a_id"], r["b_id"]): r["documents"] for r in alignment.counts(make_docs(some), A, B).collect()}
    want = Counter(p for _, t in some for a, b in [tokens(t, libraries)]
                   for p in {(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]})
    assert got == want


def test_empty_table(make_docs):
    assert alignment.align(make_docs([]), A, B).count() == 0


def test_products_equal_dense_ones():
    rng = np.random.default_rng(2)
    dense = [(rng.random(s) < 0.3).astype(int) for s in ((50, 40), (40, 30))]
    left, right = (alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1], m.shape[1]) for m in dense)
    out = np.zeros((50, 30), dtype=int)
    for r, c, v in alignment.row_products(left, right, rows=7):
        out[r, c] = v
    assert (out == dense[0] @ dense[1]).all()
    assert (alignment.row_sizes(left, right) == (dense[0] @ dense[1]).sum(axis=1)).all()
    t = right.transposed()
    assert (np.diff(t.indptr) == dense[1].sum(axis=0)).all() and t.columns == 40
