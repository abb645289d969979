import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemart.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(12))
def test_fill_uses_every_piece_once(seed):
    rng = random.Random(seed)
    cap, n = rng.choice([8, 64, 1024]), rng.choice([0, 1, 40, 3000])
    counts = Counter(rng.choice([rng.randint(1, cap), cap, int(rng.triangular(1, cap, cap // 4))]) for _ in range(n))
    plan, used = packing.fill(dict(counts), cap), Counter()
    for lengths, times in plan:
        assert times > 0 and 0 < sum(lengths) <= cap
        used.update({k: v * times for k, v in Counter(lengths).items()})
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    assert -(-total // cap) <= sum(t for _, t in plan) <= 1.02 * total / cap + 3


def test_fill_finds_exact_complements():
    assert sum(t for _, t in packing.fill({6: 5, 4: 5, 5: 10, 3: 4, 2: 2, 1: 2, 7: 2}, 10)) == 14  # 132 tokens


def test_cut_makes_the_first_piece_the_short_one():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def check(rows, got, capacity=1024):
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        k = -(-len(ids) // capacity)
        ends = [len(ids) - capacity * (k - 1 - i) for i in range(k)]
        for i, e in enumerate(ends):
            s = ends[i - 1] if i else 0
            want[d, i, s, e - s, zlib.crc32(ids[s:e].tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_pack_documents(make_docs, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["the", "of", "xyzzy", "12", "é"]) for _ in range(rng.choice([3, 50, 900, 4000]))))
            for i in range(80)]
    rows += [(200, ""), (201, None), (None, "no id"), (202, "same"), (202, "same"), (203, "a<|endoftext|>b"),
             (204, "z" * 30_000)]
    monkeypatch.setattr(packing, "GROUP", 7)  # many salts
    check(rows, packing.pack_documents(make_docs(rows), PATH).collect())


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), PATH).count() == 0


def test_memo_table_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 10)
    words = packing.WordTokens(PATH)
    text = " ".join(f"w{i}" for i in range(50))
    assert len(words(text)) and len(words.memo) <= 10
    assert words(text) == packing.WordTokens(PATH)(text)
