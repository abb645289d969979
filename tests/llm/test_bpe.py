import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def texts():
    rng = random.Random(3)
    out = ["", "  a", "a  b\t\n c \n\n", "x<|endoftext|> y <|endoftext|>", "　 日本語  ''s don't 12,345   ",
           "a" * 3000, "ab" * 900, "a \x1c b\x85 c", "I'll  we'Re\n\n\n  q ", "\x00́ é é 🙂🙂", " " * 500 + "x"]
    for alphabet in (" \n\t'aehst1.é日<|", "aehsting ", "ab", "Ġ ĊÃ©"):
        out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 70))) for _ in range(400)]
    return out


def test_ids_and_text_equal_the_library(library, encoder):
    decoder = bpe.Decoder(PATH)
    for t, want in zip(texts(), library.encode_batch(texts(), add_special_tokens=False), strict=True):
        ids = encoder.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, t
        assert decoder.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == t


def test_a_pair_is_compatible_if_merging_leaves_it(library, encoder):
    rng = random.Random(5)
    ids = [i for i in range(256, 3000) if encoder.tokens[i].isalpha()]
    for _ in range(500):
        a, b = rng.choice(ids), rng.choice(ids)
        whole = (encoder.tokens[a] + encoder.tokens[b]).decode()
        assert encoder.compatible(a, b) == (library.encode(whole, add_special_tokens=False).ids == [a, b])


def test_digests(make_docs, library):
    rows = list(enumerate(texts()[:60])) + [(None, "null id"), (900, None), (901, "x"), (901, "x")]
    got = sorted(map(tuple, bpe.digests(make_docs(rows), PATH).collect()), key=str)
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.digests(make_docs([]), PATH).count() == 0


def test_round_trip_in_spark(make_docs):
    rows = [(i, t) for i, t in enumerate(texts()[:30])]
    back = bpe.decoded(bpe.encoded(make_docs(rows), PATH), PATH).collect()
    assert {r.doc_id: r.text for r in back} == dict(rows)
