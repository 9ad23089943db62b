from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from orderloom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def exact(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    letters = "abcdeEST  \n\t\r'sré漢字🙂1239.,-\x0b\x1c\x85\xa0 \u3000<|>"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    out += ["a" * 5000, "ab" * 3000, " " * 3000 + "x", "\n" * 777, "漢" * 500, "0123456789" * 300, "it's", "<|endoftext|>"]
    return out + ["".join(rng.choice("abcdefgh") for _ in range(20_000)), "word, " * 50_000]


def test_equals_library(ranks, exact):
    codec = bpe.Codec(ranks, PATTERN, bpe.Pairs.build(ranks))
    for text, ids in zip(texts(), codec.encode(texts()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == exact.encode_ordinary(text), text[:60]
        assert codec.decode(ids) == text.encode()


def test_other_pattern_and_ranks(ranks):
    """Without the short cuts, and with ranks that were not learnt in order."""
    rng = random.Random(2)
    small = {bytes([i]): i for i in range(256)}
    tokens = {bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 6))) for _ in range(40)}
    small |= {t: 256 + i for i, t in enumerate(rng.sample(sorted(tokens), len(tokens)))}
    codec = bpe.Codec(small, r"[\s\S]+", bpe.Pairs.build(small))
    exact = tiktoken.Encoding("x", pat_str=r"[\s\S]+", mergeable_ranks=small, special_tokens={})
    for n in (1, 2, 3, 30, 64, 65, 400):
        for _ in range(20):
            text = "".join(rng.choice("ab ") for _ in range(n))
            assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == exact.encode_ordinary(text)


def test_operators(spark, make, exact):
    rows = [(i, t) for i, t in enumerate([None, "", "Hello, world", "Hello, world", "ü " * 9000])]
    docs = make(rows)
    found = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).orderBy("doc_id").collect()
    for (i, t), r in zip(rows, found, strict=True):
        assert r.ids == exact.encode_ordinary(t or "") and bytes(r.data) == (t or "").encode() and r.score == "x"
    trip = bpe.round_trip(docs, PATH, PATTERN).orderBy("doc_id").collect()
    for (_, t), r in zip(rows, trip, strict=True):
        ids = exact.encode_ordinary(t or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(make([]), PATH, PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [31373])], "i int, ids array<int>")
    assert [bytes(r.data) for r in bpe.decode(nulls, PATH, PATTERN).orderBy("i").collect()] == [b"", b"hello"]
