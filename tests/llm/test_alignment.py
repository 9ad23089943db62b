from __future__ import annotations

import collections
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from orderloom.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
FILES = queries.JSON, queries.MODEL
LIBRARY = tokenizers.Tokenizer.from_file(FILES[0])
LIBRARY.encode_special_tokens = True


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(*alignment._files(*FILES))


def plain_ids(both, text):
    """Ids of both libraries for the whole text, none if one of them changes its bytes."""
    if not text:
        return [], []
    a, b = LIBRARY.encode(f" {text}", add_special_tokens=False).ids, both.b.encode(text)
    spelt = [b"".join(tokens[i] for i in ids) for ids, tokens in ((a, both.a_bytes), (b, both.b_bytes))]
    return (a, b) if spelt == [f" {text}".encode()] * 2 else ([], [])


def plain_groups(both, a, b):
    """Token by token: whichever side is behind goes on until both end together."""
    out, x, y, i, j = [], [], [], 0, 0
    at_a = at_b = 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a) and (at_a < at_b or not x):
            x.append(a[i])
            at_a += len(both.a_bytes[a[i]])
            i += 1
        else:
            y.append(b[j])
            at_b += len(both.b_bytes[b[j]])
            j += 1
        if at_a == at_b and x and y:
            out.append((x, y))
            x, y = [], []
    return out


def plain_rows(both, rows):
    groups = {i: (a, b, plain_groups(both, a, b)) for i, t in rows for a, b in [plain_ids(both, t)]}
    count = collections.Counter((x[-1], y[-1]) for _, _, g in groups.values() for x, y in g)
    highest = collections.Counter()
    for (_, y), n in count.items():
        highest[y] = max(highest[y], n)
    out = []
    for i, (a, b, g) in groups.items():
        links = [(x[-1], y[-1]) for x, y in g]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        best = sum(count[k] == highest[k[1]] for k in links)
        sha = hashlib.sha256(text.encode()).hexdigest() if g else ""
        out.append((i, len(a), len(b), len(g), len(links), best, sum(count[k] for k in links), sha))
    return sorted(out)


def found_rows(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("step", [1, 2, 7, 64])
def test_merge_in_pieces(step):
    rng = np.random.default_rng(step)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 300, rng.integers(0, 150))) for _ in "ab")
        i, j = alignment.crossings(a, b, step)
        assert (np.diff(i + j) <= step).all() and i[-1] == len(a) and j[-1] == len(b)
        at_a, at_b = alignment.shared_ends(a, b, step)
        assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_one_sided_list_is_cut_into_equal_pieces():
    i, j = alignment.crossings(np.arange(1000), np.array([999]), 64)
    assert np.diff(i + j)[:-1].tolist() == [64] * 15 and np.diff(i).max() <= 64


def test_query_equals_plain_version(spark, both):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert found_rows(queries.op12_token_alignment(spark, SMALL)) == plain_rows(both, rows)


def test_edges(spark, make, both):
    texts = [
        None, "", " ", "a", "same text, twice.", "same text, twice.", "two  spaces and a tail ", "a▁b", "x ▁y", "\n", "tab\there",
        "<|endoftext|> <s> </s> <0x41>", "日本語 テスト", "é ﬁ   \x00 \r\n", "nul\x1c it's", "a.b, c.", "long word " * 3000, "z" * 5000,
    ]
    rows = list(enumerate(texts))
    asked = make(rows)
    assert found_rows(alignment.link_documents(asked, *FILES)) == plain_rows(both, rows)
    assert alignment.link_documents(make([]), *FILES).count() == 0
    # Columns of the caller stay, but for the four names.
    clash = asked.selectExpr("doc_id", "text", "1 as a_ids", "2 as _text", "score")
    aligned = alignment.align(clash, *FILES)
    assert aligned.columns == ["doc_id", "_text", "score", *alignment.ALIGNED]
    for row in aligned.collect():
        assert sum(row.a_sizes) == len(row.a_ids) and sum(row.b_sizes) == len(row.b_ids) and row._text == 2


def test_words_are_forgotten_when_there_are_too_many(both, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    own = alignment.Tokenizers(*alignment._files(*FILES))
    for text in ("one two three four.", "one two", "five, six seven eight"):
        assert [np.frombuffer(x, "<i4").tolist() for x in own.encode([text])[0]] == list(plain_ids(both, text))


def test_encoder_without_ranks_gives_the_same_ids(both):
    """A file whose merges do not come in the order of ids is left to its own library."""
    parts = json.loads(alignment._files(*FILES)[0])
    merges = parts["model"]["merges"]
    last = "".join(merges[-1])
    vocab = parts["model"]["vocab"]
    other = next(t for t, i in vocab.items() if i == vocab[last] - 1)
    vocab[last], vocab[other] = vocab[other], vocab[last]
    encode, entries = alignment._byte_level(json.dumps(parts))
    text = " it's  plain, é 12 <|endoftext|>\n ok"
    assert encode([text]) == [LIBRARY.encode(text, add_special_tokens=False).ids] and entries[last] == vocab[last]


def test_linkable_pairs():
    pairs = alignment.linkable([b"ab", b"b", b"c"], [b"b", b"ab", b"xc", b"b"])
    assert {(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()} == {(0, 0), (0, 1), (0, 3), (1, 0), (1, 1), (1, 3), (2, 2)}


def test_byte_letters_are_those_of_the_vocabulary(both):
    letters = alignment.byte_letters()
    assert sorted(letters.values()) == list(range(256)) and set(letters) <= set(LIBRARY.get_vocab())
    assert public_tokenizers.path("byte_bpe_50k.json") == FILES[0]
