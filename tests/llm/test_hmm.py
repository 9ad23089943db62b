from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderloom.llm import hmm

SMALL = "/root/testdata/sf0.01"


def small_model(rng, symbols=5):
    emit = rng.random((symbols, hmm.STATES))
    emit /= emit.sum(axis=0)
    move = rng.random((hmm.STATES, hmm.STATES))
    start = rng.random(hmm.STATES)
    return hmm.Model(np.vstack([emit, np.ones(hmm.STATES)]), move / move.sum(axis=1, keepdims=True), start / start.sum())


def paths(m, seq):
    """Probability of every path of states."""
    for path in itertools.product(range(hmm.STATES), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for a, b, s in zip(path, path[1:], seq[1:], strict=False):
            p *= m.move[a, b] * m.emit[s, b]
        yield path, p


def test_forward_and_counts_equal_all_paths():
    m = small_model(np.random.default_rng(1))
    seqs = [np.array(s) for s in ([0], [1, 2, 0, 3], [4, 4, 1], [2, 2])]
    totals = [sum(p for _, p in paths(m, s)) for s in seqs]
    assert np.allclose(hmm.forward(m, seqs), np.log10(totals))
    emit, move, start = np.zeros_like(m.emit), np.zeros_like(m.move), np.zeros_like(m.start)
    for s, total in zip(seqs, totals, strict=True):
        for path, p in paths(m, s):
            start[path[0]] += p / total
            for symbol, k in zip(s, path, strict=True):
                emit[symbol, k] += p / total
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p / total
    counts = hmm.Counts(len(m.emit))
    counts.add(m, seqs)
    assert np.allclose(counts.emit[:-1], emit[:-1]) and np.allclose(counts.move, move) and np.allclose(counts.start, start)


def test_emissions_are_a_distribution():
    v = hmm.Vocabulary({b"a": 0, b"b": 1}, np.array([5.0, 3.0]), np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES), 4, 8, 2)
    m = hmm.first_model(v)
    counts = hmm.Counts(len(m.emit))
    counts.add(m, [v.sequence([b"a", b"b", b"zz"])] * 3)
    for model in (m, counts.model(v)):
        assert np.allclose(model.emit[:-1].sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)


def plain_base(rows):
    counts, ends = Counter(), 0
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update((t or "").encode().lower().split())
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for i, t in rows:
        seen = [counts[w] for w in (t or "").encode().lower().split()] + [ends]
        out.append((str(i), len(seen), sum(c > 0 for c in seen), total, sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in seen)))
    return sorted(out)


def check(found, rows):
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    for a, b in zip(got, plain_base(rows), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)


def test_documents(spark):
    found = hmm.score_documents(spark, SMALL).collect()
    check(found, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


@pytest.mark.parametrize("empty", [False, True])
def test_edges(spark, make, monkeypatch, tmp_path, empty):
    monkeypatch.setattr(hmm, "HEAD", 40)
    monkeypatch.setattr(hmm, "COUNTED", 50)
    rows = [] if empty else [(i, f"the cat{i % 7} Sat on mat{i} the ende") for i in range(200)]
    rows += [] if empty else [(500, None), (501, ""), (502, "\x1c   x"), (None, "the cat"), (5, "the the"), (5, "the the"), (503, "unseen " * 30_000)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = hmm.score_documents(spark, str(tmp_path)).collect()
    check(found, rows)
    assert all(math.isfinite(r.score) for r in found)


def test_every_round_reads_all_texts_whole(spark, monkeypatch):
    """Two rounds equal two plain rounds over whole texts, what stands after character 4,000 included."""
    monkeypatch.setattr(hmm, "ROUNDS", 2)
    texts = [f"{'early words ' * 400}{'late text here ' * 50}t{i % 3}".encode() for i in range(20)]
    train = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id long, text binary")
    m, v, _ = hmm.fit(train)
    want = hmm.first_model(v)
    for _ in range(2):
        counts = hmm.Counts(len(want.emit))
        counts.add(want, [v.sequence(t.lower().split()) for t in texts])
        want = counts.model(v)
    assert np.allclose(m.emit, want.emit, rtol=1e-3) and np.allclose(m.move, want.move, rtol=1e-3)


def plain_counts(m, seq):
    """Expected counts of one sequence by the textbook recursions, in double, place by place."""
    alpha, scale = [m.start * m.emit[seq[0]]], []
    for s in seq[1:]:
        scale.append(alpha[-1].sum())
        alpha[-1] = alpha[-1] / scale[-1]
        alpha.append((alpha[-1] @ m.move) * m.emit[s])
    scale.append(alpha[-1].sum())
    alpha[-1] = alpha[-1] / scale[-1]
    emit, move, beta = np.zeros_like(m.emit), np.zeros_like(m.move), np.ones(hmm.STATES)
    for t in range(len(seq) - 1, -1, -1):
        emit[seq[t]] += alpha[t] * beta
        if t:
            seen = m.emit[seq[t]] * beta / scale[t]
            move += m.move * np.outer(alpha[t - 1], seen)
            beta = m.move @ seen
        else:
            start = alpha[0] * beta
    return emit, move, start, np.log(scale).sum()


@pytest.mark.parametrize("tokens", [600, 10**6])
def test_long_sequences_are_not_cut(monkeypatch, tokens):
    monkeypatch.setattr(hmm, "TOKENS", tokens)
    rng = np.random.default_rng(2)
    m = small_model(rng)
    seqs = [rng.integers(0, 5, n) for n in (500, 1, 2, 64, 65, 129, 500, 3)]
    times = np.array([1, 5, 1, 2, 1, 1, 3, 1])
    counts = hmm.Counts(len(m.emit))
    counts.add(m, seqs, times)
    want = [sum(n * x for n, x in zip(times, parts, strict=True)) for parts in zip(*(plain_counts(m, s) for s in seqs), strict=True)]
    for got, exact in zip((counts.emit, counts.move, counts.start, counts.score), want, strict=True):
        assert np.allclose(got, exact, rtol=1e-4)


def test_score_of_the_query_equals_a_plain_version(spark, monkeypatch):
    """Vocabulary, rounds, likelihoods and the rare words' part, all again without Spark."""
    monkeypatch.setattr(hmm, "HEAD", 300)
    monkeypatch.setattr(hmm, "ROUNDS", 3)
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    train = [words for i, words in rows if zlib.crc32(str(i).encode()) % 10]
    found = {r.doc_id: r.score for r in hmm.score_documents(spark, folder).collect()}
    _, v, _ = hmm.fit(spark.createDataFrame([(bytearray(b" ".join(w)),) for w in train], "text binary"))
    n = Counter(w for words in train for w in words)
    head = set(v.symbols)
    assert head == {w for w, k in n.items() if k >= min(n[h] for h in head)} and all(v.counts[v.symbols[w]] == n[w] for w in head)
    rare = Counter(hmm.word_class(w) for w in n.elements() if w not in head)
    kinds = Counter(hmm.word_class(w) for w in n if w not in head)
    m = hmm.first_model(v)
    for _ in range(3):
        parts = [plain_counts(m, v.sequence(words)) for words in train]
        counts = hmm.Counts(len(m.emit))
        counts.emit, counts.move, counts.start = (sum(p[k] for p in parts) for k in range(3))
        m = counts.model(v)
    for i, words in rows:
        *_, likelihood = plain_counts(m, v.sequence(words))
        word = lambda w: math.log10((n[w] + 0.1) / (rare[hmm.word_class(w)] + 0.1 * (kinds[hmm.word_class(w)] + 1)))
        score = likelihood / math.log(10) + sum(word(w) for w in words if w not in head)
        assert found[i] == pytest.approx(score, rel=1e-4)


def test_a_block_of_tokens_is_worked_on_at_once(monkeypatch):
    """The sequence that fills a block stays with it, instead of running place by place on its own."""
    monkeypatch.setattr(hmm, "TOKENS", 1000)
    m = small_model(np.random.default_rng(3))
    parts = []
    monkeypatch.setattr(hmm.Counts, "_add", lambda self, m, sequences, sizes, times: parts.append(len(sequences)))
    hmm.Counts(len(m.emit)).add(m, [np.zeros(300, int)] * 4)
    assert parts == [4]


@pytest.mark.parametrize("faint", [1e-3, 1e-6, 1e-12])
def test_faint_states_are_scaled_at_every_place(faint):
    """States that hardly change and words that hardly any state has, whose product is below single precision."""
    emit = np.full((3, hmm.STATES), faint)
    emit[0, ::2] = emit[1, 1::2] = 1 - faint
    emit[2] = 1.0
    move = np.full((hmm.STATES, hmm.STATES), faint / hmm.STATES) + (1 - faint) * np.eye(hmm.STATES)
    start = np.full(hmm.STATES, faint)
    start[0] += 1 - start.sum()
    m = hmm.Model(emit, move, start)
    seqs, times = [np.array(x) for x in ([0, 1] * 20, [1] * 9, [1, 1, 0], [1])], [1, 3, 1, 2]
    counts = hmm.Counts(len(emit))
    counts.add(m, seqs, times)
    want = [sum(n * x for n, x in zip(times, parts, strict=True)) for parts in zip(*(plain_counts(m, s) for s in seqs), strict=True)]
    for got, exact in zip((counts.emit, counts.move, counts.start, counts.score), want, strict=True):
        assert np.allclose(got, exact, rtol=1e-3, atol=1e-5)
    assert np.allclose(hmm.forward(m, seqs), [plain_counts(m, s)[3] / math.log(10) for s in seqs])


@pytest.mark.parametrize("head", [[], [b"a", b"ab", b"\xc3\xa9"]])
def test_symbols_of_a_column_equal_those_of_its_texts(head):
    v = hmm.Vocabulary({w: i for i, w in enumerate(head)}, np.ones(len(head)), np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES), 1, 1, 1)
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abAB \t\n\x0b\x0c\r\x1c\x85\xa0\xc3\xa9\x00", np.uint8)
    texts = [b"", b"  ", b"\x1c", b" A  ab\n"] + [rng.choice(letters, n).tobytes() for n in rng.integers(0, 40, 500)]
    for low in (0, 3):  # a slice as well
        symbols, sizes, rare = v.sequences(pa.array(texts, pa.binary()).slice(low))
        words = [t.lower().split() for t in texts[low:]]
        each = [v.sequence(w) for w in words]
        assert sizes.tolist() == [len(s) for s in each] and symbols.tolist() == np.concatenate(each).tolist()
        assert rare.to_pylist() == [w for some in words for w in some if w not in v.symbols]


@pytest.mark.parametrize("most", [50, 1 << 20])
def test_counts_of_a_task_equal_plain_ones(monkeypatch, most):
    monkeypatch.setattr(hmm, "COUNTED", most)
    texts = [b"", b" the Cat", b"cat\xff the\x1c"] + [f"the w{i % 7} {'Far ' * (i % 3)}".encode() for i in range(5000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["text"]) for some in (texts, [], texts[:3])]
    got = Counter()
    for found in hmm._count(batches):
        for word, kind, n in zip(*(c.to_pylist() for c in found.columns), strict=True):
            got[word] += n
            assert kind == hmm.word_class(word)
    assert got == Counter(w for t in texts + texts[:3] for w in t.lower().split())
    assert list(hmm._count([])) == []
