"""A hidden Markov language model of words, trained by Baum-Welch over the partitions.

Frequent words are symbols of their own; all other words are emitted through a class, which their
last letters name: P(word | state) = P(class | state) * P(word | class). The states' tables are then
of fixed size and travel to the tasks, while the counts of the unbounded rest of the vocabulary stay
in a table and enter each text's likelihood by a join, as a sum that does not depend on the states.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, key_remainder, text_bytes, write_once

#: States, words with a symbol of their own, classes of the others.
STATES, HEAD, CLASSES = 8, 32_768, 1024
#: Baum-Welch rounds over all training texts: so many at the most, and after LEAST of them only while
#: a round gains this share of the log likelihood.
ROUNDS, LEAST, GAIN = 30, 10, 1e-4
#: Tokens that are worked on at once in training: texts of about one length, all of them whole.
TOKENS = 1_000_000
#: Places between two scalings of the states in training, and in scoring, which runs in double
#: precision; states that sum to less than FAINT make training scale at every place.
SCALED, SCALED_DOUBLE, FAINT = 4, 8, 1e-15
#: Tokens whose expected counts are added up at once.
PIECE = 65_536
#: Added to counts of words, and weight of the symbols' overall frequencies in a state's emissions.
ADD, PRIOR = 0.1, 50.0
#: Bytes of words that a task gathers before it counts them and hands the counts on.
COUNTED = 64 << 20


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def word_classes(words: pa.Array) -> np.ndarray:
    """``word_class`` of a column of words."""
    tails = pc.binary_slice(words, -3).dictionary_encode()
    classes = np.array([word_class(t) for t in tails.dictionary.to_pylist()], np.int32)
    return classes[tails.indices.to_numpy()]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of a column of texts (bytes), one text after another, lower-cased A-Z and split at ASCII
    white space as ``text.lower().split()`` does, and how many each text has."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = found.flatten().view(pa.binary())
    text = np.repeat(np.arange(len(texts)), found.value_lengths().to_numpy())
    full = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word there
    return words.filter(full), np.bincount(text[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


@dataclass
class Model:
    """``emit``: symbols by states; the last two rows are the end of a text and one that never comes."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray


@dataclass
class Vocabulary:
    """Symbols of the frequent words, with their counts, and the sums of the classes."""

    symbols: dict[bytes, int]
    counts: np.ndarray  # by symbol of a frequent word
    class_words: np.ndarray
    class_sums: np.ndarray
    ends: int
    words: int
    distinct: int

    @property
    def end(self) -> int:
        return len(self.symbols) + CLASSES

    @property
    def total(self) -> int:
        """Training tokens, ends counted."""
        return self.words + self.ends

    @property
    def base(self) -> float:
        """Denominator of the base model."""
        return self.total + ADD * (self.distinct + (self.ends > 0) + 1)

    def sequence(self, words: list[bytes]) -> np.ndarray:
        find, first = self.symbols.get, len(self.symbols)
        found = [first + word_class(w) if (s := find(w)) is None else s for w in words]
        found.append(self.end)
        return np.array(found, np.int32)

    def sequences(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """What ``sequence`` gives for a column of texts (bytes): their symbols one text after another,
        how many each text has, and the words without a symbol of their own."""
        words, sizes = split_words(texts)
        own = pc.index_in(words, value_set=pa.array(sorted(self.symbols, key=self.symbols.get), pa.binary()))
        rare = words.filter(own.is_null())
        found = own.fill_null(-1).to_numpy().copy()
        found[found < 0] = len(self.symbols) + word_classes(rare)
        symbols = np.full(len(words) + len(texts), self.end, np.int32)
        symbols[np.arange(len(words)) + np.repeat(np.arange(len(texts)), sizes)] = found
        return symbols, sizes + 1, rare

    def frequencies(self) -> np.ndarray:
        """Share of each symbol in training, smoothed; the last has none."""
        each = np.concatenate([self.counts, self.class_sums, [self.ends]]) + ADD
        return np.append(each / each.sum(), 0.0)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words, handed on before they fill its memory."""

    def out() -> pa.RecordBatch:
        found = pa.concat_arrays(held).value_counts()
        words = found.field("values")
        return pa.RecordBatch.from_arrays([words, pa.array(word_classes(words)), found.field("counts")], names=["word", "class", "n"])

    held: list[pa.Array] = []
    for batch in batches:
        for low in range(0, batch.num_rows, 2000):
            words = split_words(batch.column("text").slice(low, 2000))[0]
            if held and words.nbytes + sum(w.nbytes for w in held) > COUNTED:
                yield out()
                held.clear()
            held.append(words)
    if held:
        yield out()


def count_words(texts: DataFrame) -> DataFrame:
    """word, class and count n of all words of column text (bytes)."""
    found = texts.select("text").mapInArrow(_count, "word binary, class int, n long")
    return found.groupBy("word", "class").agg(F.sum("n").alias("n"))


def vocabulary(words: DataFrame, ends: int) -> Vocabulary:
    """The HEAD most frequent words, cut at a count so that ties stay together, and class sums."""
    level = "cast(floor(16 * log2(n)) as int)"
    levels = words.groupBy(F.expr(level).alias("level")).count().orderBy(F.desc("level")).collect()
    room, least = HEAD, 1 << 30
    for r in levels:
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    head = sorted((r.word, r.n) for r in words.where(f"{level} >= {least}").select("word", "n").collect())
    rest = words.where(f"{level} < {least}").groupBy("class").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"))
    class_words, class_sums = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rest.collect():
        class_words[r["class"]], class_sums[r["class"]] = r.words, r.n
    counts = np.array([n for _, n in head], float)
    return Vocabulary(
        {bytes(w): i for i, (w, _) in enumerate(head)}, counts, class_words, class_sums, ends,
        int(counts.sum() + class_sums.sum()), int(len(head) + class_words.sum()),
    )


def first_model(v: Vocabulary, seed: int = 7) -> Model:
    """Sticky states whose emissions are the symbols' frequencies, shaken."""
    rng = np.random.default_rng(seed)
    share = v.frequencies()
    emit = share[:, None] * rng.gamma(2.0, 1.0, (len(share), STATES))
    emit /= emit.sum(axis=0)
    emit[-1] = 1.0
    move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
    return Model(emit, move, np.full(STATES, 1 / STATES))


def _ahead(ahead, seen, start, move, running: list[int], every: int) -> tuple[np.ndarray, float]:
    """Fills ``ahead`` with the states by the emissions ``seen``, scaled ahead and in ``seen`` after so
    many places. Returns the sums of the logs of a sequence's scales, and the least scale; a faint one
    ends the work, unless each place is scaled."""
    one = np.ones((STATES, STATES), np.float32)  # the sum of a row, in each of its columns
    logs, least = np.zeros(running[0]), 1.0
    low, n = 0, 0
    for t, m in enumerate(running):
        now, here = ahead[low + n : low + n + m], seen[low + n : low + n + m]
        if t:
            np.dot(ahead[low : low + m], move, now)
            np.multiply(now, here, now)
        else:
            np.multiply(here, start, now)
        low, n = low + n, m
        if t % every == every - 1:
            scale = np.dot(now, one)
            least = min(least, float(scale.min()))
            if every > 1 and least <= FAINT:
                break
            now /= scale
            here /= scale
            logs[:m] += np.log(scale[:, 0].astype(float))
    return logs, least


def _back(back, seen, move, running: list[int]) -> None:
    """Fills ``back`` from the sequences' last places, and multiplies it into ``seen``."""
    high = len(seen)
    for n, m in zip(running[:0:-1], running[-2::-1], strict=True):
        low = high - n
        here = seen[low:high]
        np.multiply(here, back[low:high], here)
        np.dot(here, move, back[low - m : low - m + n])
        high = low


class Counts:
    """Expected counts of a Baum-Welch round; they add up over tasks."""

    def __init__(self, symbols: int):
        self.emit = np.zeros((symbols, STATES))
        self.move = np.zeros((STATES, STATES))
        self.start = np.zeros(STATES)
        self.score = 0.0
        self._held = np.empty((3, 0, STATES), np.float32)

    def add(self, m: Model, sequences: list[np.ndarray], times: np.ndarray | None = None) -> None:
        """Forward and backward over whole sequences, each counted so many times. Sequences come in any
        order, but the nearer in length, the more of them run side by side."""
        sizes = np.array([len(s) for s in sequences])
        times = np.ones(len(sizes)) if times is None else np.asarray(times, float)
        order = np.argsort(-sizes, kind="stable")
        first = np.cumsum(sizes[order]) - sizes[order]
        for part in np.split(order, np.flatnonzero(np.diff(first // TOKENS)) + 1):
            self._add(m, [sequences[i] for i in part], sizes[part], times[part])

    def _room(self, tokens: int) -> np.ndarray:
        """Three tables of states by token, kept from one call to the next."""
        if self._held.shape[1] < tokens:
            self._held = np.empty((3, tokens + tokens // 8, STATES), np.float32)
        return self._held[:, :tokens]

    def _add(self, m: Model, sequences: list[np.ndarray], sizes: np.ndarray, times: np.ndarray) -> None:
        """Sequences, longest first, place by place: those still running stand in front, so that each
        step works on whole rows. Single precision is enough, as emissions are taken relative to their
        symbol's largest and states are scaled, while counts and the likelihood add up in double."""
        running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # sizes > place
        begins = np.cumsum(running) - running
        rank = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tokens = np.empty(len(rank), np.int64)
        tokens[begins[place] + rank] = np.concatenate(sequences)
        last = begins[sizes - 1] + np.arange(len(sizes))
        top = m.emit.max(axis=1)
        emit, move = (m.emit / top[:, None]).astype(np.float32), m.move.astype(np.float32)
        ahead, seen, back = self._room(len(tokens))
        for every in (SCALED, 1):
            emit.take(tokens, axis=0, out=seen, mode="clip")
            logs, least = _ahead(ahead, seen, m.start.astype(np.float32), move, running.tolist(), every)
            z = ahead[last].sum(axis=1)
            if min(least, z.min()) > FAINT:
                break
        self.score += float((logs + np.log(z.astype(float))) @ times)
        back[last] = (times / z).astype(np.float32)[:, None]
        _back(back, seen, np.ascontiguousarray(move.T), running.tolist())
        # Places of equally many sequences stand one after another, and so do the places before them.
        moved = np.zeros((STATES, STATES))
        cuts = [*np.flatnonzero(np.diff(running)).tolist(), len(running) - 1]
        for a, b in zip([0, *(c + 1 for c in cuts)], cuts, strict=False):
            n, low, high = running[a], begins[a], begins[b]
            if a < b:
                moved += ahead[low:high].T @ seen[low + n : high + n]
            if b + 1 < len(running):
                n = running[b + 1]
                moved += ahead[high : high + n].T @ seen[begins[b + 1] : begins[b + 1] + n]
        self.move += m.move * moved
        ahead *= back
        self.start += ahead[: len(sizes)].sum(axis=0, dtype=float)
        found, lines = np.zeros((STATES, len(m.emit))), np.empty((STATES, PIECE))
        for low in range(0, len(tokens), PIECE):
            some = tokens[low : low + PIECE]
            lines[:, : len(some)] = ahead[low : low + PIECE].T
            for k in range(STATES):
                found[k] += np.bincount(some, lines[k, : len(some)], len(m.emit))
        self.emit += found.T
        self.score += float(np.log(top) @ found.sum(axis=0))

    def model(self, v: Vocabulary) -> Model:
        emit = self.emit + PRIOR * v.frequencies()[:, None]
        emit[-1] = 0
        emit /= emit.sum(axis=0)
        emit[-1] = 1.0
        move = self.move + 1.0
        start = self.start + 1.0
        return Model(emit, move / move.sum(axis=1, keepdims=True), start / start.sum())


def encode(texts: DataFrame, v: Vocabulary) -> DataFrame:
    """The different sequences of symbols of column text (bytes), as 32-bit numbers, and how often each
    comes; written once for all rounds, those of about one length together."""
    sent = texts.sparkSession.sparkContext.broadcast(v)  # HEAD words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                symbols, sizes, _ = sent.value.sequences(batch.column("text").slice(low, 2000))
                ends = np.append(0, symbols.itemsize * np.cumsum(sizes)).astype(np.int32)
                buffers = [None, pa.py_buffer(ends), pa.py_buffer(symbols)]
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(sizes), buffers)], names=["symbols"])

    found = texts.select("text").mapInArrow(run, "symbols binary").groupBy("symbols").agg(F.count(F.lit(1)).alias("times"))
    return write_once(found.sortWithinPartitions(F.desc(F.octet_length("symbols"))), "sequences")


def _expect(sent):
    columns = [f"s{k}" for k in range(STATES)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        counts = Counts(len(m.emit))
        held: list[np.ndarray] = []
        times: list[int] = []
        tokens = 0
        for batch in batches:
            for data, n in zip(batch.column("symbols").to_pylist(), batch.column("times").to_pylist(), strict=True):
                held.append(np.frombuffer(data, np.int32))
                times.append(n)
                tokens += len(held[-1])
                if tokens >= TOKENS:
                    counts.add(m, held, times)
                    held, times, tokens = [], [], 0
        if held:
            counts.add(m, held, times)
        rows = np.flatnonzero(counts.emit.any(axis=1))
        # Moves, starts and the log likelihood travel as symbols below 0.
        names = np.concatenate([rows, -1 - np.arange(STATES), [-1 - STATES, -2 - STATES]])
        table = np.vstack([counts.emit[rows], counts.move, counts.start, np.full(STATES, counts.score)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), *(pa.array(table[:, k].astype(np.float32)) for k in range(STATES))],
            names=["symbol", *columns],
        )

    return run


def baum_welch(sequences: DataFrame, m: Model, v: Vocabulary) -> tuple[Model, float]:
    """One round over all sequences of ``encode``, each read whole: tasks add up expected counts, Spark
    adds up the tasks'. Also returns the log likelihood of the texts under ``m``."""
    sent = sequences.sparkSession.sparkContext.broadcast(m)  # HEAD + CLASSES symbols
    columns = [f"s{k}" for k in range(STATES)]
    found = sequences.mapInArrow(_expect(sent), "symbol int, " + ", ".join(f"{c} float" for c in columns))
    sums = found.groupBy("symbol").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    symbol, values = sums["symbol"].to_numpy(), np.column_stack([sums[c].to_numpy() for c in columns])
    counts = Counts(len(m.emit))
    counts.emit[symbol[symbol >= 0]] = values[symbol >= 0]
    rest = dict(zip(symbol[symbol < 0].tolist(), values[symbol < 0], strict=True))
    if rest:
        counts.move = np.array([rest[-1 - k] for k in range(STATES)])
        counts.start, counts.score = rest[-1 - STATES], float(rest[-2 - STATES][0])
    sent.unpersist()
    return counts.model(v), counts.score


def forward(m: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of whole sequences by the scaled forward recursion, longest first, so that
    at each place the sequences still running stand in front."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([sequences[i] for i in order])
    sizes = sizes[order]
    begins = np.cumsum(sizes) - sizes
    running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # sizes > place
    one = np.ones((STATES, STATES))  # the sum of a row, in each of its columns
    total = np.zeros(len(sizes))
    state = np.tile(m.start, (len(sizes), 1))
    for t, n in enumerate(running.tolist()):
        if n < len(state):
            total[n : len(state)] += np.log10(state[n:].sum(axis=1))
        state = np.dot(state[:n], m.move) if t else state
        state *= m.emit.take(flat.take(begins[:n] + t), axis=0)
        if t % SCALED_DOUBLE == SCALED_DOUBLE - 1:
            scale = np.dot(state, one)
            total[:n] += np.log10(scale[:, 0])
            state /= scale
    total[: len(state)] += np.log10(state.sum(axis=1))
    out = np.empty(len(sizes))
    out[order] = total
    return out


def _score(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, v = sent.value
        base = np.log10((v.counts + ADD) / v.base)
        base_end = float(np.log10((v.ends + ADD) / v.base))
        of_class = -np.log10(v.class_sums + ADD * (v.class_words + 1))
        first = len(v.symbols)
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [v.sequences(batch.column("text").slice(low, 2000)) for low in range(0, batch.num_rows, 2000)]
            symbols, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            begins = np.cumsum(sizes) - sizes
            plain, other = symbols < first, (symbols >= first) & (symbols < v.end)
            each = np.zeros(len(symbols))
            each[plain] = base[symbols[plain]]
            sums = np.add.reduceat(each, begins) + base_end
            each = np.zeros(len(symbols))
            each[other] = of_class[symbols[other] - first]
            score = forward(m, np.split(symbols, begins[1:])) + np.add.reduceat(each, begins)
            known = np.add.reduceat(plain, begins, dtype=np.int64) + (v.ends > 0)
            # The other words of each text, equal ones once with their number.
            words = pa.concat_arrays([p[2] for p in parts]).dictionary_encode()
            kinds = max(len(words.dictionary), 1)
            text = np.repeat(np.arange(len(sizes)), np.add.reduceat(other, begins, dtype=np.int64))
            pairs, times = np.unique(text * kinds + words.indices.to_numpy(), return_counts=True)
            ends = pa.array(np.searchsorted(pairs, np.arange(len(sizes) + 1) * kinds), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                    pa.array(sums, pa.float64()), pa.array(score, pa.float64()),
                    pa.ListArray.from_arrays(ends, words.dictionary.take(pa.array(pairs % kinds))),
                    pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
                ],
                names=["doc_id", "held_out", "n_tokens", "known", "base", "score", "rare", "times"],
            )

    return run


def score(texts: DataFrame, m: Model, v: Vocabulary, words: DataFrame) -> DataFrame:
    """Likelihoods of all texts: the states' part in the tasks, rare words by a join on the word."""
    sent = texts.sparkSession.sparkContext.broadcast((m, v))
    part = texts.select("doc_id", "held_out", "text").mapInArrow(
        _score(sent),
        "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
        "rare array<binary>, times array<int>",
    )
    part = write_once(part.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = part.selectExpr("row", "inline(arrays_zip(rare, times))").withColumnRenamed("rare", "word")
    found = rare.join(words.select("word", "n"), "word", "left").groupBy("row").agg(
        F.expr(f"sum(times * log10(coalesce(n, 0) + {ADD}D))").alias("sum"),
        F.sum("times").alias("rare_tokens"),
        F.expr("sum(if(n > 0, times, 0))").alias("rare_known"),
    )
    out = part.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "score").join(found, "row", "left")
    return out.selectExpr(
        "doc_id", "held_out", "n_tokens", "known + coalesce(rare_known, 0) as n_known",
        f"cast({v.total} as bigint) as train_tokens",
        f"base + coalesce(sum, 0) - coalesce(rare_tokens, 0) * log10({v.base!r}D) as base_score",
        "score + coalesce(sum, 0) as score",
    )


def fit(train: DataFrame) -> tuple[Model, Vocabulary, DataFrame]:
    """Model, vocabulary and the table of all word counts of the texts (bytes) in ``train``."""
    words = write_once(count_words(train), "words")
    ends = train.count()
    v = vocabulary(words, ends)
    m = first_model(v)
    last = -np.inf
    sequences = encode(train, v)
    for k in range(ROUNDS if ends else 0):
        m, value = baum_welch(sequences, m, v)
        if k >= LEAST and value - last < GAIN * abs(value):
            break
        last = value
    return m, v, words


#: A document with remainder 0 is held out and teaches nothing.
FOLDS = 10


def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored. Words are lower-cased A-Z and split at ASCII white space, each text ends
    with an end token. A null or empty text is the end alone. Without training texts every word is
    unknown and the states are those of the start."""
    docs = documents(spark, sf_dir)
    texts = docs.select(
        F.expr("cast(doc_id as bigint)").alias("doc_id"),
        (key_remainder("doc_id", FOLDS) == 0).alias("held_out"), text_bytes("text").alias("text"),
    )
    m, v, words = fit(texts.where("not held_out"))
    return score(texts, m, v, words)
