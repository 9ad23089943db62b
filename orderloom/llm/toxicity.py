"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words sums their common subsequences of three characters, each weighted down by
the gaps it spans, so an insult with inserted characters or an ending of its own stays similar. A
few landmark words span the machine's space (Nyström). A sentence is as toxic as its most toxic
word, and a text as its most toxic sentence, which is also how the machine learns from labels that
texts carry as a whole: the words of clean sentences are all clean, a toxic text has a witness.

Since the decision is linear in the landmarks' subsequences, it folds into one table of character
triples, and a word costs a few look-ups.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, key_remainder, table

#: The fitted sample: so many labelled texts of each class by hash, and so much of each.
TOXIC_TEXTS, CLEAN_TEXTS, CHARS = 2000, 4000, 20_000
#: Landmarks of each class, and distinct clean words learnt from.
LANDMARKS, CLEAN_WORDS = 96, 25_000
#: Rounds of fitting, each with the clean words that the one before took for toxic.
ROUNDS = 3
#: Letters of the kernel, the weight of each character a subsequence spans, and its longest span.
LETTERS, DECAY, SPAN = 64, 0.6, 5
#: Longer words are read in windows.
WINDOW = 24
SHORT = 4
#: Of the curve from decision values to scores.
STEEPNESS = 3.0
REMEMBERED, SLICE = 150_000, 500
THRESHOLD = 0.7

SENTENCE = re.compile(r"[.!?\n]+")
#: Letters set apart by white space, as in ``a b c d``.
SPACED = re.compile(r"(?<!\S)\w(?:\s+\w){2,}(?!\S)")
#: The offsets of a subsequence's second and third character, with its weight.
GAPS = [(i, j, DECAY ** (j + 1)) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]


def words_of(text: str) -> list[str]:
    """Lower-case words as they stand, and runs of single letters put together."""
    text = text.lower()
    return text.split() + ["".join(m.group().split()) for m in SPACED.finditer(text)]


def plain(word: str) -> str:
    """The letters and digits of a word: marks set between them do not hide it."""
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


def _codes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the words as rows of letter numbers, 0 for none, and the word of each row."""
    rows, owner = [], []
    for i, word in enumerate(words):
        word = f"^{plain(word)}$"
        for start in range(0, max(1, len(word) - WINDOW // 2), WINDOW // 2):
            rows.append(word[start : start + WINDOW])
            owner.append(i)
            if start + WINDOW >= len(word):
                break
    wide = max(map(len, rows), default=1)
    points = np.array(rows, dtype=f"<U{wide}").view(np.uint32).reshape(len(rows), wide) if rows else np.zeros((0, 1), np.uint32)
    points = points.astype(np.int64)
    letters = np.where((points >= 97) & (points <= 122), points - 96, points % 35 + 27)
    letters = np.select([points == 0, points == 94, points == 36], [0, 63, 62], letters)
    return letters, np.array(owner, np.int64)


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Numbers of the subsequences that start at each place, -1 for none, for each pair of gaps."""
    wide = codes.shape[1]
    for i, j, weight in GAPS:
        if j < wide:
            a, b, c = codes[:, : wide - j], codes[:, i : wide - j + i], codes[:, j:]
            yield np.where(c > 0, (a * LETTERS + b) * LETTERS + c, -1), weight


def _norm(codes: np.ndarray) -> np.ndarray:
    """Scale of a row: as many subsequences as it has, as if all differed, and at least as many as
    a word of SHORT characters has, so that two or three letters in common are never much."""
    total, least = np.zeros(len(codes)), 0.0
    for found, weight in _triples(codes):
        total += (found >= 0).sum(axis=1) * weight**2
    for _, j, weight in GAPS:
        least += max(0, SHORT + 2 - j) * weight**2
    return np.sqrt(np.maximum(total, least))


class Landmarks:
    """Weights of the landmarks' subsequences; ``at`` finds a subsequence's row, 0 for none."""

    def __init__(self, words: Sequence[str]):
        codes, owner = _codes(words)
        norm = _norm(codes)
        each = list(_triples(codes))
        used = np.unique(np.concatenate([found[found >= 0] for found, _ in each]))
        self.at = np.zeros(LETTERS**3, np.int32)
        self.at[used] = np.arange(1, len(used) + 1)
        self.spread = np.zeros((len(used) + 1, len(words)), np.float32)
        for found, weight in each:
            rows, columns = np.nonzero(found >= 0)
            np.add.at(self.spread, (self.at[found[rows, columns]], owner[rows]), weight / norm[rows])

    def kernel(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel of each window of the words with every landmark, and the word of each window."""
        codes, owner = _codes(words)
        out = np.zeros((len(codes), self.spread.shape[1]), np.float32)
        for found, weight in _triples(codes):
            for column in found.T:
                has = np.flatnonzero(column >= 0)
                out[has] += weight * self.spread[self.at[column[has]]]
        out /= _norm(codes)[:, None].astype(np.float32)
        return out, owner

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """Weights of the landmarks as weights of triples."""
        return (self.spread @ weights)[self.at]


def _support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros(x.shape[1])
    hold = ridge * np.eye(len(w))
    hold[-1, -1] = 1e-6
    for _ in range(30):
        near = y * (x @ w) < 1
        part = x[near].astype(float)
        pull = part * weight[near, None]
        new = np.linalg.solve(pull.T @ part + hold, pull.T @ y[near])
        if np.abs(new - w).max() < 1e-6:
            break
        w = 0.5 * (w + new) if _ > 15 else new
    return w


class Model:
    """A table of triples and a bias: what the tasks need."""

    def __init__(self, triples: np.ndarray, bias: float):
        self.triples, self.bias = triples.astype(np.float32), float(bias)

    def decide(self, words: Sequence[str]) -> np.ndarray:
        """Decision value of each word, above 0 for toxic; the largest of its windows."""
        out = np.full(len(words), -np.inf)
        by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        for start in range(0, len(words), 20_000):
            at = np.array(by_size[start : start + 20_000])
            codes, owner = _codes([words[i] for i in at])
            total = np.zeros(len(codes))
            for found, weight in _triples(codes):
                total += weight * np.where(found >= 0, self.triples[found], 0).sum(axis=1)
            np.maximum.at(out, at[owner], total / _norm(codes) + self.bias)
        return out


def score(decision: float) -> float:
    """0 to 1; THRESHOLD at decision 0."""
    odds = np.log(THRESHOLD / (1 - THRESHOLD))
    return float(1.0 / (1.0 + np.exp(-STEEPNESS * np.clip(decision, -50, 50) - odds)))


def _significant(toxic: Counter, n_toxic: int, clean: Counter, n_clean: int) -> dict[str, int]:
    """Words that toxic texts hold and clean ones all but lack, too often for chance.

    A word of n texts falls into toxic ones only with probability share ** n; with as many words as
    there are, less than one in ten such finds may be chance.
    """
    least = np.log(10 * max(1, len(toxic))) / np.log((n_toxic + n_clean) / n_toxic)
    few = 0.05 * n_clean / n_toxic
    return {w: n for w, n in toxic.items() if n >= least and clean[w] <= few * n and len(w) > 2}


def _count(texts: Sequence[str]) -> tuple[Counter, Counter]:
    """Texts by word, and by the first 4 and 5 letters of longer words."""
    words, stems = Counter(), Counter()
    for text in texts:
        found = {plain(w) for s in SENTENCE.split(text) for w in words_of(s)} - {""}
        words.update(found)
        stems.update({w[:n] for w in found for n in (4, 5) if len(w) > n})
    return words, stems


def _with_inserts(word: str) -> list[str]:
    """The word with one more letter at each place inside it."""
    return [f"{word[:i]}{'xaqezo'[i % 6]}{word[i:]}" for i in range(1, len(word))]


def train(toxic: Sequence[str], clean: Sequence[str]) -> Model:
    """Fit on texts of both classes. Without either class every text scores alike, below 0.5.

    Toxic examples are the words that mark toxic sentences significantly, and the stems that do,
    each also with a letter inserted; clean examples are words of clean sentences, first the most
    frequent ones and then those that the machine so far finds most toxic.
    """
    nothing = Model(np.zeros(LETTERS**3), -1.0)
    toxic, clean = sorted(set(toxic)), sorted(set(clean))
    if not toxic or not clean:
        return nothing
    (toxic_count, toxic_stems), (clean_count, clean_stems) = _count(toxic), _count(clean)
    marks = _significant(toxic_count, len(toxic), clean_count, len(clean))
    stem_marks = _significant(toxic_stems, len(toxic), clean_stems, len(clean))
    del toxic_count, toxic_stems, clean_stems
    for stem, n in stem_marks.items():
        if not any(w.startswith(stem) and k >= 0.5 * n for w, k in marks.items()):
            marks[stem] = n
    if not marks:
        return nothing
    marked = sorted(marks, key=lambda w: (-marks[w], w))
    ordered = sorted((w for w in clean_count if clean_count[w] > 0), key=lambda w: (-clean_count[w], w))
    ordered = [w for w in ordered if w not in marks]
    known = ordered[:CLEAN_WORDS]
    landmarks = marked[:LANDMARKS] + known[:: max(1, len(known) // LANDMARKS)][:LANDMARKS]
    landmarks = [w[: WINDOW - 2] for w in landmarks]
    examples = [(w, marks[w]) for w in marked]
    examples += [(v, 0.5 * marks[w] / len(w)) for w in marked if len(w) > 3 for v in _with_inserts(w)]
    hard: list[str] = []
    for _ in range(ROUNDS):
        space = Landmarks(landmarks)
        values, vectors = np.linalg.eigh(space.kernel(landmarks)[0].astype(float))
        use = values > 1e-4 * values.max()
        whiten = (vectors[:, use] / np.sqrt(values[use])).astype(np.float32)
        kernel, owner = space.kernel([w for w, _ in examples])
        pull = np.array([examples[i][1] for i in owner], float)
        negatives, owner_of = space.kernel(known + hard)
        frequent = np.array([clean_count[known[i]] if i < len(known) else 0 for i in owner_of], float)
        push = 0.5 / len(owner_of) + 0.5 * frequent / frequent.sum() + np.where(owner_of < len(known), 0, 1 / max(100, len(hard)))
        w = _support_vectors(
            np.vstack([kernel @ whiten, negatives @ whiten]), np.r_[np.ones(len(owner)), -np.ones(len(owner_of))],
            np.r_[pull / pull.sum(), push] * 1000,
        )
        model = Model(space.folded(whiten @ w[:-1]), w[-1])
        value = model.decide(ordered)
        found = [ordered[i] for i in np.argsort(-value, kind="stable")[:2000] if value[i] > -0.5]
        if not found:
            break
        hard += found
        # What clean words fool the machine most become landmarks too.
        landmarks += [w[: WINDOW - 2] for w in found if w[: WINDOW - 2] not in landmarks][: LANDMARKS // 2]
    del ordered, clean_count, negatives, kernel, value
    scorer = Scorer(model)
    reached = ([max(scorer.values(t), default=model.bias) for t in texts] for texts in (toxic, clean))
    return Model(model.triples, model.bias - _cut(*map(np.sort, reached)))


def _cut(toxic: np.ndarray, clean: np.ndarray) -> float:
    """The decision value to part texts at, from sorted values of the training texts.

    Where all but one in a thousand clean texts stay below all but one in a hundred toxic ones, it
    lies between the two, nearer to the clean ones, since an insult with a letter inserted comes
    lower than the insult itself. Else it is the value with the fewest errors.
    """
    low, high = np.quantile(toxic, 0.01), np.quantile(clean, 0.999)
    if low > high:
        return float(high + 0.4 * (low - high))
    values = np.unique(np.concatenate([toxic, clean]))
    wrong = np.searchsorted(toxic, values) + len(clean) - np.searchsorted(clean, values)
    best = int(np.argmin(wrong))
    return float((values[best] + values[max(0, best - 1)]) / 2)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str]]:
    """The fitted sample: of each class the label of smallest hash in each of TOXIC_TEXTS or
    CLEAN_TEXTS slots, with one text of its id by hash; texts are cut at CHARS. Null labels and ids teach nothing."""
    chosen = labels.where("toxic is not null and doc_id is not null").selectExpr(
        "cast(doc_id as bigint) as id", "if(toxic = 0, 0, 1) as toxic", "xxhash64(doc_id, 6) as h"
    )
    slot = F.expr(f"pmod(h, if(toxic = 1, {TOXIC_TEXTS}, {CLEAN_TEXTS}))").alias("slot")
    chosen = chosen.groupBy("toxic", slot).agg(F.min_by("id", "h").alias("id"))
    # One text of an id, so that there are no more rows than slots however often an id repeats.
    found = docs.where("text is not null").selectExpr(
        "cast(doc_id as bigint) as id", f"substring(text, 1, {CHARS}) as start", "xxhash64(text, 6) as h"
    ).join(F.broadcast(chosen.select("id", "toxic")), "id")  # a bounded number of rows
    found = found.groupBy("id", "toxic").agg(F.expr("min_by(start, struct(h, start))").alias("start"))
    found = found.orderBy("id", "toxic").collect()
    return [r.start for r in found if r.toxic], [r.start for r in found if not r.toxic]


class Scorer:
    """Scores texts and remembers the words it has met; one for each Python process."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def _learn(self, bags: list[set[str]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*bags).difference(self.known))
        self.known.update(zip(new, self.model.decide(new).tolist(), strict=True))

    def values(self, text: str) -> list[float]:
        """Decision values of the words of one text."""
        words = set(words_of(text))
        self._learn([words])
        return list(map(self.known.__getitem__, words))

    def __call__(self, texts: Sequence[str | None]) -> list[float]:
        out = []
        for start in range(0, len(texts), SLICE):
            bags = [set(words_of(t or "")) for t in texts[start : start + SLICE]]
            self._learn(bags)
            out += [score(max(map(self.known.__getitem__, b), default=self.model.bias)) for b in bags]
        return out


def predict(df: DataFrame, model: Model, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with the score (0 to 1) of each whole text; a null, empty or wordless
    text scores as a text without any similarity to a landmark."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # fixed size
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carry).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                scores = pa.array(scorer(batch.column(len(carry)).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], scores], names=[*carry, "score"])

    return df.select(*carry, F.col(text).alias("_text")).mapInArrow(run, schema + ", score double")


def keep(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                scores = scorer(batch.column(at).to_pylist())
                yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return df.mapInArrow(run, df.schema)


#: A document with remainder 1 is held out and teaches nothing.
FOLDS = 3


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(*sample(docs, labels.where(key_remainder("doc_id", FOLDS) != 1)))


def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, table(spark, sf_dir, "labels"))
    docs = docs.withColumn("held_out", key_remainder("doc_id", FOLDS) == 1)
    docs = docs.selectExpr("cast(doc_id as bigint) as doc_id", "held_out", "text")
    scored = predict(docs, model, carry=("doc_id", "held_out"))
    return scored.withColumn("predicted", F.expr(f"if(score >= {THRESHOLD}D, 1, 0)"))
