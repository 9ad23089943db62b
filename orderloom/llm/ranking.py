"""Text quality by pairwise ranking (Bradley-Terry).

A document's score is a sum over features of its text; that of two documents a is better than b has
the probability ``sigmoid(score(a) - score(b))``. The weights are learnt from preference pairs, a
document labelled good before one labelled bad, by logistic loss on the differences of their
features. Scores have no zero of their own: the cut is the quantile of the labelled documents'
scores below which as many lie as are labelled bad.

Features are shares of neighbouring kinds of bytes (a capital after a capital, a symbol after a
letter ...) and how words and lines repeat, all independent of the text's length. Each is read
through steps at quantiles of the labelled documents, so the sum can take any shape in it.

Steps, weights and cut come from all labelled documents (``fit``): the loss is that of every good one
against every bad one. Its slope needs, of each document, only how the other class's scores lie, so a
round takes two passes over the documents' codes: one counts the scores of both classes, one adds up
the slope. A small fit on the driver (``train``) tells where the rounds begin and their curvature.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, key_remainder, table, write_once

#: Where the rounds begin: a fit on so many labelled documents of each class, by hash.
GOOD, BAD = 4000, 2000
#: Documents of the other class that each of these is compared with.
PAIRS = 6
#: Rounds over all labelled documents at the most, and the share of the loss that the last ones gain.
ROUNDS, GAIN = 60, 1e-6
#: Share of the mean curvature that is added in every direction.
DAMPING = 0.01
#: Lengths of a round's step that are tried at once.
LENGTHS = (4.0, 1.0, 0.5, 0.25, 1 / 16, 1 / 64, 1 / 256)
#: Scores are counted on a grid, each at the two points beside it: its half width and its points.
HALF, POINTS = 128.0, 8193
#: Weights of the grid and slopes are added up as whole numbers, so their sums are exact in any order.
PARTS, UNIT = 256, 1 << 20
#: Values of a feature as 32-bit numbers are told apart but for so many of their last bits.
LOW_BITS = 16
#: Bins of a round of finding the cut, and rounds at the most.
BINS, CUTS = 4096, 5
#: Steps of a feature for each class, and the pull of weights towards 0.
STEPS, RIDGE = 8, 0.05
THRESHOLD = 0.3
SLICE = 500

#: Kinds of bytes, each with the bytes it holds; all others are of one more kind.
KINDS = (
    b" \t", b"\n\r\v\f", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:!?", b"'\"()-",
    bytes(set(range(33, 127)) - set(b".,;:!?'\"()-") - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123))),
    bytes(range(128, 192)), bytes(range(192, 256)),
)
N = len(KINDS) + 1
KIND_OF = np.full(256, len(KINDS), np.uint8)
for _number, _held in enumerate(KINDS):
    KIND_OF[list(_held)] = _number
WORDS = ("again", "again_after_one", "run", "distinct", "top", "length", "single", "lines", "same_lines")
FEATURES = N * N + len(WORDS)


def _word_features(data: bytes) -> list[float]:
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(WORDS)
    count = Counter(words)
    run = longest = 1
    if len(count) < n:
        for same in map(eq, words[1:], words):
            run = run + 1 if same else 1
            if run > longest:
                longest = run
    again = sum(map(eq, words[1:], words))
    lines = [line for line in data.split(b"\n") if line]
    return [
        again / n, sum(map(eq, words[2:], words)) / n, float(longest), np.log(len(count)) / np.log(n + 1),
        (max(count.values()) - 1) / n, sum(map(len, words)) / n, sum([len(w) == 1 for w in words]) / n,
        len(lines) / n, 1 - len(set(lines)) / max(1, len(lines)),
    ]


def features(texts: Sequence[bytes]) -> np.ndarray:
    """A line of features for each whole text; a text without bytes has zeros."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, data in zip(out, texts, strict=True):
        if not data:
            continue
        kinds = KIND_OF[np.frombuffer(data, np.uint8)]
        pairs = np.bincount(kinds[:-1].astype(np.int64) * N + kinds[1:], minlength=N * N)
        row[: N * N] = pairs / len(data)
        row[N * N :] = _word_features(data)
    return out


class Model:
    """For each feature the places of its steps and the height behind each: what the tasks need."""

    def __init__(self, steps: list[np.ndarray], heights: list[np.ndarray], cut: float):
        self.steps, self.heights, self.cut = steps, heights, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for column, steps, heights in zip(x.T, self.steps, self.heights, strict=True):
            if len(steps):
                total += heights[np.searchsorted(steps, column, side="left")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, THRESHOLD at the cut."""
        odds = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x) - self.cut + odds, -50, 50)))


#: Quantiles of each class at which steps stand.
AT_GOOD, AT_BAD = np.append(np.arange(STEPS) / STEPS, [0.01, 0.99]), np.arange(STEPS) / STEPS


def _steps(good: np.ndarray, bad: np.ndarray) -> list[np.ndarray]:
    """Places of steps: quantiles of each class, but for the greatest value of all."""
    out = []
    for a, b in zip(good.T, bad.T, strict=True):
        places = np.unique(np.concatenate([np.quantile(a, AT_GOOD), np.quantile(b, AT_BAD)]))
        out.append(places[places < max(a.max(), b.max())])
    return out


def _above(x: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    return np.hstack([(column[:, None] > s) for column, s in zip(x.T, steps, strict=True)]).astype(np.float32)


def bradley_terry(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of least logistic loss on the differences of each pair, by Newton steps."""
    return _newton(better, worse, ridge)[0]


def _newton(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """The weights and the loss's second derivatives by them."""
    d = (better - worse).astype(np.float64)
    w, bend = np.zeros(d.shape[1]), np.eye(d.shape[1])

    def loss(v):
        return np.logaddexp(0, -d @ v).mean() + ridge / 2 * (v @ v) / len(w)

    for _ in range(25):
        p = 1 / (1 + np.exp(d @ w))
        slope = -(d.T @ p) / len(d) + ridge * w / len(w)
        bend = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge / len(w) * np.eye(len(w))
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-4:
            break
    return w, bend


def _flat() -> Model:
    none = [np.zeros(0)] * FEATURES
    return Model(none, none, np.log(THRESHOLD / (1 - THRESHOLD)))


def _on_pairs(good: np.ndarray, bad: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights by PAIRS comparisons of each document, and the loss's second derivatives."""
    x, y = _above(good, steps), _above(bad, steps)
    rng = np.random.default_rng(13)
    first = np.concatenate([np.repeat(np.arange(len(x)), PAIRS), rng.integers(0, len(x), PAIRS * len(y))])
    second = np.concatenate([rng.integers(0, len(y), PAIRS * len(x)), np.repeat(np.arange(len(y)), PAIRS)])
    return _newton(x[first], y[second])


def _heights(w: np.ndarray, steps: list[np.ndarray]) -> list[np.ndarray]:
    cuts = np.cumsum([len(s) for s in steps])[:-1]
    return [np.concatenate([[0.0], np.cumsum(part)]) for part in np.split(w, cuts)]


def train(good: np.ndarray, bad: np.ndarray) -> Model:
    """Fit on features of documents of both classes. Without either all texts score 0.5 and stay."""
    if not len(good) or not len(bad):
        return _flat()
    steps = _steps(good, bad)
    model = Model(steps, _heights(_on_pairs(good, bad, steps)[0], steps), 0.0)
    scores = np.sort(model.raw(np.vstack([good, bad])))
    # As many scores lie below the cut as documents are bad; it is halfway to the next.
    model.cut = float((scores[len(bad) - 1] + scores[len(bad)]) / 2)
    return model


def sample(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features of documents to begin with, good and bad: of each class the label of smallest hash in each of
    GOOD or BAD slots, with one whole text of its id by hash. Null labels, ids and texts teach nothing."""
    chosen = labels.where("quality is not null and doc_id is not null").selectExpr(
        "cast(doc_id as bigint) as id", "if(quality = 0, 0, 1) as good", "xxhash64(doc_id, 13) as h"
    )
    slot = F.expr(f"pmod(h, if(good = 1, {GOOD}, {BAD}))").alias("slot")
    chosen = chosen.groupBy("good", slot).agg(F.min_by("id", "h").alias("id")).select("id", "good")
    texts = docs.where("text is not null").selectExpr("cast(doc_id as bigint) as id", "cast(text as binary) as data")
    texts = texts.join(F.broadcast(chosen), "id")  # a bounded number of rows
    # One text of an id, so that there are no more rows than slots however often an id repeats.
    texts = texts.groupBy("id", "good").agg(F.expr("min_by(data, struct(xxhash64(data, 13), data)) as data"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                x = features(part.column("data").to_pylist())
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, FEATURES, dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("good"), lists], names=["id", "good", "x"])

    found = texts.mapInArrow(run, "id long, good int, x array<float>").toArrow().sort_by([("id", "ascending")])
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    good = found["good"].to_numpy() == 1
    return x[good], x[~good]


def _scores(model: Model, column: pa.Array) -> pa.Array:
    return pa.array(model.score(features([b"" if t is None else t for t in column.to_pylist()])), pa.float64())


def predict(df: DataFrame, model: Model, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with the score (0 to 1) of each whole text. A null text counts as empty; an
    empty one scores as a text without any of the features. Repeated rows score alike, an empty table
    has no rows."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # fixed size
    rows = df.select(*(f"`{c}`" for c in carry), F.col(f"`{text}`").cast("binary").alias("_data"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                scores = _scores(sent.value, batch.column(len(carry)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], scores], names=[*carry, "score"])

    return rows.mapInArrow(run, schema + ", score double")


def keep(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores the threshold or more, with all their columns, whatever their names."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                data = batch.column(at).cast(pa.binary())
                yield batch.filter(pa.compute.greater_equal(_scores(sent.value, data), threshold))

    return df.mapInArrow(run, df.schema)


#: A document with remainder 0 is held out and teaches nothing.
FOLDS = 5


def _rows(batch: pa.RecordBatch, column: str, kind: type) -> np.ndarray:
    """A line of FEATURES numbers for each row."""
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), kind).reshape(-1, FEATURES)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """good and features x (32-bit numbers) of every whole text with a label. A repeated label counts
    once, each text of a repeated id for itself. Null labels, ids and texts teach nothing."""
    known = labels.where("quality is not null and doc_id is not null")
    known = known.selectExpr("cast(doc_id as bigint) as id", "if(quality = 0, 0, 1) as good").distinct()
    texts = docs.where("text is not null and doc_id is not null")
    texts = texts.selectExpr("cast(doc_id as bigint) as id", "cast(text as binary) as data")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                x = [row.tobytes() for row in features(part.column("data").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(x, pa.binary())], names=["id", "x"])

    # Features before the join: they are shorter than texts.
    found = texts.mapInArrow(run, "id long, x binary").join(known, "id").select("good", "x")
    return write_once(found, "features")


def _sums(df: DataFrame, cells, size: int) -> np.ndarray:
    """``cells`` turns a batch into numbers of cells and a whole number for each, or 1 for all; the sums
    of each of ``size`` cells over all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                np.add.at(total, *cells(batch))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "n"])

    found = df.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


def _steps_of_all(found: DataFrame) -> tuple[list[np.ndarray], int, int]:
    """``_steps`` over all rows of ``labelled``, and how many are good and bad. A value is the bucket of
    numbers that share its leading bits, as features are never negative, and a step is its greatest."""
    buckets = 1 << (32 - 1 - LOW_BITS)

    def cells(batch: pa.RecordBatch) -> tuple[np.ndarray, int]:
        bits = (_rows(batch, "x", np.float32).view(np.uint32) >> LOW_BITS).astype(np.int64)
        good = batch.column("good").to_numpy().astype(np.int64)
        return (good[:, None] * FEATURES + np.arange(FEATURES)) * buckets + bits, 1

    counts = _sums(found, cells, 2 * FEATURES * buckets).reshape(2, FEATURES, buckets)
    bad, good = (int(c[0].sum()) for c in counts)
    steps: list[np.ndarray] = []
    if bad and good:
        for b, g in zip(*counts, strict=True):
            at = [np.searchsorted(np.cumsum(c), q * (n - 1), "right") for c, q, n in ((g, AT_GOOD, good), (b, AT_BAD, bad))]
            at = np.unique(np.concatenate(at))
            at = at[at < np.flatnonzero(b + g)[-1]]
            steps.append((((at + 1) << LOW_BITS) - 1).astype(np.uint32).view(np.float32).astype(float))
    return steps, good, bad


class _Passes:
    """What is added up over all labelled documents for given weights."""

    def __init__(self, found: DataFrame, steps: list[np.ndarray], good: int, bad: int):
        self.steps, self.good, self.bad = steps, good, bad
        sizes = np.array([len(s) + 1 for s in steps])
        self.begins, self.cells = np.cumsum(sizes) - sizes, int(sizes.sum())
        self.later = np.ones(self.cells, bool)  # cells but the first of each feature: one for each weight
        self.later[self.begins] = False

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _rows(batch, "x", np.float32)
                codes = np.column_stack([np.searchsorted(s, c, "left") for s, c in zip(steps, x.T, strict=True)])
                codes = [row.tobytes() for row in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(codes, pa.binary())], names=["good", "codes"])

        self.codes = write_once(found.mapInArrow(run, "good int, codes binary"), "codes")

    def flat(self, w: np.ndarray) -> np.ndarray:
        """Heights of all features, one behind the other."""
        return np.concatenate(_heights(w, self.steps))

    def grid(self, w: np.ndarray, d: np.ndarray, lengths: Sequence[float]) -> np.ndarray:
        """How the scores lie at ``w + length * d``: by length, class (bad, good) and point of the grid."""
        begins, base, slope = self.begins, self.flat(w), self.flat(d)

        def cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            at = _rows(batch, "codes", np.uint8) + begins
            good = batch.column("good").to_numpy().astype(np.int64)
            scores, slopes = base[at].sum(axis=1), slope[at].sum(axis=1)
            low, share = zip(*(_on_grid(scores + length * slopes) for length in lengths), strict=True)
            low = np.array(low) + (np.arange(len(lengths))[:, None] * 2 + good) * POINTS
            above = np.rint(np.array(share) * PARTS).astype(np.int64)
            return np.array([low, low + 1]), np.array([PARTS - above, above])

        return _sums(self.codes, cells, len(lengths) * 2 * POINTS).reshape(-1, 2, POINTS) / PARTS

    def slope(self, w: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Slope of the loss by the weights, with the scores as ``grid`` counted them at ``w``: of each
        good document the mean chance that a bad one wins, of each bad one that it wins."""
        begins, base, size = self.begins, self.flat(w), self.cells
        bad, good = scores
        wins = 1 / (1 + np.exp(-_GAPS))
        chances = np.array([_against(wins[::-1], good) / self.good, _against(wins, bad) / self.bad])

        def cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            at = _rows(batch, "codes", np.uint8) + begins
            own = batch.column("good").to_numpy().astype(np.int64)
            low, share = _on_grid(base[at].sum(axis=1))
            chance = chances[own, low] * (1 - share) + chances[own, low + 1] * share
            return at + size * own[:, None], np.rint(chance * UNIT).astype(np.int64)[:, None]

        bad, good = _sums(self.codes, cells, 2 * size).reshape(2, size) / UNIT
        by_cell = bad / self.bad - good / self.good
        ends = np.append(self.begins[1:], size)
        # A weight lifts all cells from its step on.
        on = [np.cumsum(by_cell[a:b][::-1])[::-1] for a, b in zip(self.begins, ends, strict=True)]
        return np.concatenate(on)[self.later] + RIDGE * w / len(w)

    def loss(self, w: np.ndarray, scores: np.ndarray) -> float:
        """Mean over all pairs of a good and a bad document."""
        bad, good = scores
        return float(good @ _against(np.logaddexp(0, _GAPS), bad)) / self.good / self.bad + RIDGE / 2 * (w @ w) / len(w)

    def cut(self, w: np.ndarray) -> float:
        """As many documents score below as are bad; among equal scores it is that score."""
        begins, base = self.begins, self.flat(w)
        ends = np.append(begins[1:], self.cells)
        low, high = (sum(f(base[a:b]) for a, b in zip(begins, ends, strict=True)) for f in (np.min, np.max))
        low, high = low - 1, high + 1
        for _ in range(CUTS):
            edges = np.linspace(low, high, BINS)

            def cells(batch: pa.RecordBatch, edges=edges) -> tuple[np.ndarray, int]:
                return np.searchsorted(edges, base[_rows(batch, "codes", np.uint8) + begins].sum(axis=1), "right"), 1

            below = np.cumsum(_sums(self.codes, cells, BINS + 1))[:-1]  # of each edge
            between = np.flatnonzero(below == self.bad)
            if len(between):
                return float((edges[between[0]] + edges[between[-1]]) / 2)
            k = int(np.searchsorted(below, self.bad, "right"))
            low, high = edges[k - 1], edges[k]
        return float(low)


_GAPS = np.arange(1 - POINTS, POINTS) * (2 * HALF / (POINTS - 1))


def _on_grid(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The point of the grid below each score and how far on the way to the next it lies."""
    place = (np.clip(scores, -HALF, HALF) + HALF) * ((POINTS - 1) / (2 * HALF))
    low = np.minimum(place.astype(np.int64), POINTS - 2)
    return low, place - low


def _against(of_gap: np.ndarray, others: np.ndarray) -> np.ndarray:
    """At each point of the grid the sum of ``of_gap``, a function on _GAPS of another one's lead, over
    ``others``, the number at each point."""
    return np.correlate(of_gap, others, "valid")[::-1]


def _descend(passes: _Passes, w: np.ndarray, curvature: np.ndarray | None) -> np.ndarray:
    """Weights of least loss over all pairs from ``w`` on, by quasi-Newton steps (L-BFGS)."""
    inverse = None
    if curvature is not None:  # weights that the small fit says little of must not run ahead
        inverse = np.linalg.inv(curvature + DAMPING * np.trace(curvature) / len(w) * np.eye(len(w)))
    scores = passes.grid(w, w, [0.0])[0]
    loss, slope, past = passes.loss(w, scores), passes.slope(w, scores), []
    for _ in range(ROUNDS):
        d, kept = slope, []
        for s, y in reversed(past):
            kept.append(s @ d / (s @ y))
            d = d - kept[-1] * y
        if inverse is not None:
            d = inverse @ d
        elif past:
            d = d * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, y), a in zip(past, reversed(kept), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        grids = passes.grid(w, -d, LENGTHS)
        tried = [passes.loss(w - a * d, g) for a, g in zip(LENGTHS, grids, strict=True)]
        best = int(np.argmin(tried))
        if not tried[best] < loss * (1 - GAIN):
            break
        s = -LENGTHS[best] * d
        w, loss, before = w + s, tried[best], slope
        slope = passes.slope(w, grids[best])
        if s @ (slope - before) > 0:
            past = [*past, (s, slope - before)][-10:]
    return w


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Steps, weights and cut by all labelled documents that are not held out."""
    taught = key_remainder("doc_id", FOLDS) != 0
    docs, labels = docs.where(taught), labels.where(taught)
    found = labelled(docs, labels)
    steps, good, bad = _steps_of_all(found)
    if not good or not bad:
        return _flat()
    passes = _Passes(found, steps, good, bad)
    w, curvature = np.zeros(sum(map(len, steps))), None
    if len(w):
        few_good, few_bad = sample(docs, labels)
        if len(few_good) and len(few_bad):
            w, curvature = _on_pairs(few_good, few_bad, steps)
        w = _descend(passes, w, curvature)
    return Model(steps, _heights(w, steps), passes.cut(w))


def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, table(spark, sf_dir, "labels"))
    docs = docs.withColumn("held_out", key_remainder("doc_id", FOLDS) == 0)
    docs = docs.selectExpr("cast(doc_id as bigint) as doc_id", "held_out", "text")
    scored = predict(docs, model, carry=("doc_id", "held_out"))
    return scored.withColumn("predicted", F.expr(f"if(score >= {THRESHOLD}D, 1, 0)"))
