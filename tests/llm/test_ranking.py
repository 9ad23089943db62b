from __future__ import annotations

import zlib

import numpy as np
import pytest

from orderloom.llm import ranking

SMALL = "/root/testdata/sf0.1"


def test_pair_weights_are_those_of_least_loss():
    """Against plain gradient descent on the same loss."""
    rng = np.random.default_rng(1)
    x, y = rng.random((80, 3)) + [0.5, 0, -0.3], rng.random((80, 3))
    w = ranking.bradley_terry(x, y, ridge=0.3)
    plain = np.zeros(3)
    for _ in range(20_000):
        wins = 1 / (1 + np.exp(-(x - y) @ plain))
        plain += 0.1 * (((x - y) * (1 - wins)[:, None]).mean(axis=0) - 0.3 * plain / 3)
    assert np.allclose(w, plain, atol=1e-3)


def test_features_of_hand_made_texts():
    x = ranking.features([b"", b"aa aa aa b", "A\nA\né!".encode()])
    names = dict(zip(ranking.WORDS, x[1][ranking.N**2 :], strict=True))
    assert not x[0].any()
    assert names["again"] == 0.5 and names["again_after_one"] == 0.25 and names["run"] == 3 and names["top"] == 0.5
    assert names["single"] == 0.25 and names["same_lines"] == 0
    third = dict(zip(ranking.WORDS, x[2][ranking.N**2 :], strict=True))
    assert third["lines"] == 1 and np.isclose(third["same_lines"], 1 / 3)
    # All pairs of neighbouring bytes are counted.
    assert np.isclose(x[1][: ranking.N**2].sum(), 9 / 10) and ranking.KIND_OF.max() == ranking.N - 1


def test_score_is_the_sum_over_steps():
    rng = np.random.default_rng(2)
    good, bad = rng.random((60, ranking.FEATURES)), rng.random((40, ranking.FEATURES)) * 0.8
    model = ranking.train(good, bad)
    for row in good[:5]:
        plain = sum(h[(s < v).sum()] for v, s, h in zip(row, model.steps, model.heights, strict=True) if len(s))
        assert np.isclose(model.raw(row[None])[0], plain)
    scores = model.raw(np.vstack([good, bad]))
    assert (scores < model.cut).sum() == 40


def test_held_out(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    found = ranking.score_documents(spark, SMALL).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    assert len(held) > 500
    assert ((held.predicted == 0) & (held.quality == 1)).sum() <= 0.01 * (held.quality == 1).sum()
    assert ((held.predicted == 1) & (held.quality == 0)).sum() <= 0.05 * (held.quality == 0).sum()
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    prose = [" ".join(rng.choice(words, 40)).encode() + b"." for _ in range(150)]
    junk = [" ".join([w.upper() + "!!" for w in rng.choice(words, 40)]).encode() for _ in range(50)]
    junk += [b" ".join([w.encode()] * 30) for w in words]
    return ranking.train(ranking.features(prose), ranking.features(junk))


def test_edges(spark, make, model):
    asked = make([(1, None), (1, "ALPHA!! BETA!! GAMMA!!"), (2, ""), (3, "alpha beta. gamma"), (3, "alpha beta. gamma"), (4, "eta " * 100_000), (5, "\n\n"), (None, "ñ")])
    scores = ranking.predict(asked, model).collect()
    assert len(scores) == 8 and all(0 <= r.score <= 1 for r in scores)
    by_id = {r.doc_id: r.score for r in scores}
    assert by_id[4] < 0.3 <= by_id[3]
    clash = asked.withColumnRenamed("t", "_data").withColumnRenamed("c", "held_out")
    kept = ranking.keep(clash, model)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.where("doc_id in (3, 4)").collect()] == [3, 3]
    assert ranking.predict(make([]), model).count() == 0 and ranking.keep(make([]), model).count() == 0


def test_without_a_class(spark, make):
    none = np.zeros((0, ranking.FEATURES))
    for model in (ranking.train(none, none), ranking.train(ranking.features([b"a b"]), none)):
        assert [r.score for r in ranking.predict(make([(1, "a"), (2, None)]), model).collect()] == [0.5, 0.5]


def test_sample_is_bounded_however_often_an_id_repeats(spark, make):
    docs = make([(1, f"text {i}") for i in range(50)] + [(2, "two"), (3, None), (4, "four")])
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    good, bad = ranking.sample(docs, labels)
    assert good.shape == (1, ranking.FEATURES) and bad.shape == (1, ranking.FEATURES)
    assert ranking.sample(make([]), labels)[0].shape == (0, ranking.FEATURES)


def _mixed(n: int, seed: int) -> list[str]:
    """Texts whose classes overlap: each word is junk or not by the text's own share."""
    rng = np.random.default_rng(seed)
    words = np.array("alpha beta gamma delta epsilon zeta eta theta".split())
    return [" ".join(np.where(rng.random(30) < share, np.char.upper(w), w)) for share in rng.beta(2, 2, n) for w in [rng.choice(words, 30)]]


def test_steps_weights_and_cut_come_from_all_labelled_documents(spark, make, monkeypatch):
    monkeypatch.setattr(ranking, "GOOD", 60)  # the rounds begin with some of them
    monkeypatch.setattr(ranking, "BAD", 45)
    rng = np.random.default_rng(4)
    texts = _mixed(300, 4)
    upper = np.array([sum(map(str.isupper, t)) / len(t) for t in texts])
    quality = (upper + rng.normal(0, 0.2, len(texts)) < 0.45).astype(int)
    docs = make(list(enumerate(texts)))
    labels = spark.createDataFrame([*enumerate(quality.tolist())] * 2, "doc_id long, quality int")  # each label twice
    model = ranking.fit(docs, labels)
    taught = np.array([zlib.crc32(str(i).encode()) % ranking.FOLDS != 0 for i in range(len(texts))])
    x = ranking.features([t.encode() for t in texts])
    good, bad = x[taught & (quality == 1)], x[taught & (quality == 0)]
    assert len(good) > 50 and len(bad) > 50
    # As many lie below the cut as are bad.
    scores = model.raw(np.vstack([good, bad]))
    assert (scores < model.cut).sum() == len(bad)
    # Steps are the quantiles of all, but for how finely values are told apart.
    for mine, plain in zip(model.steps, ranking._steps(good, bad), strict=True):
        if len(mine) and len(plain):
            assert abs(mine[-1] - plain[-1]) <= 0.15 * plain[-1] + 0.02
    # The loss over every pair is the least there is.
    above_good, above_bad = ranking._above(good, model.steps), ranking._above(bad, model.steps)
    i, j = np.divmod(np.arange(len(good) * len(bad)), len(bad))
    least = ranking.bradley_terry(above_good[i], above_bad[j])

    def loss(weights):
        gaps = above_bad @ weights - (above_good @ weights)[:, None]
        return np.logaddexp(0, gaps).mean() + ranking.RIDGE / 2 * (weights @ weights) / len(weights)

    found = np.concatenate([np.diff(h) for h in model.heights])
    begun = ranking._on_pairs(*ranking.sample(docs.where("doc_id in (%s)" % ",".join(map(str, np.flatnonzero(taught)))), labels), model.steps)[0]
    assert loss(found) < 1.01 * loss(least) and loss(found) < 0.8 * loss(begun)
    # Places of rows do not matter.
    again = ranking.fit(docs.repartition(5), labels.repartition(3))
    assert again.cut == model.cut and all((a == b).all() for a, b in zip(again.heights, model.heights, strict=True))


def test_fit_without_a_class_or_text(spark, make):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    for rows in ([], [(1, "a b"), (2, "c")], [(1, "a"), (3, None)]):
        assert ranking.fit(make(rows), labels).cut == pytest.approx(np.log(0.3 / 0.7))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % ranking.FOLDS]
    same = spark.createDataFrame([(ids[0], 1), (ids[1], 0)], "doc_id long, quality int")
    model = ranking.fit(make([(ids[0], "same"), (ids[1], "same")]), same)  # nothing tells them apart
    assert ranking.predict(make([(1, "same"), (2, "")]), model).where("score between 0 and 1").count() == 2
