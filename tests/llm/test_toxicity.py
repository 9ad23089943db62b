from __future__ import annotations

import itertools

import numpy as np

from orderloom.llm import toxicity

SMALL = "/root/testdata/sf0.1"


def plain_kernel(a, b):
    """Common subsequences of three characters with gaps, pair by pair."""

    def weights(word):
        word, out = f"^{word}$", {}
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN and j - i <= toxicity.SPAN - 2:
                key = word[i] + word[j] + word[k]
                out.setdefault(key, []).append(toxicity.DECAY ** (k - i + 1))
        return out

    x, y = weights(a), weights(b)
    least = sum(max(0, toxicity.SHORT + 2 - j) * w**2 for _, j, w in toxicity.GAPS)
    norm = lambda v: max(least, sum(w * w for ws in v.values() for w in ws)) ** 0.5
    return sum(sum(x[k]) * sum(y[k]) for k in x if k in y) / norm(x) / norm(y)


def test_kernel():
    marks = ["idiot", "clown", "abc"]
    found, owner = toxicity.Landmarks(marks).kernel(["idiot", "idixot", "clowns", "xyz", "ab"])
    assert owner.tolist() == [0, 1, 2, 3, 4]
    for word, row in zip(["idiot", "idixot", "clowns", "xyz", "ab"], found, strict=True):
        assert np.allclose(row, [plain_kernel(word, m) for m in marks], atol=1e-5)


def test_held_out(spark):
    found = toxicity.score_documents(spark, SMALL).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").toPandas()
    held = found[found.held_out]
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 0.01 * (held.toxic == 0).sum()
    assert (held.predicted == held.toxic).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_edges(spark, make):
    toxic = [f"word{i} you idiot and clown. fine day {i}" for i in range(40)]
    clean = [f"word{i} a fine day. we sing and dance {i}" for i in range(80)]
    model = toxicity.train(toxic, clean)
    value = lambda t: toxicity.Scorer(model)([t])[0]
    for text in ("idiot", "what an i-d.i*o,t", "i d i o t", "idixot", "idiiot", "x " * 50_000 + "idiot", "clowns"):
        assert value(text) >= 0.7, text
    for text in (None, "", "\n", "...", "a fine day", "dance " * 50_000, "7 8 9", "ñandú"):
        assert value(text) < 0.7, text
    asked = make([(1, None), (1, "idiot"), (2, ""), (3, "fine"), (3, "fine")])
    assert toxicity.predict(asked, model).count() == 5
    kept = toxicity.keep(asked, model)
    assert kept.columns == asked.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 3]
    assert toxicity.predict(make([]), model).count() == 0
    nothing = toxicity.train([], [])
    assert toxicity.Scorer(nothing)(["idiot"])[0] < 0.5


def test_sample_of_a_repeated_id(spark, make):
    """One id with more rows than the sample holds leaves the texts of larger ids in it."""
    docs = make([(1, "a fine day")]).crossJoin(spark.range(13_000).select("id")).selectExpr("doc_id", "concat(text, id) as text")
    docs = docs.union(make([(i, f"you idiot {i}") for i in range(2, 12)]).select("doc_id", "text"))
    labels = spark.createDataFrame([(1, 0), *((i, 1) for i in range(2, 12))], "doc_id long, toxic int")
    toxic, clean = toxicity.sample(docs, labels)
    assert sorted(toxic) == sorted(f"you idiot {i}" for i in range(2, 12)) and len(clean) == 1
