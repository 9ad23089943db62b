from __future__ import annotations

import pytest

from orderloom.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2)):
    """Water level by bisection instead of rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 2.0 * sum(sizes.values()) + 1
    for _ in range(200):
        unit = (low + high) / 2
        if sum(min(2 * sizes[s], unit * weight[s]) for s in names) < 1.5 * sum(sizes.values()):
            low = unit
        else:
            high = unit
    return {s: min(2 * sizes[s], high * weight[s]) for s in names}


def test_targets(rng):
    for _ in range(50):
        sizes = {s: rng.choice([0, 1, 10, 1000, 50_000]) for s in ["b", "a", None, "Z", "é"][: rng.randint(1, 5)]}
        got, want = mixing.targets(sizes), plain_targets(sizes)
        assert got == pytest.approx(want, abs=1e-3)


def test_flow_is_cheapest():
    # What both sources hold must serve the one that has nothing of its own.
    sent = mixing.route({("a",): 100, ("a", "b"): 100}, {"a": 100.0, "b": 100.0})
    assert sent == {("a",): 100.0, ("a", "b"): 100.0}
    sent = mixing.route({("a",): 100, ("a", "b"): 50}, {"a": 120.0, "b": 100.0})
    assert sent == {("a",): 120.0, ("a", "b"): 100.0}


def test_mix(spark, make, rng):
    rows = [(i, " ".join("w" * rng.randint(1, 60)), "en", rng.choice(["a", "b", "c", None])) for i in range(3000)]
    rows += [(9000, None, "en", "a"), (9001, " \t\n", "en", None), (9002, "x " * 30_000, "en", "b"), (None, "y y", "en", "c")]
    rows += [rows[0]] * 3
    docs = make(rows)
    found = mixing.mix_documents(docs).toPandas()
    assert len(found) == len(rows)
    words = {i: len((t or "").split()) for i, t, _, _ in rows}
    assert all(r["size"] == words[None if r.doc_id != r.doc_id else int(r.doc_id)] for _, r in found.iterrows())
    assert (found.taken <= 2 * found["size"]).all()
    for _, part in found.groupby(found.source.fillna("none")):
        assert part.taken.sum() == pytest.approx(part.target.iloc[0], rel=0.01, abs=60)
        assert (part.source_size == part["size"].sum()).all()
    again = mixing.mix_documents(docs.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert found[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))
    repeated = mixing.repeat(docs)
    assert repeated.columns == docs.columns
    total = sum(len((r.text or "").split()) for r in repeated.collect())
    assert total == found.taken.sum()


def test_edges(spark, make):
    assert mixing.mix_documents(make([])).count() == 0
    assert mixing.mix_documents(make([(1, None), (2, "")])).toPandas().taken.tolist() == [0, 0]
    with_sources = spark.createDataFrame([(1, ["a", "b"], 5), (2, ["b"], 5), (3, None, 5)], "id int, s array<string>, n int")
    found = mixing.mix(with_sources, "s", "n", ["id"]).toPandas()
    assert len(found) == 3 and (found.copies <= 2).all()
