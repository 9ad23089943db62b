from __future__ import annotations

import math

import numpy as np
import pytest

from orderloom.llm import neighbours, quantised

SCHEMA = "vec_id long, embedding array<float>, label int, score double, row long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, 0.0, 1) for i, v, label in rows], SCHEMA)


def odd(size):
    """Rows that take no part."""
    return [None, [], [0.0] * size, [None, *[1.0] * (size - 1)], [math.nan] * size, [math.inf] * size, [1.0]]


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_search_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 32)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5000 + 50 * i, v, 0) for i, v in enumerate(odd(32))]
    found = neighbours.search(table(spark, rows), "vec_id % 50 = 0", probes=12).toPandas()
    u = unit(x.astype(float))
    asked = np.arange(0, 3000, 50)
    assert sorted(set(found.query_id)) == asked.tolist() and (found.groupby("query_id").size() == 5).all()
    score = u[asked] @ u.T
    score[np.arange(len(asked)), asked] = -2
    best = np.argsort(-score, axis=1)[:, :5]
    got = found.groupby("query_id").vec_id.apply(set)
    assert np.mean([len(got[q] & set(b)) / 5 for q, b in zip(asked, best, strict=True)]) >= 0.9
    for _, r in found.iterrows():
        assert r.score == pytest.approx(u[int(r.query_id)] @ u[int(r.vec_id)], abs=1e-12)
    assert all(part.score.is_monotonic_decreasing and part["rank"].tolist() == [1, 2, 3, 4, 5] for _, part in found.groupby("query_id"))


def test_search_ties_and_small(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    same = [(i, [1.0, 2.0, 0.0], 0) for i in range(100)]
    found = neighbours.search(table(spark, [*same, (50, [1.0, 2.0, 0.0], 0)]), "vec_id % 50 = 0").toPandas()
    # The copy with the query's own key is another row, and equal scores go by key.
    for q, rest in ((0, [1, 2, 3, 4, 5]), (50, [0, 1, 2, 3, 4])):
        part = found[found.query_id == q].sort_values(["rank"])
        assert set(part.vec_id) == set(rest) and np.allclose(part.score, 1)
    few = neighbours.search(table(spark, [(0, [1.0, 0.0], 0), (1, [-1.0, 0.1], 0), (2, [0.0, -3.0], 0)]), "vec_id = 0")
    assert [(r.query_id, r["rank"], r.vec_id) for r in few.collect()] == [(0, 1, 2), (0, 2, 1)]
    assert neighbours.search(table(spark, []), "vec_id % 50 = 0").count() == 0
    assert neighbours.search(table(spark, [(0, v, 0) for v in odd(3)]), "true").count() <= 1


def plain_links(rows, least):
    good = [(k, i, np.array(v, float), label) for k, (i, v, label) in enumerate(rows) if label is not None and v is not None and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(rows))}
    for a, (k, _, x, la) in enumerate(good):
        for m, _, y, lb in good[a + 1 :]:
            if la == lb and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[k].add(m)
                links[m].add(k)
    return links


def test_dedup_equals_pairs(spark, monkeypatch):
    monkeypatch.setattr(quantised, "BLOCK", 8)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 16))
    x = np.vstack([base, *(base[:20] + rng.standard_normal((20, 16)) * s for s in (0.1, 0.3, 0.45)), base[:1] + 0.05 * rng.standard_normal((40, 16))])
    rows = [(1000 - i, v.tolist(), i % 2) for i, v in enumerate(x.astype(np.float32))]
    rows += [(2000 + i, rows[0][1], 0) for i in range(30)] + [(3000 + i, v, 0) for i, v in enumerate(odd(16))]
    rows += [(4000, rows[0][1], None), rows[5], (None, rows[0][1], 0)]
    links = plain_links(rows, 0.93)
    found = quantised.dedup(table(spark, rows)).toPandas()
    assert len(found) == len(rows)
    reach = {}
    for k in links:
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        reach[k] = min(ids, default=None)
    want = sorted((rows[k][0] if rows[k][0] is not None else -1, len(links[k]), reach[k]) for k in links)
    got = sorted((int(r.vec_id) if r.vec_id == r.vec_id else -1, int(r.n_links), int(r.component_id)) for _, r in found.iterrows())
    assert got == want
    assert (found.kept == (found.vec_id == found.component_id)).all()
    assert quantised.dedup(table(spark, [])).count() == 0
