from __future__ import annotations

import zlib
from collections import Counter

import pytest

from orderloom.llm import sharding


def test_law(spark, make):
    rows = [(i, f"text {i}") for i in range(3000)] + [(None, None), (7, "text 7"), (7, "text 7"), (8, ""), (9, "ä" * 40_000)]
    found = sharding.shard_documents(make(rows)).toPandas()
    assert len(found) == len(rows)
    texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r["size"], r.text_crc32) for _, r in found.iterrows())
    assert got == texts
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
        assert 270 < len(part) < 480
    moved = found[found.grown_shard != found.shard]
    assert set(moved.grown_shard) == {8} and 200 < len(moved) < 480
    assert found.groupby(found.doc_id.fillna(-1)).shard.nunique().max() == 1


def test_hot_row(spark, monkeypatch, make):
    monkeypatch.setattr(sharding, "RUN", 10)
    found = sharding.shard_documents(make([(1, "same")] * 105 + [(2, "other")])).toPandas()
    assert len(found) == 106
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_weights_and_empty(spark, make):
    keys = spark.range(20_000)
    n = sharding.assign(keys, "id", {3: 1.0, 5: 3.0}).groupBy("shard").count().toPandas().set_index("shard")["count"]
    assert set(n.index) == {3, 5} and 0.7 < n[5] / 20_000 < 0.8
    assert sharding.shard_documents(make([])).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous("id", [1.0, 0.0])


def test_no_python(spark, make):
    plan = sharding.shard_documents(make([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
