from __future__ import annotations

import random

import numpy as np

from orderloom.llm import forest

SMALL = "/root/testdata/sf0.01"


def plain(rows, n, least):
    """Sizes and components by comparing every two sets that share a shingle."""
    sets = []
    for _, t in rows:
        words = (t or "").encode().lower().split()
        sets.append({b" ".join(words[j : j + n]) for j in range(max(1, len(words) - n + 1))} if words else set())
    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            top[k] = k = top[top[k]]
        return k

    for k, s in enumerate(sets):
        near = {}
        for g in s:
            for m in holders[g]:
                if m < k:
                    near[m] = near.get(m, 0) + 1
        for m, both in near.items():
            if 100 * both >= least * (len(s) + len(sets[m]) - both):
                top[find(k)] = find(m)
    least_id = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least_id[r] = min([x for x in (least_id.get(r), i) if x is not None], default=None)
    return [(len(s), least_id[find(k)]) for k, s in enumerate(sets)]


def by_key(rows):
    return sorted((str(i), n, str(c)) for i, n, c in rows)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    want = by_key((i, n, c) for (i, _), (n, c) in zip(rows, plain(rows, 4, 80), strict=True))
    found = forest.dedup_documents(spark, SMALL).collect()
    assert by_key((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def crowd(rng, near=150):
    words = [f"w{i}" for i in range(5000)]
    base = rng.choices(words, k=120)
    rows = []
    for _ in range(near):  # near copies with one or two words changed, and passages in common
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(120)] = rng.choice(words)
        rows.append(" ".join(copy))
    for _ in range(60):
        rows.append(" ".join(base[:60] + rng.choices(words, k=80)))
    rows += [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(200)]
    return rows + [r.upper() for r in rows[:20]]


def test_crowded_regions_and_edges(spark, make, monkeypatch):
    monkeypatch.setattr(forest, "REGION", 16)
    rng = random.Random(4)
    texts = crowd(rng)
    rows = list(zip(rng.sample(range(10_000), len(texts)), texts, strict=True))
    rows += [(20_000 + i, rows[3][1]) for i in range(100)] + [rows[5]] * 3
    rows += [(30_000, None), (30_001, ""), (30_002, " \t\n"), (30_002, " \t\n"), (30_003, "one two"), (30_004, "ONE\ttwo"), (30_005, "one")]
    rows += [(None, "a b c d e f g"), (7, "a b c d e f g"), (None, "null has no twin"), (30_006, "long word " * 40_000)]
    docs = make(rows)
    for n in (4, 5):
        want = plain(rows, n, 80)
        found = forest.dedup(docs, n=n).collect()
        assert by_key((r.id, r.n_shingles, r.component_id) for r in found) == by_key((i, k, c) for (i, _), (k, c) in zip(rows, want, strict=True))
    kept = forest.keep(docs, n=5)
    assert kept.columns == docs.columns
    components = {c if k else ("alone", j) for j, ((i, _), (k, c)) in enumerate(zip(rows, want, strict=True))}
    assert kept.count() == len(components)
    assert forest.dedup(make([])).count() == 0 and forest.keep(make([(1, None)])).count() == 1


def test_crowd_on_one_template_is_met_whole(spark, make):
    """Twins just above the threshold among 800 texts of one template just below it: more than a
    thousand pairs lie in regions large at full depth, and nothing but the template is shared."""
    rng = random.Random(11)
    template = [f"w{i}" for i in range(80)]
    texts = []
    for k in range(400):
        common = rng.sample(template, 72)
        texts += [" ".join(common + [f"u{k}x{side}x{j}" for j in range(8)]) for side in (0, 1)]
    ids = rng.sample(range(10_000), len(texts))
    at = {w: i for i, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    holds = np.zeros((len(texts), len(at)), np.float32)
    for row, text in zip(holds, texts, strict=True):
        row[[at[w] for w in text.split()]] = 1
    both = holds @ holds.T
    near = 100 * both >= 80 * (160 - both)
    least = np.array(ids)
    while (now := np.where(near, least, 10_000).min(axis=1)).tolist() != least.tolist():
        least = now
    assert 350 <= len(set(least.tolist())) <= 400
    found = {r.id: r.component_id for r in forest.dedup(make(list(zip(ids, texts, strict=True))), n=1).collect()}
    assert found == dict(zip(ids, least.tolist(), strict=True))
