from __future__ import annotations

from collections import Counter

import corpus_pipeline
import public_tokenizers
import tiktoken
from test_forest import plain

from orderloom.llm import bpe, language, mixing, toxicity

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_every_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "minhash_near_dedup", "mixing", "byte_bpe",
    ]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SMALL).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(df.columns == columns for df in kept[:-1])
    given, clean, told, single, mixed, tokens = map(rows, kept)

    model = toxicity.train(*toxicity.sample(docs, spark.read.parquet(f"{SMALL}/labels.parquet")))
    scores = toxicity.Scorer(model)([r[1] for r in given])
    assert Counter(clean) == Counter(r for r, s in zip(given, scores, strict=True) if s < 0.7)

    judge = language.Compressors(language.fit(kept[1]))
    assert Counter(told) == Counter(r for r in clean if not judge.judge(r[1])[2])

    components = Counter(c for _, c in plain([(r[0], r[1]) for r in told], 5, 80))
    assert len(single) == len(components) and {r[0] for r in single} == set(components)

    words = {r[0]: len((r[1] or "").split()) for r in single}
    taken = {r.doc_id: r.taken for r in mixing.mix_documents(kept[3]).collect()}
    times = Counter(r[0] for r in mixed)
    assert all(times[i] * words[i] == taken[i] for i in words)

    exact = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={}
    )
    text = {r[0]: r[1] for r in mixed}
    assert len(tokens) == len(mixed)
    for row in kept[5].collect():
        assert row.ids == exact.encode_ordinary(text[row.doc_id]) and row.n_tokens == len(row.ids) and row.decoded


def test_run(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded"]
    assert found.where("not decoded").count() == 0


CLASHING = ("_id", "_h1", "_h2", "_times", "_time", "_data", "component_id", "first", "score", "region", "c", "n")


def test_columns_of_the_caller_survive_every_stage(spark, make):
    """Names that the operators use themselves, nulls, empty texts and repeated rows."""
    text = "one two three four five six seven eight nine ten {} eleven twelve thirteen"
    given = [(i, text.format(i % 4) if i % 5 else None, "en", f"s{i % 3}") for i in range(40)]
    given += [(50, "", None, None), (None, text.format("x"), None, None)] + [given[1]] * 3
    docs = make(given).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.selectExpr("*", *(f"concat(coalesce(cast(doc_id as string), '-'), '/{name}') as `{name}`" for name in CLASHING))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        got, all_of = Counter(rows(out)), Counter(rows(docs))
        assert got and (set(got) <= set(all_of) if name == "mixing" else not got - all_of), name
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len(tokens) == len(given) and all(r.decoded for r in tokens if r.n_tokens)


def test_empty_and_null_documents_pass_every_stage(spark, make):
    for given in ([], [(None, None), (1, None), (1, None), (2, "")]):
        docs = make(given).select("doc_id", "text", "lang", "source", "n_chars")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
