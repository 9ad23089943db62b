from __future__ import annotations

from orderloom.llm import language

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "n_chars")
    found = language.identify_documents(spark, SMALL).join(docs, "doc_id").toPandas()
    assert len(found) == docs.count()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()
    assert found.rejected.mean() < 0.02


def test_edges(spark, make):
    rows = [(i, "the cat and the dog are here with us", "en") for i in range(30)]
    rows += [(100 + i, "der hund und die katze sind hier bei uns", "de") for i in range(20)]
    rows += [(200, "un perro", None), (201, None, "es"), (202, "", "es")]
    docs = make(rows)
    contents = language.fit(docs)
    assert list(contents)[:2] == ["en", "de"]
    asked = make([(1, None), (2, ""), (3, "123 !!"), (4, "the dog and us"), (5, "die katze und der hund"), (6, "ab " * 300_000), (6, "the dog and us")])
    found = {(r.doc_id, r.lang_pred) for r in language.predict(asked, contents).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (6, "en")} <= found and len(found) == 7 or len(found) == 6
    kept = language.keep(asked, contents)
    assert kept.columns == asked.columns and {4, 5} <= {r.doc_id for r in kept.collect()}
    assert not {1, 2, 3} & {r.doc_id for r in kept.collect()}
    empty = language.fit(make([]))
    assert empty == {}
    assert {r.lang_pred for r in language.predict(asked, empty).collect()} == {"und"}
    assert language.predict(make([]), contents).count() == 0


def test_sizes_decide():
    judge = language.Compressors({"x": b"abcdefgh ijklmnop", "y": b"qrstuvwx yzyzyzab"})
    assert judge.judge("abcdefgh ijklmnop abcdefgh")[0] == "x"
    assert judge.judge("qrstuvwx yzyzyzab")[0] == "y"
    lang, score, _ = judge.judge("é")
    assert lang == "x" and score <= 1


def test_copies_take_one_place(spark, make):
    """Whatever their hashes, groups of 70 copies leave every text of a language in its dictionary."""
    rows = [(i, f"text {i % 6} of a rare language", "xx") for i in range(420)]
    assert sorted(language.fit(make(rows))["xx"].decode().split("\n")) == sorted(f"text {i} of a rare language" for i in range(6))
