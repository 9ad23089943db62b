"""Documents made into tokens of a training mix: five stages, each over all that the one before kept.

Toxic documents go, then those whose language is not told; of near-duplicates one stays; sources are
mixed to their target weights, documents repeated as the mix asks; and what is left is tokenized.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import bpe, forest, language, mixing, toxicity
from orderloom.llm.common import documents, table, write_once

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on a bounded sample of all labels; a document scored 0.7 or more goes."""
    model = toxicity.train(*toxicity.sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep(docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on a bounded sample of the documents with a language; rejected documents go: those
    without a letter and longer ones that two languages explain equally well."""
    return language.keep(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more; one document of each component stays."""
    return forest.keep(docs, n=5, least=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 in turn share 150% of all words; documents come up to twice."""
    return mixing.repeat(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids of the whole text, their number, and whether decoding them
    gives the text again."""
    rows = docs.select("doc_id", "lang", "source", "text")
    encoded = bpe.encode(rows, RANKS, public_tokenizers.PATTERN, check="decoded")
    return encoded.selectExpr(
        "doc_id", "lang", "source", "ids", "cast(size(ids) as bigint) as n_tokens", "decoded"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Fitted models, hashes and merges are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
