"""The queries of the operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe, dialogue, forest, hmm, language, mixing, neighbours, oracles, quantised, ranking, sharding, toxicity, urls
from .common import documents, table

#: The vocabulary of the queries; the operators take any rank file and pattern.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The two tokenizers that are aligned.
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search_embeddings(spark, sf_dir)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.dedup_embeddings(spark, sf_dir)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(spark, sf_dir)


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(spark, sf_dir)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(spark, sf_dir)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_pages(spark, sf_dir)


def op10_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.dedup_documents(spark, sf_dir)


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_conversations(table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_documents(documents(spark, sf_dir), JSON, MODEL)


def op13_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.score_documents(spark, sf_dir)


QUERIES = (op1_neighbours, op2_mixing, op3_sharding, op4_embedding_dedup, op5_byte_bpe, op6_toxicity, op7_hidden_markov, op8_language_id, op9_url_filters, op10_minhash_forest, op11_dialogue_repair, op12_token_alignment, op13_quality_ranking)


def queries():
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
