"""The operators over the whole test tables, in the columns their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import (
    collocations,
    embedding_dedup,
    exact_dedup,
    jaccard_join,
    language,
    lattice_lm,
    lexical_index,
    packing,
    quality,
    quality_rules,
    sharding,
    toxicity,
    unigram,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents")).drop("class_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), special=True)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.digests(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_index.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(table(spark, sf_dir, "documents")).drop("word_distance", "class_distance")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice_lm": op1_lattice_lm,
    "op2_language": op2_language,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_sharding": op4_sharding,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_packing": op6_packing,
    "op7_pieces": op7_pieces,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_ranked_search": op12_ranked_search,
    "op13_quality_rules": op13_quality_rules,
}
