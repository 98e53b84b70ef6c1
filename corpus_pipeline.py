"""A training-data pipeline over `documents`: two filters, two deduplications, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import exact_dedup, jaccard_join, language, packing, quality
from wardline.llm.shared import BATCH, BATCH_BYTES, store

#: Least share of the best language, and least probability of good quality, of a document that stays.
LANGUAGE, QUALITY = 0.5, 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def short_batches(stage: Stage) -> Stage:
    """The stage, in a session whose rows go to Python in batches of BATCH_BYTES, unless it has a limit of its own.

    What a stage returns is worked out later, so the limit stays set.
    """

    @wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return limited


@short_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter, or with words of several, go."""
    predict = language.predictor(language.learn(docs), spark)
    judged = docs.withColumn("_language", predict(F.col("text")))
    known = (F.col("_language.lang_pred") != language.UNDETERMINED) & (F.col("_language.score") >= LANGUAGE)
    return judged.where(known).select(*docs.columns)


@short_batches
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality, as `labels` mark it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = quality.predictor(quality.learn(docs, labels), spark)
    return docs.withColumn("_quality", score(F.col("text"))).where(F.col("_quality") >= QUALITY).select(*docs.columns)


@short_batches
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


@short_batches
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by shared shingles, the one with the smallest id stays."""
    return jaccard_join.keep_one(docs)


@short_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the remaining documents goes."""
    return packing.pack(docs, special=True)


STAGES = [
    ("language id", language_id),
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("n-gram jaccard join", near),
    ("packing", packed),
]

#: No SQL: learning and the tokenizer cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each stored and read again, from all of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
