"""How many rows the pipeline's stages send to Python together."""

from __future__ import annotations

import corpus_pipeline
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rows import documents


@pytest.fixture()
def unset(spark):
    before = spark.conf.get(corpus_pipeline.BATCH, None)
    spark.conf.unset(corpus_pipeline.BATCH)
    yield
    spark.conf.unset(corpus_pipeline.BATCH)
    if before is not None:
        spark.conf.set(corpus_pipeline.BATCH, before)


@pytest.mark.parametrize("stage", [f for name, f in corpus_pipeline.STAGES if name != "quality classifier"])
def test_long_texts_go_in_short_batches(spark, unset, stage):
    stage(spark, documents(spark, (1, "one two three"), (2, "four five six")), "")
    texts = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("word "), 2_000).alias("text"))

    @F.pandas_udf("long")
    def together(some: pd.Series) -> pd.Series:
        return pd.Series([some.str.len().sum()] * len(some))

    most = texts.select(together("text").alias("n")).agg(F.max("n")).first()[0]
    assert most < 2 * corpus_pipeline.BATCH_BYTES


def test_a_limit_of_the_session_is_kept(spark, unset):
    spark.conf.set(corpus_pipeline.BATCH, "1m")
    corpus_pipeline.packed(spark, documents(spark, (1, "one")), "")
    assert spark.conf.get(corpus_pipeline.BATCH) == "1m"
