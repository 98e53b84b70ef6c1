"""Registered queries against their SQL, and the pipeline against its stages worked out one by one."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from rows import documents, hard
from wardline.llm.oracle import ORACLE
from wardline.llm.queries import QUERIES
from workbench.check import connect, rows_of_spark, rows_of_sql

ROOT = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, name):
    columns, got = rows_of_spark(QUERIES[name](spark, ROOT))
    sql_columns, wanted = rows_of_sql(connect(ROOT), ORACLE[name])
    assert columns == sql_columns
    assert got == wanted and got.total() > 0


def test_every_operator_is_registered():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, ROOT)
        assert after.columns == docs.columns
        assert after.join(kept, "doc_id", "left_anti").isEmpty()
        kept = spark.createDataFrame(after.collect(), docs.schema)
    good = spark.read.parquet(f"{ROOT}/labels.parquet").where("quality = 1")
    rows = kept.collect()
    assert len({r["text"].lower() for r in rows}) == len(rows) < docs.count()
    packed = corpus_pipeline.run(spark, ROOT).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rows}
    assert good.count()


@needs_tables
def test_stages_of_hard_rows(spark):
    """Stages keep extra columns, whatever their names, and stand any row."""
    stages = dict(corpus_pipeline.STAGES)
    known = [(i, f"the cat and the dog number {i} went out to see it", "en") for i in range(100, 130)]
    df = hard(spark).unionByName(documents(spark, *known))
    ids = lambda rows: {r["doc_id"] for r in rows.collect()}
    after = stages["language id"](spark, df, ROOT)
    assert after.columns == df.columns and ids(after) >= set(range(100, 130)) and not ids(after) & {1, 2, 3, 8}
    after = stages["quality classifier"](spark, df, ROOT)
    assert after.columns == df.columns
    empty = documents(spark)
    for name in list(stages)[:-1]:
        assert stages[name](spark, empty, ROOT).collect() == []
    assert stages["packing"](spark, empty, ROOT).collect() == []
