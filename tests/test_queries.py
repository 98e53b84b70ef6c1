"""Every registered query against its SQL, as multisets of exact values."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from pyspark.sql import functions as F
from wardline import vocab
from wardline.vocab import URINE_PATHS
from workbench.adapters import sources
from workbench.check import connect, rows_of_spark, rows_of_sql
from workbench.oracle import ORACLE
from workbench.queries import QUERIES

ROOT = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")

SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    sf_dir = f"{ROOT}/sf0.01"
    con = connect(sf_dir)
    df = QUERIES[name](spark, sf_dir)
    columns, got = rows_of_spark(df)
    sql_columns, wanted = rows_of_sql(con, ORACLE[name])
    assert columns == sql_columns
    assert got.total() > 0
    assert got == wanted
    relation = con.sql(ORACLE[name])
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == sql_types


def test_branches_are_reached(spark):
    """The comparison above is worth something only if the test data reach the rules."""
    sf_dir = f"{ROOT}/sf0.01"
    con = connect(sf_dir)

    def distinct(name: str, column: str) -> set:
        sql = f"SELECT DISTINCT {column} FROM ({ORACLE[name]})"
        return {r[0] for r in con.execute(sql).fetchall()}

    assert len(distinct("q1_mcs_events", "mechanical_support_type")) == 9
    assert len(distinct("q2_dialysis_events", "dialysis_type")) == 24
    assert None in distinct("q2_dialysis_events", "dialysis_type")
    assert distinct("q7_kdigo_stages", "aki_stage_creat") == {None, 0, 1, 2, 3}
    assert distinct("q7_kdigo_stages", "aki_stage_uo") == {None, 0, 1, 2, 3}
    per_stage = f"SELECT aki_stage_uo, COUNT(*) FROM ({ORACLE['q7_kdigo_stages']}) GROUP BY 1"
    assert min(n for _, n in con.execute(per_stage).fetchall()) >= 5
    cells = sources(spark, sf_dir, "intakeoutput")["intakeoutput"]
    assert cells.filter(F.col("cellpath").isin(list(URINE_PATHS))).select("cellpath").distinct().count() == 86
    digits = cells.filter(F.round("cellvaluenumeric", 4) != F.col("cellvaluenumeric"))
    assert digits.count() > 1_000
    assert distinct("text_rules", "included") == {0, 1}
    assert distinct("creatinine_decimal", "stage") == {None, 0, 1, 2, 3}
    rates = f"SELECT COUNT(uo_rt_6hr), COUNT(uo_rt_12hr), COUNT(uo_rt_24hr) FROM ({ORACLE['q6_kdigo_uo']})"
    assert all(n > 100 for n in con.execute(rates).fetchone())
    repeated = f"SELECT COUNT(*) FROM (SELECT 1 FROM ({ORACLE['q7_kdigo_stages']}) GROUP BY patientunitstayid, chartoffset HAVING COUNT(*) > 1)"
    assert con.execute(repeated).fetchone()[0] > 0


def test_vocabulary_has_its_size():
    """The SQL takes its strings from the same lists, so their sizes and some entries are stated here too."""
    sizes = (len(URINE_PATHS), len(set(URINE_PATHS)), len(vocab.DIALYSIS_TREATMENT), len(vocab.MCS_TREATMENT), len(vocab.MCS_DIAGNOSIS))
    assert sizes == (86, 86, 31, 7, 4)
    assert "flowsheet|Flowsheet Cell Labels|I&O|Output (ml)|Urine" in URINE_PATHS
    assert all(x.startswith(vocab.OUTPUT_PREFIX) for x in URINE_PATHS)
    assert {label for _, label in vocab.DIALYSIS_TREATMENT} >= {"CVVH", "SLED"}


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == [
        "uniquepid",
        "patienthealthsystemstayid",
        "patientunitstayid",
        "chartoffset",
        "creat_low_past_7day",
        "creat_low_past_48hr",
        "creat",
        "aki_stage_creat",
        "uo_rt_6hr",
        "uo_rt_12hr",
        "uo_rt_24hr",
        "aki_stage_uo",
        "aki_stage_dialysis",
        "aki_stage",
        "aki_stage_smoothed",
    ]
    assert df.count() > 0
