"""Source rows that do not survive their declared types: kept apart, named and counted, for every source."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.__main__ import run
from wardline.schemas import SOURCES
from wardline.sources.tables import REJECTED, conform, sift, sift_sources, write_table

BAD = {"bigint": "ten", "double": "1,5"}
GOOD = {"bigint": "10", "double": "1.5", "string": "x"}


def as_text(spark, name, *faults):
    """A source with all columns as text: one good row, then one for each group of columns that is at fault."""
    schema = SOURCES[name]
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    rows = [tuple((BAD if c in of else GOOD)[k] for c, k in kinds.items()) for of in ((), *faults)]
    return spark.createDataFrame([*rows, (None,) * len(kinds)], T.StructType([T.StructField(c, T.StringType()) for c in kinds]))


@pytest.mark.parametrize("name", SOURCES)
def test_rejects_of_every_source(spark, name):
    typed = [f.name for f in SOURCES[name] if f.dataType.simpleString() in BAD]
    faults = [*((c,) for c in typed), tuple(typed)]
    df = as_text(spark, name, *faults).withColumn("extra", F.lit(1))
    sifted = sift(df, name)
    assert sifted.accepted.schema.fieldNames() == SOURCES[name].fieldNames()
    assert [f.dataType for f in sifted.accepted.schema] == [f.dataType for f in SOURCES[name]]
    rows = sifted.accepted.collect()
    assert sorted(r[0] is None for r in rows) == [False, True]
    rejected = [tuple(r[REJECTED]) for r in sifted.rejected.collect()]
    assert sorted(rejected) == sorted(faults if len(typed) > 1 else [*faults])
    counted = sifted.counts.get
    assert counted["rows"] == len(faults) + 2 and counted["rejected"] == len(faults)
    assert {c: counted[c] for c in SOURCES[name].fieldNames()} == {
        c: 2 if c in typed else 0 for c in SOURCES[name].fieldNames()
    }
    with pytest.raises(Exception, match="cannot be read as"):
        conform(df, name).collect()


def test_offsets_with_fractions_and_beyond_the_range_are_rejected(spark):
    df = spark.createDataFrame([(1.0, 2.5), (2.0, 1e30), (3.0, 4.0)], "patientunitstayid double, treatmentoffset double")
    sifted = sift(df.withColumn("treatmentstring", F.lit("a")), "treatment")
    assert [r["patientunitstayid"] for r in sifted.accepted.collect()] == [3]
    assert sorted(r["treatmentoffset"] for r in sifted.rejected.collect()) == ["1.0E30", "2.5"]
    assert sifted.counts.get["treatmentoffset"] == 2


def test_sources_that_are_as_declared_lose_nothing(spark, frame):
    df = frame("lab", dict(patientunitstayid=1, labname="creatinine", labresult=1.0, labresultoffset=3), dict())
    sifted = sift(df, "lab")
    assert sorted(sifted.accepted.collect(), key=str) == sorted(df.collect(), key=str)
    assert sifted.rejected.isEmpty()


def test_an_optional_column_may_be_missing(spark, frame):
    df = frame("patient", dict(patientunitstayid=1)).drop("unitadmitoffset")
    assert sift(df, "patient").accepted.first()["unitadmitoffset"] is None


def test_rejects_are_written(spark, tmp_path):
    write_table(as_text(spark, "lab", ("labresult",), ("labresultoffset", "labresult")), f"{tmp_path}/lab.parquet")
    tables = sift_sources(spark, str(tmp_path), f"{tmp_path}/bad", ["lab"])
    assert tables["lab"].count() == 2
    bad = spark.read.parquet(f"{tmp_path}/bad/lab.parquet").collect()
    assert sorted(len(r[REJECTED]) for r in bad) == [1, 2]


def test_a_job_goes_on_without_the_rejected_rows(spark, frame, tmp_path):
    write_table(frame("patient", dict(patientunitstayid=1)), f"{tmp_path}/in/patient.parquet")
    labs = spark.createDataFrame(
        [("1", "creatinine", "1.5", "0"), ("1", "creatinine", "high", "60"), ("1", "creatinine", "2.5", "120")],
        "patientunitstayid string, labname string, labresult string, labresultoffset string",
    )
    write_table(labs, f"{tmp_path}/in/lab.parquet")
    run(
        spark,
        f"{tmp_path}/in",
        f"{tmp_path}/out",
        "kdigo_creatinine",
        rejects_root=f"{tmp_path}/bad",
        store_root=f"{tmp_path}/kept",
        repeats="rows",
    )
    rows = spark.read.parquet(f"{tmp_path}/out/kdigo_creatinine.parquet").collect()
    assert sorted((r["labresultoffset"], r["creat"], r["creat_low_past_48hr"]) for r in rows) == [(0, 1.5, None), (120, 2.5, 1.5)]
    assert spark.read.parquet(f"{tmp_path}/bad/lab.parquet").first()["labresult"] == "high"
