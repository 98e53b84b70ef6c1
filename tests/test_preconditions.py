"""Numbers keep their digits, and broken preconditions are errors."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import wardline as wl
from wardline import vocab
from wardline.functions.columns import exact_sum, text_rule
from wardline.operators.intervals import interval_lookup
from wardline.operators.series import observed_gap
from wardline.operators.staging import align_series
from wardline.plans.stages import creatinine_stage
from wardline.schemas import STAY


def labs(frame, *values: tuple):
    return frame("lab", *(dict(patientunitstayid=1, labname="creatinine", labresultoffset=t, labresult=v) for t, v in values))


def patient(frame, *stays: int):
    return frame("patient", *(dict(patientunitstayid=s, patienthealthsystemstayid=9) for s in stays))


def volumes(frame, *values: tuple):
    cell = dict(patientunitstayid=1, cellpath=vocab.URINE_PATHS[0])
    return frame("intakeoutput", *(dict(cell, intakeoutputoffset=t, cellvaluenumeric=v) for t, v in values))


def test_labs_and_volumes_keep_their_digits(frame):
    rows = wl.kdigo_creatinine(patient(frame, 1), labs(frame, (0, 0.012349))).collect()
    assert [r["creat"] for r in rows] == [0.012349]
    rows = wl.urine_output(volumes(frame, (0, 0.00004), (0, 0.00004), (5, 1e15), (5, 5.0))).collect()
    assert {r["chartoffset"]: r["urineoutput"] for r in rows} == {0: 0.00008, 5: 1e15 + 5}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e20])
def test_numbers_that_are_no_decimals_are_errors(spark, frame, ansi, value):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="no decimal with 18 places"):
            wl.urine_output(volumes(frame, (0, 5.0), (0, value))).collect()
        many = spark.range(3).select(exact_sum(F.lit(9e19)).alias("s"))
        with pytest.raises(Exception, match="(?i)overflow|out.of"):
            many.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_decimal_labs_are_compared_exactly(spark, frame):
    stage = creatinine_stage(F.col("creat"), F.col("creat_low_past_7day"), F.col("creat_low_past_48hr"))

    def stages(lab):
        rows = wl.kdigo_creatinine(patient(frame, 1), lab).withColumn("stage", stage)
        return {r["labresultoffset"]: r["stage"] for r in rows.collect()}

    doubles = labs(frame, (0, 1.1), (60, 1.4))
    decimals = doubles.withColumn("labresult", F.col("labresult").cast("decimal(6,2)"))
    assert stages(doubles) == {0: None, 60: 0}
    assert stages(decimals) == {0: None, 60: 1}
    kept = wl.kdigo_creatinine(patient(frame, 1), decimals).filter("labresultoffset = 60").first()
    assert (kept["creat"], kept["creat_low_past_48hr"]) == (Decimal("1.4"), Decimal("1.1"))


def test_a_path_of_null_is_not_under_a_rule(spark):
    rule = text_rule("p", prefix="a", exactly=["ab"], starts="ac", without=["x"], like=["ad%"])
    rows = spark.createDataFrame([("ab",), (None,), ("zz",)], "p string").select(rule.alias("r")).collect()
    assert [r["r"] for r in rows] == [True, False, False]


def test_series_with_two_rows_at_one_key(spark):
    twice = spark.createDataFrame([(1, 10, 4.0), (1, 10, 1.0)], "k long, t long, a double")
    other = spark.createDataFrame([(1, 10, 2.0), (1, 20, 3.0)], "k long, t long, b double")
    with pytest.raises(Exception, match="several rows at one key: k 1, t 10"):
        align_series(["k", "t"], [twice, other]).collect()
    aligned = align_series(["k", "t"], [twice.limit(1), other]).collect()
    assert sorted((r["t"], r["b"]) for r in aligned) == [(10, 2.0), (20, 3.0)]


def test_stages_of_a_series_with_two_rows_at_one_offset(frame):
    creatinine = frame(
        "kdigo_creatinine",
        dict(patientunitstayid=1, labresultoffset=10, creat=4.0, creat_low_past_7day=1.0),
        dict(patientunitstayid=1, labresultoffset=10, creat=1.0, creat_low_past_7day=2.0),
    )
    with pytest.raises(Exception, match="several rows at one key"):
        wl.kdigo_stages(patient(frame, 1), creatinine, frame("kdigo_uo"), frame("dialysis_events")).collect()


def test_gaps_of_rows_at_one_time(spark):
    rows = spark.createDataFrame([(1, t) for t in (0, 10, 10, 30)], "k long, t long")
    with pytest.raises(Exception, match="several rows at 10"):
        observed_gap(rows, "k", "t", name="gap", first=60).collect()


@pytest.mark.parametrize("others", [[(20, 40)], [(0, 100)], [(99, None)], [(0, None)]])
def test_overlapping_intervals(spark, frame, others):
    spans = [(0, 100), *others]
    points = spark.createDataFrame([(1, 50), (1, 600_000)], "k long, t long")
    intervals = spark.createDataFrame([(1, a, b, float(i)) for i, (a, b) in enumerate(spans)], "k long, a long, b long, w double")
    with pytest.raises(Exception, match="intervals overlap: k 1"):
        interval_lookup(points, intervals, "k", "t", start="a", end="b", values=["w"]).collect()
    weights = frame("weight_durations", *(dict(patientunitstayid=1, startoffset=a, endoffset=b, weight=80.0) for a, b in spans))
    urine = frame("urine_output", dict(patientunitstayid=1, chartoffset=50, urineoutput=10.0))
    with pytest.raises(Exception, match="weight intervals overlap"):
        wl.kdigo_uo(urine, patient(frame, 1), weights).collect()


def test_intervals_that_touch_do_not_overlap(spark):
    points = spark.createDataFrame([(1, 50), (1, 100), (1, 50_000)], "k long, t long")
    intervals = spark.createDataFrame([(1, 0, 100, 1.0), (1, 100, 100, 2.0), (1, 100, None, 3.0)], "k long, a long, b long, w double")
    rows = interval_lookup(points, intervals, "k", "t", start="a", end="b", values=["w"]).collect()
    assert sorted((r["t"], r["w"]) for r in rows) == [(50, 1.0), (100, 3.0), (50_000, 3.0)]


def test_stays_listed_twice(frame):
    twice = patient(frame, 1, 1, 2)
    urine = frame("urine_output", dict(patientunitstayid=1, chartoffset=0, urineoutput=10.0))
    creatinine = frame("kdigo_creatinine", dict(patientunitstayid=1, labresultoffset=10, creat=1.0))
    drug = frame("infusiondrug", dict(patientunitstayid=1, drugstartoffset=5, patientweight=70.0))
    for df in (
        wl.kdigo_creatinine(twice, labs(frame, (0, 1.0))),
        wl.kdigo_uo(urine, twice, frame("weight_durations")),
        wl.kdigo_stages(twice, creatinine, frame("kdigo_uo"), frame("dialysis_events")),
        wl.weight_durations(twice, drug, frame("physicalexam"), frame("intakeoutput")),
    ):
        with pytest.raises(Exception, match=f"more than once: {STAY} 1"):
            df.collect()
