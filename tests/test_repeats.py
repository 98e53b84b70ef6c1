"""Overlapping intervals, tied rows, repeated keys and stays as rows, against plain loops over small tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import wardline as wl
from wardline.operators.intervals import interval_join, interval_lookup
from wardline.operators.series import observed_gap
from wardline.operators.staging import align_series, counted_series
from wardline.schemas import STAY


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def matches(points, spans):
    """Rows (key, time, extra, value), a row per match."""
    found = Counter()
    for k, t, x in points:
        held = [
            v
            for key, start, end, v in spans
            if None not in (k, t, start) and key == k and start <= t and (end is None or t < end)
        ]
        for v in held or [None]:
            found[k, t, x, v] += 1
    return found


def joined(spark, points, spans):
    left = spark.createDataFrame(points, "k long, t long, _block long")
    right = spark.createDataFrame(spans, "k long, a long, b long, w double")
    return interval_join(left, right, "k", "t", start="a", end="b", values=["w"])


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("reach", [300, 40_000, 3_000_000])
def test_interval_join(spark, seed, reach):
    draw = random.Random(seed)
    points = [(draw.randrange(3), draw.randrange(-reach, reach), i % 4) for i in range(150)]
    points += [(None, 5, 0), (1, None, 0), (7, 0, 0), points[0], points[0]]
    spans = []
    for i in range(60):
        start = draw.randrange(-2 * reach, reach)
        end = draw.choice([None, start, start - 5, start + 1, start + draw.randrange(100), start + draw.randrange(3 * reach)])
        spans.append((draw.randrange(3), start, end, float(i)))
    spans += [spans[3], (None, 0, 10, 1.0), (1, None, 10, 2.0), (9, 0, None, 3.0)]
    df = joined(spark, points, spans)
    assert df.columns == ["k", "t", "_block", "w"]
    assert counted(df, *df.columns) == matches(points, spans)


@pytest.mark.parametrize("edge", [0, 63, 64, 65, 4095, 4096, 262_143, 262_144])
def test_interval_join_at_the_edges_of_blocks(spark, edge):
    points = [(1, t + s * edge, 0) for s in (-1, 1) for t in (-2, -1, 0, 1, 2)]
    spans = [(1, a, b, 1.0) for a in (-edge, -edge + 1, edge - 1, edge) for b in (-edge, edge, edge + 1, None) if b is None or a < b]
    df = joined(spark, points, spans)
    assert counted(df, *df.columns) == matches(points, spans)


def test_interval_join_pairs_little_but_matches(spark):
    """A key with many points and many short intervals: the join makes a row per match and few more."""
    points = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    spans = spark.range(20_000).select(
        F.lit(1).alias("k"), F.col("id").alias("a"), (F.col("id") + 3).alias("b"), F.col("id").cast("double").alias("w")
    )
    df = interval_join(points, spans, "k", "t", start="a", end="b", values=["w"])
    assert df.count() == 3 * 20_000 - 3
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "Cartesian" not in plan


def test_interval_join_of_empty_tables(spark):
    assert counted(joined(spark, [], [(1, 0, None, 1.0)]), "k") == Counter()
    assert counted(joined(spark, [(1, 0, 3)], []), "k", "t", "_block", "w") == Counter([(1, 0, 3, None)])


def test_a_wrong_choice_is_named(spark):
    points = spark.createDataFrame([(1, 5)], "k long, t long")
    spans = spark.createDataFrame([(1, 0, 10, 1.0)], "k long, a long, b long, w double")
    with pytest.raises(ValueError, match="'all' is none of error, rows"):
        interval_lookup(points, spans, "k", "t", start="a", end="b", values=["w"], overlaps="all")


def test_ties_follow_one_another(spark):
    rows = [(1, 0, "a"), (1, 10, "b"), (1, 10, "c"), (1, 30, "d"), (2, 10, "x"), (2, 10, "x"), (2, None, "y"), (2, None, "z")]
    df = spark.createDataFrame(rows, "k long, t long, note string")
    found = counted(observed_gap(df, "k", "t", name="gap", first=60, ties="rows", ties_by=["note"]), "k", "t", "note", "gap")
    assert found == Counter(
        [
            (1, 0, "a", 60),
            (1, 10, "b", 10),
            (1, 10, "c", 0),
            (1, 30, "d", 20),
            (2, 10, "x", 60),
            (2, 10, "x", 0),
            (2, None, "y", 0),
            (2, None, "z", 60),
        ]
    )


def test_many_equal_rows_at_one_time(spark):
    df = spark.range(30_000).select(F.lit(1).alias("k"), F.lit(5).cast("long").alias("t"))
    found = observed_gap(df, "k", "t", name="gap", first=60, ties="rows").groupBy("gap").count().collect()
    assert {r["gap"]: r["count"] for r in found} == {60: 1, 0: 29_999}


def test_aligned_series_multiply(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, 2.0), (2, 5.0), (None, 9.0)], "k long, a double")
    b = spark.createDataFrame([(1, 7.0), (1, 7.0), (3, 8.0)], "k long, b double")
    rows = counted(align_series(["k"], [a, b], repeats="rows"), "k", "a", "b")
    assert rows == Counter({(1, 1.0, 7.0): 4, (1, 2.0, 7.0): 2, (2, 5.0, None): 1, (3, None, 8.0): 1})
    assert counted_series(["k"], [a, b]).count() == 4


def test_large_products_are_counted_first(spark):
    a = spark.range(3_000).select(F.lit(1).alias("k"), F.lit(1.0).alias("a"))
    b = spark.range(2_000).select(F.lit(1).alias("k"), F.lit(2.0).alias("b"))
    assert [r["_copies"] for r in counted_series(["k"], [a, b]).collect()] == [6_000_000]
    assert align_series(["k"], [a, b], repeats="rows").count() == 6_000_000


def urine(frame, *rows):
    return frame("urine_output", *(dict(patientunitstayid=1, chartoffset=t, urineoutput=v) for t, v in rows))


def patients(frame, n):
    return frame("patient", *(dict(patientunitstayid=1, uniquepid=f"p{i}", patienthealthsystemstayid=i) for i in range(n)))


def weights(frame, *rows):
    return frame(
        "weight_durations", *(dict(patientunitstayid=1, startoffset=a, endoffset=b, weight=w) for a, b, w in rows)
    )


def test_urine_of_a_stay_listed_twice(frame):
    spans = weights(frame, (0, 2000, 80.0), (500, None, 100.0))
    rows = wl.kdigo_uo(urine(frame, (0, 100.0), (360, 50.0), (720, 25.25)), patients(frame, 2), spans, repeats="rows")
    found = counted(rows, "chartoffset", "weight", "urineoutput_6hr", "uo_tm_6hr", "uo_rt_6hr")
    assert found == Counter(
        {
            (0, 80.0, 200.0, 1.0, None): 2,
            (360, 80.0, 300.0, 7.0, round(300 / 80 / 7, 4)): 2,
            (720, 80.0, 150.5, 12.0, None): 2,
            (720, 100.0, 150.5, 12.0, None): 2,
        }
    )


def test_urine_rows_at_one_offset(frame):
    rows = wl.kdigo_uo(
        urine(frame, (0, 1.0), (600, 10.0), (600, 20.0), (None, 5.0), (None, 6.0)), patients(frame, 1), weights(frame), repeats="rows"
    )
    found = counted(rows, "chartoffset", "urineoutput_24hr", "uo_tm_24hr")
    assert found == Counter({(0, 1.0, 1.0): 1, (600, 31.0, 11.0): 2, (None, 11.0, 1.0): 2})


def test_volumes_with_many_places_are_multiplied(frame):
    volume = 0.123456789012345
    rows = wl.kdigo_uo(urine(frame, (0, volume)), patients(frame, 3), weights(frame), repeats="rows")
    assert counted(rows, "urineoutput_6hr") == Counter({(0.370370367037035,): 3})


def test_stages_of_rows_at_one_offset(frame):
    creatinine = frame(
        "kdigo_creatinine",
        dict(patientunitstayid=1, labresultoffset=10, creat=4.0, creat_low_past_7day=1.0),
        dict(patientunitstayid=1, labresultoffset=10, creat=1.0, creat_low_past_7day=2.0),
    )
    rows = wl.kdigo_stages(
        patients(frame, 2), creatinine, frame("kdigo_uo"), frame("dialysis_events"), repeats="rows"
    )
    found = counted(rows, STAY, "uniquepid", "aki_stage", "aki_stage_smoothed")
    assert found == Counter({(1, f"p{i}", stage, 3): 1 for i in range(2) for stage in (0, 3)})


def test_labs_of_a_stay_with_two_hospital_stays(frame):
    listed = frame(
        "patient",
        dict(patientunitstayid=1, patienthealthsystemstayid=1, unitdischargeoffset=100),
        dict(patientunitstayid=1, patienthealthsystemstayid=2, unitdischargeoffset=None),
        dict(patientunitstayid=1, patienthealthsystemstayid=2, unitdischargeoffset=50),
    )
    lab = frame(
        "lab",
        *(dict(patientunitstayid=1, labname="creatinine", labresultoffset=t, labresult=v) for t, v in ((0, 1.0), (200, 2.0))),
    )
    rows = wl.kdigo_creatinine(listed, lab, repeats="rows")
    assert counted(rows, "patienthealthsystemstayid", "labresultoffset", "creat_low_past_48hr") == Counter(
        [(1, 0, None), (2, 0, None), (2, 200, 1.0)]
    )
