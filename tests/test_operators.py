"""Segmented operators against the plain forms: windows per key, range joins, loops.

Segments are made short here, so that frames, gaps and intervals reach across many.
"""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import values
from wardline import vocab
from wardline.operators.intervals import interval_lookup, validity_intervals
from wardline.operators.labels import label_events
from wardline.operators.segments import own_rows, segmented
from wardline.operators.series import Trailing, observed_gap, trailing
from wardline.operators.staging import align_series, near_event, repeat_rows

WIDTHS = (1, 7, 50, 10_000)


def _series(spark, seed: int, keys: int = 6, rows: int = 300, reach: int = 900):
    """One row per (k, t); key 0 holds a third of all rows, times cluster and have gaps."""
    rng = random.Random(seed)
    taken = set()
    while len(taken) < rows:
        k = 0 if rng.random() < 0.33 else rng.randrange(keys)
        t = rng.randrange(-reach, reach) if rng.random() < 0.5 else rng.randrange(0, 60)
        taken.add((k, t))
    data = [(k, t, rng.randrange(1000)) for k, t in sorted(taken)]
    return spark.createDataFrame(data, "k long, t long, v long"), data


@pytest.mark.parametrize("width", WIDTHS)
def test_trailing_equals_plain_window(spark, width):
    df, _ = _series(spark, 1)
    w = Window.partitionBy("k").orderBy("t")
    plain = df.withColumns(
        {
            "s": F.sum("v").over(w.rangeBetween(-40, 0)),
            "m": F.min("v").over(w.rangeBetween(-100, -1)),
            "x": F.max("v").over(w.rangeBetween(-7, 0)),
        }
    )
    ours = trailing(
        df,
        "k",
        "t",
        {
            "s": Trailing(F.sum("v"), 40),
            "m": Trailing(F.min("v"), 100, include_current=False),
            "x": Trailing(F.max("v"), 7),
        },
        width=width,
    )
    assert ours.columns == plain.columns
    assert values(ours, *ours.columns) == values(plain, *plain.columns)


@pytest.mark.parametrize("width", WIDTHS)
def test_gap_equals_lag(spark, width):
    df, _ = _series(spark, 2)
    undated = spark.createDataFrame([(0, None, 1), (99, None, 1)], df.schema)
    df = df.union(undated)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last())
    previous = F.lag("t").over(w)
    plain = df.withColumn(
        "gap", F.when(previous.isNull(), 60).otherwise(F.greatest(F.col("t") - previous, F.lit(0)))
    )
    ours = observed_gap(df, "k", "t", name="gap", first=60, width=width)
    assert values(ours, "k", "t", "gap") == values(plain, "k", "t", "gap")
    assert (99, None, 60) in values(ours, "k", "t", "gap")
    assert (0, None, 0) in values(ours, "k", "t", "gap")


@pytest.mark.parametrize("width", WIDTHS)
def test_carried_rows_come_from_before_the_context(spark, width):
    """With a frame and carried rows at once, the row before is found and counted once."""
    df, data = _series(spark, 3)
    rows = segmented(df, "k", "t", back=30, carry=[["v"]], width=width)
    w = Window.partitionBy("k", "_segment").orderBy("t")
    out = own_rows(
        rows.withColumns({"before": F.lag("v").over(w), "s": F.sum("v").over(w.rangeBetween(-30, 0))})
    )
    wanted = []
    for k, t, v in data:
        earlier = [(t2, v2) for k2, t2, v2 in data if k2 == k and t2 < t]
        near = sum(v2 for k2, t2, v2 in data if k2 == k and t - 30 <= t2 <= t)
        wanted.append((k, t, max(earlier)[1] if earlier else None, near))
    assert values(out, "k", "t", "before", "s") == sorted(wanted)


def test_segments_are_bounded(spark):
    """However many rows a key has, a segment holds no more than its width and reach."""
    df = spark.range(5_000).selectExpr("0L AS k", "id AS t", "id AS v")
    rows = segmented(df, "k", "t", back=50, ahead=20, carry=[["v"]], width=200)
    largest = rows.groupBy("k", "_segment").count().agg(F.max("count")).first()[0]
    assert largest <= 200 + 50 + 20 + 1


@pytest.mark.parametrize("width", WIDTHS)
def test_near_event_equals_exists(spark, width):
    df, data = _series(spark, 4)
    ours = near_event(df, "k", "t", flag=F.col("v") < 100, minutes=25, name="near", width=width)
    wanted = [
        (k, t, any(k2 == k and v2 < 100 and abs(t - t2) <= 25 for k2, t2, v2 in data))
        for k, t, _ in data
    ]
    assert values(ours, "k", "t", "near") == sorted(wanted)


@pytest.mark.parametrize("width", WIDTHS)
def test_validity_intervals_equal_lead(spark, width):
    df, data = _series(spark, 5)
    bounds = [(0, -300, 5000), (1, 40, None), (2, 2000, 10), (3, 0, None), (4, -5000, -4000)]
    ours = validity_intervals(
        df,
        spark.createDataFrame(bounds, "k long, a long, z long"),
        "k",
        "t",
        opening="a",
        closing="z",
        margin=120,
        payload=["v"],
        width=width,
    )
    wanted = []
    for key, opening, closing in bounds:
        starts = [(t, v) for k, t, v in data if k == key]
        ends = [t for t, _ in starts[1:]]
        ends.append((starts[-1][0] if closing is None else closing) + 120)
        wanted += [(key, t, e, v) for (t, v), e in zip(starts, ends)]
        if opening < starts[0][0]:
            wanted.append((key, opening - 120, *starts[0]))
    assert values(ours, "k", "startoffset", "endoffset", "v") == sorted(wanted)


@pytest.mark.parametrize("width", WIDTHS)
def test_interval_lookup_equals_range_join(spark, width):
    points, data = _series(spark, 6)
    rng = random.Random(7)
    intervals = []
    for k in range(5):
        t = -950
        while t < 900:
            end = t + rng.choice([0, 1, 5, 40, 300])
            intervals.append((k, t, end, rng.choice([None, t * 1.0])))
            t = end + rng.choice([0, 0, 3, 100]) + (end == t)
        intervals.append((k, t, rng.choice([None, t - 10, t + 20]), -1.0))
    ranges = spark.createDataFrame(intervals, "k long, s long, e long, w double")
    ours = interval_lookup(
        points, ranges, "k", "t", start="s", end="e", values=["w"], width=width
    )
    plain = points.join(
        ranges.withColumnRenamed("k", "k2"),
        (F.col("k") == F.col("k2")) & (F.col("t") >= F.col("s")) & (F.col("e").isNull() | (F.col("t") < F.col("e"))),
        "left",
    )
    assert values(ours, "k", "t", "v", "w") == values(plain, "k", "t", "v", "w")


def test_align_series(spark):
    a = spark.createDataFrame([(1, 1, 1.0), (1, 2, None), (2, None, 9.0)], "k long, t long, a double")
    b = spark.createDataFrame([(1, 2, 5), (3, 0, None)], "k long, t long, b long")
    out = align_series(["k", "t"], [a, b])
    assert values(out, "k", "t", "a", "b") == [
        (1, 1, 1.0, None),
        (1, 2, None, 5),
        (3, 0, None, None),
    ]


def test_repeat_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 10), (4, 11), (5, 25), (6, -3)], "k long, n long")
    out = repeat_rows(df, "n", block=10).groupBy("k").count()
    assert values(out, "k", "count") == [(2, 1), (3, 10), (4, 11), (5, 25)]


def test_labels(spark):
    df = spark.createDataFrame([("a",), ("A",), ("b",), ("c ",), (None,), ("d",)], "s string")
    out = label_events(df, "s", [("a", "x"), ("a", "y"), ("b", None), ("c", "z")], "label")
    assert values(out, "s", "label") == [("a", "x"), ("a", "y"), ("b", None)]


def test_labels_equal_a_case_expression(spark):
    strings = [v for v, _ in vocab.DIALYSIS_TREATMENT] + ["renal|dialysis", "renal|dialysis|sled", None]
    df = spark.createDataFrame([(s,) for s in strings * 3], "s string")
    chain = F.lit(None)
    for value, label in vocab.DIALYSIS_TREATMENT:
        chain = F.when(F.col("s") == value, label).otherwise(chain)
    plain = df.select("s", chain.alias("label")).filter("label IS NOT NULL")
    ours = label_events(df, "s", vocab.DIALYSIS_TREATMENT, "label")
    assert values(ours, "s", "label") == values(plain, "s", "label")
    assert len(values(ours, "s")) == 31 * 3
