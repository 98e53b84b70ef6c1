"""Sums of doubles against Python's decimals, of groups and of the last minutes of a series."""

from __future__ import annotations

import math
import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from wardline.functions.sums import exact_sums
from wardline.operators.series import trailing_sums


def nearest(numbers):
    """The double nearest the sum of the decimals the numbers print as; None without any."""
    given = [Decimal(repr(x)) for x in numbers if x is not None]
    with localcontext() as context:
        context.prec = 400
        return float(sum(given, Decimal(0))) if given else None


def summed(spark, groups):
    rows = [(k, x) for k, numbers in groups.items() for x in numbers]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    sums = exact_sums(df, ["k"], {"total": F.col("x")}, {"rows": F.count("*")})
    assert sums.columns == ["k", "total", "rows"]
    return {r["k"]: r["total"] for r in sums.collect()}


CASES = {
    "charted": [123.45, 0.1, 0.2, 70.0, 1e-6],
    "negative": [-0.1, -0.2, 0.3, -123456.789],
    "beyond 18 places": [0.0012345678901234567],
    "beyond 18 places twice": [0.0012345678901234567, 0.0012345678901234567, 5.0],
    "tiny": [1e-20],
    "tiny and charted": [1e-20, 0.25, -0.25],
    "tiny of both signs": [1e-20, -3e-19, 0.0012345678901234567],
    "thirds": [1 / 3, 2 / 3, 1 / 7, -1 / 9],
    "thirds of thousands": [1000 / 3, 2000 / 3, 1e5 / 7],
    "large": [1e15, 5.0, 0.1],
    "larger": [9e19, 5.0],
    "cancelling": [9e19, -9e19, 0.1],
    "nothing": [None, None],
    "some": [None, 1.5],
    "zeros": [0.0, -0.0],
}


def test_sums_keep_their_digits(spark):
    found = summed(spark, CASES)
    assert found == {k: nearest(numbers) for k, numbers in CASES.items()}


def test_random_numbers(spark):
    draw = random.Random(3)
    kinds = [
        lambda: round(draw.uniform(-1e6, 1e6), draw.randrange(8)),
        lambda: draw.uniform(-1, 1),
        lambda: draw.uniform(-1, 1) * 10.0 ** draw.randrange(-18, 8),
        lambda: float(draw.randrange(-(2**53), 2**53)),
    ]
    groups = {f"g{i}": [draw.choice(kinds[: 1 + i % 4])() for _ in range(draw.randrange(1, 30))] for i in range(200)}
    found = summed(spark, groups)
    assert found == {k: nearest(numbers) for k, numbers in groups.items()}


def test_many_copies_of_the_largest_number_of_millionths(spark):
    df = spark.range(100_000).select(F.lit(0).alias("k"), F.lit(999_999_999.999999).alias("x"))
    assert exact_sums(df, ["k"], {"total": F.col("x")}).first()["total"] == nearest([999_999_999.999999] * 100_000)


@pytest.mark.parametrize("value", [math.nan, math.inf, 1e20, -1e20, 1.23456789e-33])
def test_numbers_without_such_a_decimal(spark, value):
    with pytest.raises(Exception, match="no decimal with (18|36) places"):
        summed(spark, {"a": [1.0, value]})


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_that_are_too_large(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="(?i)overflow|out.of"):
            summed(spark, {"a": [9e19, 9e19, 9e19]})
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_an_empty_table(spark):
    assert summed(spark, {}) == {}


@pytest.mark.parametrize("width", [None, 500])
def test_trailing_sums(spark, width):
    draw = random.Random(5)
    pick = [lambda: round(draw.uniform(0, 500), 2), lambda: draw.uniform(0, 1), lambda: 1e15, lambda: None, lambda: -0.3]
    series = {k: {t: draw.choice(pick)() for t in draw.sample(range(-3000, 9000), 60)} for k in range(8)}
    rows = [(k, t, x) for k, of in series.items() for t, x in of.items()] + [(1, None, 4.25)]
    df = spark.createDataFrame(rows, "k long, t long, x double")
    frames = {"hour": 60, "day": 1440, "now": 0}
    found = trailing_sums(df, "k", "t", "x", frames, width=width).collect()
    assert len(found) == len(rows)
    for r in found:
        for name, minutes in frames.items():
            if r["t"] is None:
                wanted = 4.25
            else:
                wanted = nearest(x for t, x in series[r["k"]].items() if r["t"] - minutes <= t <= r["t"])
            assert r[name] == wanted, (r, name)


def test_sums_of_decimals(spark):
    many = "12345678901234567.123456789012345678"
    df = spark.createDataFrame([(many,), ("0.1",), (None,)], "x string").select(F.lit(0).alias("k"), F.col("x").cast("decimal(38,18)").alias("x"))
    assert exact_sums(df, ["k"], {"total": F.col("x")}).first()["total"] == float(Decimal(many) + Decimal("0.1"))
