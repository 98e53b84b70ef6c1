"""Plain forms of three steps, timed against the forms in use.

    python -m workbench.alternatives [sf_dir]

Each plain form gives the same rows (see tests); the point is what they cost.
"""

from __future__ import annotations

import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.operators.intervals import interval_lookup
from wardline.operators.series import Trailing, trailing
from wardline.schemas import STAY
from wardline.sources.tables import store_in
from workbench import queries
from workbench.check import session

TIME = "labresultoffset"
LOWS = {"low_48hr": 2880, "low_7day": 10080}


def lows_by_segment(series: DataFrame) -> DataFrame:
    low = F.min("creat")
    return trailing(series, STAY, TIME, {n: Trailing(low, m, False) for n, m in LOWS.items()})


def lows_by_key(series: DataFrame) -> DataFrame:
    w = Window.partitionBy(STAY).orderBy(TIME)
    return series.withColumns(
        {n: F.min("creat").over(w.rangeBetween(-m, -1)) for n, m in LOWS.items()}
    )


def lows_by_self_join(series: DataFrame) -> DataFrame:
    earlier = series.select(
        F.col(STAY).alias("_stay"), F.col(TIME).alias("_time"), F.col("creat").alias("_creat")
    )
    back = F.col(TIME) - F.col("_time")
    joined = series.join(earlier, (F.col(STAY) == F.col("_stay")) & back.between(1, 10080), "left")
    return joined.groupBy(STAY, TIME, "creat").agg(
        *(F.min(F.when(back <= m, F.col("_creat"))).alias(n) for n, m in LOWS.items())
    )


def weights_by_merge(points: DataFrame, intervals: DataFrame) -> DataFrame:
    return interval_lookup(
        points,
        intervals,
        STAY,
        "chartoffset",
        start="startoffset",
        end="endoffset",
        values=["weight"],
    )


def weights_by_join(points: DataFrame, intervals: DataFrame) -> DataFrame:
    spans = intervals.withColumnRenamed(STAY, "_stay")
    held = (
        (F.col(STAY) == F.col("_stay"))
        & (F.col("chartoffset") >= F.col("startoffset"))
        & (F.col("chartoffset") < F.col("endoffset"))
    )
    return points.join(spans, held, "left").select(*points.columns, "weight")


def seconds(build: Callable[[], DataFrame], runs: int = 3) -> float:
    def once() -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(runs)), 2)


def main(sf_dir: str = "/root/testdata/sf0.1") -> None:
    spark: SparkSession = session()
    kept = store_in(tempfile.mkdtemp(prefix="alternatives-"))
    series = kept(
        queries.kdigo_creatinine(spark, sf_dir).select(STAY, TIME, "creat"), "series"
    )
    for form in (lows_by_segment, lows_by_key, lows_by_self_join):
        print(form.__name__, seconds(lambda: form(series)), flush=True)
    points = kept(queries.urine_output(spark, sf_dir), "points")
    intervals = kept(queries.weight_durations(spark, sf_dir), "intervals")
    for form in (weights_by_merge, weights_by_join):
        print(form.__name__, seconds(lambda: form(points, intervals)), flush=True)
    for setting in ("true", "false"):
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", setting)
        stages = seconds(lambda: queries.kdigo_stages(spark, sf_dir))
        print("kdigo_stages, requireAllClusterKeysForCoPartition", setting, stages, flush=True)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
