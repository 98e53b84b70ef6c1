"""The stays that all plans join with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.columns import rows_or_error
from wardline.schemas import STAY


def stays(patient: DataFrame, *columns: Column | str) -> DataFrame:
    """One row per stay with some columns; a stay listed twice is an error.

    The aggregation that finds out partitions by stay, as the joins with it need anyway.
    """
    listed = patient.filter(F.col(STAY).isNotNull()).select(STAY, *columns)
    values = [c for c in listed.columns if c != STAY]
    counted = listed.groupBy(STAY).agg(
        *(F.first(c).alias(c) for c in values), (F.count("*") > 1).alias("_repeated")
    )
    once = counted.filter(rows_or_error("_repeated", F.lit(True), "patient lists a stay more than once", [STAY]))
    return once.drop("_repeated")


def times_listed(patient: DataFrame, name: str) -> DataFrame:
    """How often each stay is listed."""
    return patient.filter(F.col(STAY).isNotNull()).groupBy(STAY).agg(F.count("*").alias(name))
