"""Urine volume per stay and offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import vocab
from wardline.functions.columns import text_rule
from wardline.functions.sums import exact_sums
from wardline.schemas import STAY


def is_urine(path: str) -> Column:
    return text_rule(
        path,
        prefix=vocab.OUTPUT_PREFIX,
        exactly=vocab.URINE_PATHS,
        starts=vocab.URINE_FOLEY_PREFIX,
        without=vocab.URINE_FOLEY_EXCLUDED,
        like=vocab.URINE_PATTERNS,
    )


def urine_output(intakeoutput: DataFrame, *, ordered: bool = False) -> DataFrame:
    """Summed volume of all urine cells; cells without an offset form one row per stay."""
    urine = intakeoutput.filter(F.col("cellvaluenumeric").isNotNull() & is_urine("cellpath"))
    keys = [STAY, F.col("intakeoutputoffset").alias("chartoffset")]
    result = exact_sums(urine, keys, {"urineoutput": F.col("cellvaluenumeric")})
    if ordered:
        result = result.orderBy(
            F.col(STAY).asc_nulls_last(), F.col("chartoffset").asc_nulls_last()
        )
    return result
