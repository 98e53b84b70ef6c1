"""Creatinine per stay and offset with its trailing minima."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.columns import one_of
from wardline.functions.sums import checked_sum, exact_sums
from wardline.operators.series import Trailing, trailing
from wardline.plans.stays import stays
from wardline.schemas import STAY

HOURS_48 = 2_880
DAYS_7 = 10_080
LOWEST, HIGHEST = "0.01", 150


def kdigo_creatinine(
    patient: DataFrame, lab: DataFrame, *, repeats: str = "error", ordered: bool = False
) -> DataFrame:
    """Mean creatinine per offset and the lowest earlier value within 48 hours and 7 days.

    Labs are averaged before the join with the stays, so repeated labs shrink map-side.
    Decimal labs stay decimals, so that a rise of exactly 0.3 is one; doubles are summed as
    decimals and averaged as doubles. A stay listed twice is an error; with ``repeats="rows"`` its labs are there once for
    each of its hospital stays, up to the last discharge listed for that one, and the lowest values are those of the stay.
    """
    labs = lab.filter(
        (F.lower("labname") == "creatinine")
        & F.col("labresult").between(F.lit(Decimal(LOWEST)), HIGHEST)
        & (F.col("labresultoffset") >= -DAYS_7)
    )
    keys = [STAY, "labresultoffset"]
    result, count = F.col("labresult"), F.count("labresult")
    if isinstance(lab.schema["labresult"].dataType, T.DecimalType):
        totals = labs.groupBy(*keys).agg(checked_sum(F.sum(result), count).alias("_total"), count.alias("_labs"))
    else:
        totals = exact_sums(labs, keys, {"_total": result}, {"_labs": count})
    series = totals.select(*keys, (F.col("_total") / F.col("_labs")).alias("creat"))
    hospital, discharge = "patienthealthsystemstayid", "unitdischargeoffset"
    if one_of(repeats, "error", "rows") == "rows":
        listed = patient.filter(F.col(STAY).isNotNull()).groupBy(STAY, hospital).agg(_last(discharge))
        bounds = listed.groupBy(STAY).agg(_last(discharge))
    else:
        listed = bounds = stays(patient, hospital, discharge)
    within_stay = F.col(discharge).isNull() | (F.col("labresultoffset") <= F.col(discharge))
    of_stays = series.join(bounds, STAY).filter(within_stay).drop(discharge)
    lowest = F.min("creat")
    result = trailing(
        of_stays,
        STAY,
        "labresultoffset",
        {
            "creat_low_past_48hr": Trailing(lowest, HOURS_48, include_current=False),
            "creat_low_past_7day": Trailing(lowest, DAYS_7, include_current=False),
        },
    )
    if listed is not bounds:
        result = result.join(listed, STAY).filter(within_stay)
    result = result.select(
        STAY,
        hospital,
        "labresultoffset",
        "creat",
        "creat_low_past_48hr",
        "creat_low_past_7day",
    )
    return result.orderBy(STAY, "labresultoffset") if ordered else result


def _last(offset: str) -> Column:
    """The latest of some offsets, NULL (open) if one of them is."""
    return F.when(F.count(offset) == F.count("*"), F.max(offset)).alias(offset)
