"""Acute kidney injury stages from creatinine, urine and renal replacement."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import vocab
from wardline.functions.columns import one_of
from wardline.operators.segments import OWN, SEGMENT, own_rows, segment_window, segmented
from wardline.operators.series import Trailing, trailing
from wardline.operators.staging import (
    COPIES,
    counted_series,
    merge_rows,
    near_event,
    repeat_rows,
    stack_series,
    stage_cascade,
)
from wardline.plans.stays import stays
from wardline.schemas import DERIVED, STAY

NEAR_MINUTES = 720
SMOOTHING_MINUTES = 360
EARLY_MINUTES = 360
_TIME = "chartoffset"


def _decimal(number: str) -> Column:
    return F.lit(Decimal(number))


def creatinine_stage(creat: Column, low_7day: Column, low_48hr: Column) -> Column:
    """NULL without a baseline from the last seven days.

    Thresholds are decimals: decimal labs are compared exactly, doubles with the same numbers as
    doubles.
    """
    severe = (creat >= low_7day * 3) | (
        (creat >= 4) & ((low_48hr <= _decimal("3.7")) | (creat >= low_7day * _decimal("1.5")))
    )
    mild = (creat >= low_48hr + _decimal("0.3")) | (creat >= low_7day * _decimal("1.5"))
    return stage_cascade(
        [
            (creat.isNull() | low_7day.isNull(), None),
            (severe, 3),
            (creat >= low_7day * 2, 2),
            (mild, 1),
        ],
        otherwise=0,
    )


def urine_stage(offset: Column, rate: dict[int, Column], hours: dict[int, Column]) -> Column:
    """NULL without a six-hour rate, 0 in the first six hours of the stay."""

    def under(limit: float, h: int) -> Column:
        return (hours[h] >= h) & (rate[h] < limit)

    none = (hours[12] >= 12) & (rate[12] == 0)
    return stage_cascade(
        [
            (rate[6].isNull(), None),
            (offset <= EARLY_MINUTES, 0),
            (under(0.3, 24) | none, 3),
            (under(0.5, 12), 2),
            (under(0.5, 6), 1),
        ],
        otherwise=0,
    )


def kdigo_stages(
    patient: DataFrame,
    kdigo_creatinine: DataFrame,
    kdigo_uo: DataFrame,
    dialysis_events: DataFrame,
    *,
    normalize_labels: bool = False,
    repeats: str = "error",
    ordered: bool = False,
) -> DataFrame:
    """Stage per stay and offset, and the highest stage of the last six hours.

    Rows carry only what is charted at exactly their offset. Several renal replacement
    events at one offset give as many equal rows. ``normalize_labels`` matches dialysis
    types with blanks read as underscores; without it peritoneal events do not count,
    because their labels are spelled differently where they are made.

    A stay listed twice and two rows of a series at one offset are errors. With ``repeats="rows"`` every row of a series
    meets every row that the others have at its offset, for each time the stay is listed.
    """
    creatinine = kdigo_creatinine.select(
        STAY,
        F.col("labresultoffset").alias(_TIME),
        "creat_low_past_7day",
        "creat_low_past_48hr",
        "creat",
        creatinine_stage(
            F.col("creat"), F.col("creat_low_past_7day"), F.col("creat_low_past_48hr")
        ).alias("aki_stage_creat"),
    )
    rates = {h: F.col(f"uo_rt_{h}hr") for h in (6, 12, 24)}
    hours = {h: F.col(f"uo_tm_{h}hr") for h in (6, 12, 24)}
    urine = kdigo_uo.select(
        STAY,
        _TIME,
        *rates.values(),
        urine_stage(F.col(_TIME), rates, hours).alias("aki_stage_uo"),
    )
    replacement = _replacement_events(dialysis_events, normalize_labels).withColumn(
        "aki_stage_dialysis", F.lit(3)
    )

    together = _single_series if one_of(repeats, "error", "rows") == "error" else _repeated_series
    staged = together([creatinine, urine, replacement])
    columns = ("uniquepid", "patienthealthsystemstayid")
    listed = stays(patient, *columns) if repeats == "error" else patient.select(STAY, *columns)
    rows = staged.join(listed, STAY).select(*DERIVED["kdigo_stages"].fieldNames(), COPIES)
    result = repeat_rows(rows, COPIES)
    return result.orderBy(STAY, _TIME) if ordered else result


_STAGES = ("aki_stage_creat", "aki_stage_uo", "aki_stage_dialysis")


def _highest() -> Column:
    return F.greatest(*(F.coalesce(c, F.lit(0)) for c in _STAGES))


def _single_series(series: list[DataFrame]) -> DataFrame:
    """The series are brought together inside the segments that the smoothing works on:
    one shuffle for both. They hold one row per minute each, so there is little that
    combining before the shuffle could save.
    """
    stacked = stack_series([STAY, _TIME], series)
    segments = segmented(stacked, STAY, _TIME, back=SMOOTHING_MINUTES)
    aligned = merge_rows(segments.repartition(STAY, SEGMENT), [STAY, SEGMENT, _TIME, OWN])
    smoothed = Trailing(F.max("aki_stage"), SMOOTHING_MINUTES)
    staged = aligned.withColumn("aki_stage", _highest()).withColumn(
        "aki_stage_smoothed", smoothed.over(segment_window(STAY, _TIME))
    )
    return own_rows(staged).withColumn(COPIES, F.coalesce("_events", F.lit(1).cast("long")))


def _repeated_series(series: list[DataFrame]) -> DataFrame:
    """Different rows meet at their offset, counted. Smoothing needs the highest stage of each minute only."""
    aligned = counted_series([STAY, _TIME], series).withColumn("aki_stage", _highest())
    moments = aligned.groupBy(STAY, _TIME).agg(F.max("aki_stage").alias("_stage"))
    smoothed = {"aki_stage_smoothed": Trailing(F.max("_stage"), SMOOTHING_MINUTES)}
    smooth = trailing(moments, STAY, _TIME, smoothed).drop("_stage")
    times = F.col(COPIES) * F.coalesce("_events", F.lit(1).cast("long"))
    return aligned.join(smooth, [STAY, _TIME]).withColumn(COPIES, times)


def _replacement_events(dialysis_events: DataFrame, normalize_labels: bool) -> DataFrame:
    """How many renal replacement events count at each offset, where any do.

    Acute modalities always count, unknown ones in stays not on chronic dialysis, and
    charted output in such stays or near an acute event. (In the other stays unknown
    modalities never count, so output near one of them is covered either way.)
    """
    dated = _dated_events(dialysis_events, normalize_labels)
    chronic = (
        dated.filter(F.col("kind").isin(_spelled(vocab.CHRONIC_TYPES, normalize_labels)))
        .select(STAY)
        .distinct()
        .withColumn("_chronic", F.lit(True))
    )
    near = near_event(
        _events_per_offset(dated, normalize_labels),
        STAY,
        _TIME,
        flag=F.col("_acute") > 0,
        minutes=NEAR_MINUTES,
        name="_near",
    )
    none = F.lit(0).cast("long")
    is_chronic = F.col("_chronic").isNotNull()
    counted = (
        F.col("_acute")
        + F.when(is_chronic, none).otherwise(F.col("_unknown"))
        + F.when(is_chronic & ~F.col("_near"), none).otherwise(F.col("_output"))
    )
    return (
        near.join(chronic, STAY, "left")
        .select(STAY, _TIME, counted.alias("_events"))
        .filter(F.col("_events") > 0)
    )


def _dated_events(dialysis_events: DataFrame, normalize_labels: bool) -> DataFrame:
    kind = F.col("dialysis_type")
    if normalize_labels:
        kind = F.translate(kind, " ", "_")
    return dialysis_events.filter(F.col(_TIME).isNotNull()).select(
        STAY, _TIME, kind.alias("kind")
    )


def _spelled(names: tuple[str, ...], normalize_labels: bool) -> list[str]:
    return [n.replace(" ", "_") if normalize_labels else n for n in names]


def _events_per_offset(dated: DataFrame, normalize_labels: bool) -> DataFrame:
    """Counts of the events that may matter per stay and offset, combined map-side."""
    acute = _spelled(vocab.ACUTE_TYPES, normalize_labels)
    unknown = _spelled(vocab.UNKNOWN_TYPES, normalize_labels)
    output = [vocab.DIALYSIS_OUTPUT]
    kind = F.col("kind")
    return (
        dated.filter(kind.isin(acute + unknown + output))
        .groupBy(STAY, _TIME)
        .agg(
            F.count_if(kind.isin(acute)).alias("_acute"),
            F.count_if(kind.isin(unknown)).alias("_unknown"),
            F.count_if(kind.isin(output)).alias("_output"),
        )
    )
