"""Trailing urine volumes, observed hours and rates per kilogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.columns import one_of, rounded_rate, rows_or_error
from wardline.functions.sums import Running, checked_sum, running, window_parts, window_sum, window_totals
from wardline.operators.intervals import covers, in_force, interval_join, live_intervals, overlapping
from wardline.operators.segments import SEGMENT, UNDATED, own_rows, segment_window, segmented
from wardline.operators.series import gap
from wardline.operators.staging import COPIES, repeat_rows
from wardline.plans.stays import stays, times_listed
from wardline.schemas import STAY

HOURS = (6, 12, 24)
FIRST_ROW_MINUTES = 60


def kdigo_uo(
    urine_output: DataFrame,
    patient: DataFrame,
    weight_durations: DataFrame,
    *,
    repeats: str = "error",
    ordered: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Volumes and observed hours of the last 6, 12 and 24 hours and ml/kg/h rates.

    The weight is the one valid at the row itself. A row counts the whole time since
    the row before it, even where that began before the frame, and one hour if it is
    the first of its stay. Time is summed in whole minutes and turned into hours last,
    so the 6, 12 and 24 hour limits are met exactly.

    Two urine rows of a stay at one offset, overlapping intervals and stays listed twice are errors; the plans that
    make these tables give none. With ``repeats="rows"`` each urine row counts as often as its stay is listed, rows at one
    offset are one hour or gap together (the first has it), and a row is repeated for each weight valid at it.
    """
    if one_of(repeats, "error", "rows") == "rows":
        result = _repeated_rates(urine_output, patient, weight_durations, width)
    else:
        result = _single_rates(urine_output, patient, weight_durations, width)
    return result.orderBy(STAY, F.col(TIME).asc_nulls_last()) if ordered else result


TIME = "chartoffset"


def _single_rates(
    urine_output: DataFrame, patient: DataFrame, weight_durations: DataFrame, width: int | None
) -> DataFrame:
    """Urine rows and weight intervals are merged in time order, so one shuffle and one
    sort serve the gaps, the trailing sums and the interval lookup.
    """
    urine = urine_output.select(
        STAY,
        TIME,
        *(c.alias(name) for name, c in window_parts(F.col("urineoutput")).items()),
        F.lit(True).alias("_urine"),
    ).join(stays(patient), STAY, "left_semi")
    weights = live_intervals(weight_durations, "startoffset", "endoffset").select(
        STAY,
        F.col("startoffset").alias(TIME),
        F.col("startoffset").alias("_start"),
        F.col("endoffset").alias("_end"),
        F.col("weight").alias("_weight"),
    )
    merged = urine.unionByName(weights, allowMissingColumns=True)
    rows = segmented(
        merged,
        STAY,
        TIME,
        back=HOURS[-1] * 60,
        carry=[["_urine"], ["_start", "_end", "_weight"]],
        width=width,
    )
    window = segment_window(STAY, TIME)
    is_urine = F.coalesce("_urine", F.lit(False))
    interval = F.when(F.col("_start").isNotNull(), F.struct("_start", "_end", "_weight"))
    rows = rows.withColumn("_interval", interval).withColumns(
        {
            "minutes": gap(TIME, window, present=is_urine, first=FIRST_ROW_MINUTES),
            "_interval": in_force("_interval", window),
            "_overlaps": overlapping(TIME, F.col("_start"), F.col("_end"), window),
        }
    )
    rows = running(rows, TIME, window, _totals(), _frames())
    valid = covers(F.col(TIME), F.col("_interval._start"), F.col("_interval._end"))
    own = rows_or_error("_overlaps", is_urine, "weight intervals overlap", [STAY, TIME])
    weighed = own_rows(rows.filter(own)).withColumn("weight", F.when(valid, F.col("_interval._weight")))
    return _rates(weighed).drop(COPIES)


def _repeated_rates(
    urine_output: DataFrame, patient: DataFrame, weight_durations: DataFrame, width: int | None
) -> DataFrame:
    """Rows of a stay and offset are added up before anything is sorted, and written out again last.

    All of them have the same sums, as a frame holds all rows of its last minute.
    """
    times = F.col("_times")
    moments = (
        urine_output.select(STAY, TIME, *(c.alias(n) for n, c in window_parts(F.col("urineoutput")).items()))
        .groupBy(STAY, TIME)
        .agg(
            F.sum("_units").alias("_units"),
            checked_sum(F.sum("_wide"), F.count("_wide")).alias("_wide"),
            F.count("*").alias("_rows"),
        )
        .join(times_listed(patient, "_times"), STAY)
        .select(
            STAY,
            TIME,
            (F.col("_units") * times).alias("_units"),
            _multiplied(F.col("_wide"), times).alias("_wide"),
            (F.col("_rows") * times).alias(COPIES),
            F.lit(True).alias("_urine"),
        )
    )
    rows = segmented(moments, STAY, TIME, back=HOURS[-1] * 60, carry=[["_urine"]], width=width)
    window = segment_window(STAY, TIME)
    since = gap(TIME, window, present=F.col("_urine"), first=FIRST_ROW_MINUTES)
    # rows without a time have no row before them in time, but for the first
    undated = F.when(F.col(TIME).isNull(), (F.col(COPIES) - 1) * FIRST_ROW_MINUTES).otherwise(0)
    rows = running(rows.withColumn("minutes", since + undated), TIME, window, _totals(), _frames())
    weighed = interval_join(
        own_rows(rows), weight_durations, STAY, TIME, start="startoffset", end="endoffset", values=["weight"]
    )
    return repeat_rows(_rates(weighed), COPIES)


def _multiplied(value: Column, times: Column) -> Column:
    """A decimal of 18 places times a count; an error if it does not fit."""
    many = value.try_cast("decimal(28,18)") * times.try_cast("decimal(9,0)")
    lost = F.raise_error(F.lit("a sum overflows its decimal")).cast("decimal(38,18)")
    product = F.when(times == 1, value).otherwise(many.cast("decimal(38,18)"))
    return F.when(value.isNotNull() & product.isNull(), lost).otherwise(product)


def _totals() -> dict[str, Running]:
    # in the segment of rows without a time, the dated row that is carried in counts for nothing
    counts = F.col(TIME).isNull() | (F.col(SEGMENT) != UNDATED)
    return window_totals() | {"minutes": Running(F.sum(F.when(counts, F.col("minutes"))))}


def _frames() -> dict[str, int]:
    return {str(h): h * 60 for h in HOURS}


def _rates(rows: DataFrame) -> DataFrame:
    """The columns of the result, and how often each row is there if that is known."""
    rows = rows.withColumns({f"volume_{h}": window_sum(str(h)) for h in HOURS})
    if COPIES not in rows.columns:
        rows = rows.withColumn(COPIES, F.lit(1).cast("long"))

    def hours(h: int) -> Column:
        return F.col(f"minutes_{h}") / F.lit(60.0)

    def rate(h: int) -> Column:
        minutes = F.col(f"minutes_{h}")
        enough = minutes >= h * 60
        if h == 6:
            enough = enough & (minutes < 12 * 60)
        return F.when(
            F.col("weight").isNotNull() & enough, rounded_rate(F.col(f"volume_{h}"), F.col("weight"), hours(h))
        )

    return rows.select(
        STAY,
        TIME,
        "weight",
        *(F.col(f"volume_{h}").alias(f"urineoutput_{h}hr") for h in HOURS),
        *(rate(h).alias(f"uo_rt_{h}hr") for h in HOURS),
        *(hours(h).alias(f"uo_tm_{h}hr") for h in HOURS),
        COPIES,
    )
