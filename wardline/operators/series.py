"""Trailing aggregates and gaps over irregular per-key series."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wardline.functions.columns import one_of
from wardline.functions.sums import running, window_parts, window_sum, window_totals
from wardline.operators.segments import own_rows, segment_window, segmented
from wardline.operators.staging import repeat_rows


class Trailing(NamedTuple):
    """An aggregate over the last ``minutes`` before a row, with or without the row's own minute."""

    aggregate: Column
    minutes: int
    include_current: bool = True

    def over(self, window: WindowSpec) -> Column:
        return self.aggregate.over(
            window.rangeBetween(-self.minutes, 0 if self.include_current else -1)
        )


def trailing(
    df: DataFrame, key: str, time: str, measures: dict[str, Trailing], *, width: int | None = None
) -> DataFrame:
    """Add trailing aggregates to a series with one row per (key, minute).

    All measures share one shuffle and one sort.
    """
    reach = max(m.minutes for m in measures.values())
    rows = segmented(df, key, time, back=reach, width=width)
    window = segment_window(key, time)
    return own_rows(rows.withColumns({name: m.over(window) for name, m in measures.items()}))


def trailing_sums(
    df: DataFrame, key: str, time: str, value: str, minutes: dict[str, int], *, width: int | None = None
) -> DataFrame:
    """Add sums of a double over the last minutes and the row's own, to a series with one row per (key, minute).

    They are the doubles nearest the sums of the numbers' decimals, NULL without any, and take as many steps as there
    are rows, however long the frames are.
    """
    of = window_parts(F.col(value))
    rows = segmented(df.withColumns(of), key, time, back=max(minutes.values()), width=width)
    added = running(rows, time, segment_window(key, time), window_totals(), minutes)
    return own_rows(added).select(*df.columns, *(window_sum(name).alias(name) for name in minutes))


def gap(time: str, window: WindowSpec, *, present: Column, first: int) -> Column:
    """Minutes since the previous row of the series, ``first`` where there is none.

    ``present`` tells rows of the series from other rows in the same window. A row
    without a time comes last and has no gap of its own. Two rows of the series at one time
    are an error, as neither comes before the other.
    """
    before = window.rangeBetween(Window.unboundedPreceding, -1)
    previous = F.last(F.when(present, F.col(time)), ignorenulls=True).over(before)
    elapsed = F.greatest(F.col(time) - previous, F.lit(0).cast("long"))
    tied = F.count(F.when(present, F.col(time))).over(window.rangeBetween(0, 0)) > 1
    message = F.concat(F.lit("a series has several rows at "), F.col(time).cast("string"))
    return F.when(
        present,
        F.when(tied, F.raise_error(message).cast("long"))
        .when(previous.isNull(), F.lit(first))
        .otherwise(elapsed),
    )


def observed_gap(
    df: DataFrame,
    key: str,
    time: str,
    *,
    name: str,
    first: int,
    ties: str = "error",
    ties_by: Sequence[str] = (),
    width: int | None = None,
) -> DataFrame:
    """Add the gap to the previous row of a series, ``first`` where there is none.

    Several rows at one (key, minute) are an error. With ``ties="rows"`` they follow one another in the order of
    ``ties_by`` and then of all columns: the first has the gap to the minute before, the others 0 (``first`` without a time,
    as no time comes before theirs). Equal rows are counted, not gathered, and written out again at the end.
    """
    if one_of(ties, "error", "rows") == "rows":
        return _tied_gap(df, key, time, name, first, ties_by, width)
    marked = df.withColumn("_present", F.lit(True))
    rows = segmented(marked, key, time, carry=[("_present",)], width=width)
    window = segment_window(key, time)
    added = rows.withColumn(name, gap(time, window, present=F.col("_present"), first=first))
    return own_rows(added).drop("_present")


def _tied_gap(
    df: DataFrame, key: str, time: str, name: str, first: int, ties_by: Sequence[str], width: int | None
) -> DataFrame:
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    place = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate([*ties_by, *df.columns])))
    moments = counted.groupBy(key, time).agg(F.min(place).alias("_leads"))
    gaps = observed_gap(moments, key, time, name=name, first=first, width=width).select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), "_leads", name
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(time).eqNullSafe(F.col("_time"))
    rows = counted.join(gaps, same).withColumn("_lead", place.eqNullSafe(F.col("_leads")))
    follows = F.when(F.col(time).isNull(), F.lit(first)).otherwise(F.lit(0)).cast("long")
    kinds = F.array(
        F.struct(F.when(F.col("_lead"), F.lit(1).cast("long")).alias("copies"), F.col(name).alias("gap")),
        F.struct((F.col("_copies") - F.col("_lead").cast("long")).alias("copies"), follows.alias("gap")),
    )
    split = rows.select(*df.columns, F.explode(kinds).alias("_kind"))
    return repeat_rows(split.select(*df.columns, F.col("_kind.gap").alias(name), "_kind.copies"), "copies")
