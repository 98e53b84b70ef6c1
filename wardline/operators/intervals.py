"""Validity intervals and point-in-interval lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wardline.functions.columns import one_of, rows_or_error
from wardline.operators.segments import (
    SEGMENT,
    own_rows,
    segment_of,
    segment_width,
    segment_window,
    segmented,
)


def validity_intervals(
    starts: DataFrame,
    bounds: DataFrame,
    key: str,
    time: str,
    *,
    opening: str,
    closing: str,
    margin: int,
    payload: Sequence[str],
    first_payload: dict[str, str] | None = None,
    width: int | None = None,
) -> DataFrame:
    """Half-open intervals ``[startoffset, endoffset)`` between the times of a series.

    ``starts`` has one row per (key, time), ``bounds`` one per key; keys missing from
    ``bounds`` are dropped. An interval ends where the next one starts, the last one
    ``margin`` after the closing time (after its own start if there is no closing time).
    Where the opening time lies before the first start, one more interval reaches from
    ``margin`` before the opening time to that start; its payload is taken from the
    columns named in ``first_payload`` (by default the same as the payload).
    """
    first_payload = first_payload or {c: c for c in payload}
    rows = starts.withColumn(SEGMENT, segment_of(F.col(time), width or segment_width()))

    # One row per (key, segment): where the next segment of the key begins.
    by_segment = Window.partitionBy(key).orderBy(SEGMENT)
    edges = (
        rows.groupBy(key, SEGMENT)
        .agg(F.min(time).alias("_head"))
        .select(
            key,
            SEGMENT,
            "_head",
            F.lead("_head").over(by_segment).alias("_next_head"),
            F.lag("_head").over(by_segment).isNull().alias("_opens_key"),
        )
        .join(
            bounds.select(key, F.col(opening).alias("_open"), F.col(closing).alias("_close")),
            key,
        )
    )
    chained = rows.withColumn("_next", F.lead(time).over(segment_window(key, time))).join(
        edges, [key, SEGMENT]
    )

    at = F.col(time)
    end = F.coalesce("_next", "_next_head", F.coalesce(F.col("_close"), at) + margin)
    own = F.struct(
        at.alias("startoffset"), end.alias("endoffset"), *(F.col(c).alias(c) for c in payload)
    )
    before = F.struct(
        (F.col("_open") - margin).alias("startoffset"),
        at.alias("endoffset"),
        *(F.col(first_payload[c]).alias(c) for c in payload),
    )
    leads = F.col("_opens_key") & (at == F.col("_head")) & (F.col("_open") < at)
    return chained.select(
        key, F.explode(F.when(leads, F.array(own, before)).otherwise(F.array(own))).alias("_row")
    ).select(key, "_row.*")


def live_intervals(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals that hold at least one minute; an end of NULL means open-ended."""
    return intervals.filter(F.col(end).isNull() | (F.col(end) > F.col(start)))


def in_force(column: str, window: WindowSpec) -> Column:
    """The latest value of a column at or before the current row."""
    return F.last(column, ignorenulls=True).over(
        window.rangeBetween(Window.unboundedPreceding, 0)
    )


def covers(time: Column, latest_start: Column, end: Column) -> Column:
    """Whether the latest interval that has started is still valid at a time."""
    return time.isNotNull() & latest_start.isNotNull() & (end.isNull() | (time < end))


def overlapping(time: str, start: Column, end: Column, window: WindowSpec) -> Column:
    """Whether a row begins an interval before the one in force has ended, or together with another."""
    ends = F.when(start.isNotNull(), F.coalesce(end, F.lit(2**63 - 1)))
    latest = F.max(ends).over(window.rangeBetween(Window.unboundedPreceding, -1))
    beside = F.count(start).over(window.rangeBetween(0, 0)) > 1
    return start.isNotNull() & F.col(time).isNotNull() & ((latest > start) | beside)


#: Intervals are covered by blocks of 2^6 minutes, and those doubled up to 12 times.
SMALLEST, DOUBLINGS = 6, 12


def _cover(first: Column, last: Column) -> Column:
    """The fewest (level, block) that make up the smallest blocks from ``first`` to ``last``; a block of level k has 2^k.

    As in a segment tree: of each level at most a block at either end, and all in between of the last.
    """

    def block(level: int, number: Column) -> Column:
        return F.struct(F.lit(level).alias("_level"), number.alias("_block"))

    parts = []
    for k in range(DOUBLINGS):
        left, right = -F.shiftright(-first, k), F.shiftright(last + 1, k)
        parts.append(F.when((left < right) & (left.bitwiseAND(1) == 1), block(k, left)))
        parts.append(F.when((left < right) & (right.bitwiseAND(1) == 1), block(k, right - 1)))
    left, right = -F.shiftright(-first, DOUBLINGS), F.shiftright(last + 1, DOUBLINGS)
    inner = F.when(left < right, F.transform(F.sequence(left, right - 1), lambda b: block(DOUBLINGS, b)))
    return F.concat(F.array_compact(F.array(*parts)), F.coalesce(inner, F.array().cast(_BLOCKS)))


_BLOCKS = "array<struct<_level: int, _block: bigint>>"


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    *,
    start: str,
    end: str,
    values: Sequence[str],
) -> DataFrame:
    """Add the values of every interval that holds a point: a row per match, one with NULLs for a point without any.

    Intervals may overlap and repeat. Each is cut into blocks of time, some small ones at its ends and large ones between,
    and a moment lies in one block of each size, so both meet in an equality join at most once. Only moments that an
    interval holds, or that lie within 64 minutes of its ends, are paired with it: never a whole key with all its
    intervals. Intervals are cut to the time that the points of their key span, which bounds the open-ended ones.
    """
    names = {c: f"_{c}" for c in values}
    moments = points.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key), F.col(time).cast("long").alias(time)
    )
    moments = moments.distinct()
    span = moments.groupBy(key).agg(F.min(time).alias("_least"), F.max(time).alias("_most"))
    live = live_intervals(intervals, start, end).select(
        key,
        F.col(start).cast("long").alias("_start"),
        F.col(end).cast("long").alias("_end"),
        *(F.col(c).alias(n) for c, n in names.items()),
    )
    first = F.shiftright(F.greatest("_start", "_least"), SMALLEST)
    last = F.shiftright(F.least(F.coalesce(F.col("_end") - 1, F.col("_most")), "_most"), SMALLEST)
    reached = live.filter(F.col("_start").isNotNull()).join(span, key).filter(first <= last)
    covers = reached.select(key, "_start", "_end", *names.values(), F.explode(_cover(first, last)).alias("_at")).select(
        key, "_start", "_end", *names.values(), "_at.*"
    )
    levels = [
        F.struct(F.lit(k).alias("_level"), F.shiftright(time, SMALLEST + k).alias("_block")) for k in range(DOUBLINGS + 1)
    ]
    placed = moments.select(key, time, F.explode(F.array(*levels)).alias("_at")).select(key, time, "_at.*")
    held = (F.col(time) >= F.col("_start")) & (F.col("_end").isNull() | (F.col(time) < F.col("_end")))
    matches = covers.join(placed, [key, "_level", "_block"]).filter(held).select(key, time, *names.values())
    return points.join(matches, [key, time], "left").select(
        *points.columns, *(F.col(n).alias(c) for c, n in names.items())
    )


def interval_lookup(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    *,
    start: str,
    end: str,
    values: Sequence[str],
    overlaps: str = "error",
    width: int | None = None,
) -> DataFrame:
    """Add the values of the interval that holds each point, NULL where none does.

    The intervals of a key must not overlap, which is checked. So the only candidate for a
    point is the latest interval that started at or before it, and a merge of both sides
    in time order finds it without pairing rows. With ``overlaps="rows"`` they may, and there is
    a row for each of them (``interval_join``).
    """
    if one_of(overlaps, "error", "rows") == "rows":
        return interval_join(points, intervals, key, time, start=start, end=end, values=values)
    names = {c: f"_{c}" for c in values}
    live = live_intervals(intervals, start, end).select(
        key,
        F.col(start).alias(time),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *(F.col(c).alias(names[c]) for c in values),
    )
    merged = points.withColumn("_point", F.lit(True)).unionByName(live, allowMissingColumns=True)
    carried = ["_start", "_end", *names.values()]
    rows = segmented(merged, key, time, carry=[carried], width=width)

    # One struct per interval row keeps a NULL end or value with its own start.
    entry = F.when(F.col("_start").isNotNull(), F.struct(*carried))
    window = segment_window(key, time)
    found = rows.withColumn("_entry", entry).withColumns(
        {
            "_entry": in_force("_entry", window),
            "_overlaps": overlapping(time, F.col("_start"), F.col("_end"), window),
        }
    )
    valid = covers(F.col(time), F.col("_entry._start"), F.col("_entry._end"))
    is_point = rows_or_error("_overlaps", F.col("_point"), "intervals overlap", [key, time])
    return (
        own_rows(found.filter(is_point).drop("_overlaps"))
        .withColumns({c: F.when(valid, F.col("_entry").getField(n)) for c, n in names.items()})
        .drop("_point", "_entry", *carried)
    )
