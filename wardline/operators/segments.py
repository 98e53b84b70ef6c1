"""Per-key time series cut into bounded stretches of time.

A window partitioned by the key alone puts a whole key into one task, and one key may
hold a large share of all rows. Here a series is cut into segments of fixed length and
partitioned by (key, segment). So that each segment can be worked on alone, it also
receives *context rows* from outside:

* rows up to ``back`` minutes before the segment and ``ahead`` minutes after it, for
  range frames that reach across its edges;
* for each group of columns in ``carry``, the last row before that stretch in which
  the first column of the group is set, for "previous row" and "value in force"
  questions, which have no bounded reach.

Segments are at least a week and four times the reach of the frame, so at most one row
in four is copied, and few of a stay shorter than a segment. A series with one row per
(key, minute) therefore has at most ``width + back + ahead`` rows plus the carried ones
in a segment, however many rows the key has in all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SEGMENT = "_segment"
OWN = "_own"

WEEK = 10_080
#: A segment starts a week before admission, where the earliest labs in use lie.
ORIGIN = -WEEK

#: Rows without a time sort last, in a segment of their own.
UNDATED = 2**62


def segment_width(back: int = 0, ahead: int = 0) -> int:
    return max(WEEK, 4 * (back + ahead))


def segment_of(time: Column, width: int) -> Column:
    number = F.floor((time - F.lit(ORIGIN)) / F.lit(width)).cast("long")
    return F.coalesce(number, F.lit(UNDATED))


def segment_window(key: str, time: str) -> WindowSpec:
    return Window.partitionBy(key, SEGMENT).orderBy(F.col(time).asc_nulls_last())


def segmented(
    df: DataFrame,
    key: str,
    time: str,
    *,
    back: int = 0,
    ahead: int = 0,
    carry: Sequence[Sequence[str]] = (),
    width: int | None = None,
) -> DataFrame:
    """``df`` with its segment number, whether a row is the segment's own, and context rows."""
    width = max(width or segment_width(back, ahead), back, ahead)
    at = F.col(time)
    here = segment_of(at, width)
    first = segment_of(at - ahead, width) if ahead else here
    last = segment_of(at + back, width) if back else here
    rows = df.withColumn(
        SEGMENT, F.explode(F.sequence(first, last)) if back or ahead else here
    ).withColumn(OWN, F.col(SEGMENT) == here)
    if carry:
        rows = rows.unionByName(
            _carried(df, key, time, back, carry, width), allowMissingColumns=True
        )
    return rows


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the context rows and the bookkeeping columns."""
    return df.filter(OWN).drop(SEGMENT, OWN)


def _carried(
    df: DataFrame,
    key: str,
    time: str,
    back: int,
    carry: Sequence[Sequence[str]],
    width: int,
) -> DataFrame:
    """One row per (key, segment, group): the last one before the segment's stretch.

    Works on one summary row per (key, segment), built with map-side combining. A row
    within ``back`` of the next segment is context there already, so for the segment
    right after its own only earlier rows qualify ("early"); from the second segment
    on any row does ("late").
    """
    at = F.col(time)
    here = segment_of(at, width)
    early = segment_of(at + back, width) == here

    aggregates = []
    for group in carry:
        lead = group[0]
        given = at.isNotNull() & F.col(lead).isNotNull()
        for kind, moment in (
            ("late", F.when(given, at)),
            ("early", F.when(given & early, at)),
        ):
            aggregates.append(F.max(moment).alias(f"{kind}_{lead}"))
            aggregates += [F.max_by(c, moment).alias(f"{kind}_{lead}_{c}") for c in group]
    summary = df.groupBy(key, here.alias(SEGMENT)).agg(*aggregates)

    carried_columns = [c for group in carry for c in group]
    types = {f.name: f.dataType for f in df.schema.fields}
    by_segment = Window.partitionBy(key).orderBy(SEGMENT)

    def latest(kind: str, group: Sequence[str], until: int) -> Column:
        lead = group[0]
        row = F.struct(
            F.col(f"{kind}_{lead}").alias(time),
            *(
                (F.col(f"{kind}_{lead}_{c}") if c in group else F.lit(None).cast(types[c])).alias(c)
                for c in carried_columns
            ),
        )
        frame = by_segment.rangeBetween(Window.unboundedPreceding, until)
        return F.max(F.when(F.col(f"{kind}_{lead}").isNotNull(), row)).over(frame)

    found = {
        f"_before_{g[0]}": F.greatest(latest("late", g, -2), latest("early", g, -1)) for g in carry
    }
    return (
        summary.withColumns(found)
        .select(key, SEGMENT, F.explode(F.array(*found)).alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select(key, SEGMENT, F.lit(False).alias(OWN), "_row.*")
    )
