"""Putting several series together: proximity, alignment, staged rules, repeated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.columns import one_of, rows_or_error
from wardline.operators.segments import own_rows, segment_window, segmented


def near_event(
    df: DataFrame,
    key: str,
    time: str,
    *,
    flag: Column,
    minutes: int,
    name: str,
    width: int | None = None,
) -> DataFrame:
    """Add whether a row with ``flag`` lies within ``minutes`` on either side.

    ``df`` has one row per (key, minute).
    """
    rows = segmented(df, key, time, back=minutes, ahead=minutes, width=width)
    around = segment_window(key, time).rangeBetween(-minutes, minutes)
    near = F.coalesce(F.max(flag).over(around), F.lit(False))
    return own_rows(rows.withColumn(name, near))


_SERIES = "_series"


def stack_series(keys: Sequence[str], series: Sequence[DataFrame]) -> DataFrame:
    """All rows of several series under one another, each with its own columns filled.

    Rows with a NULL in the keys are left out.
    """
    dated = [
        s.dropna(subset=list(keys)).withColumn(_SERIES, F.lit(1 << i)) for i, s in enumerate(series)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dated)


def merge_rows(stacked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the values that the stacked rows of that key hold.

    A series that repeats a key is an error, as no single row would be right.
    """
    merged = stacked.groupBy(*keys).agg(
        *(F.max(c).alias(c) for c in stacked.columns if c not in (*keys, _SERIES)),
        (F.count(_SERIES) > F.bit_count(F.bit_or(_SERIES))).alias("_repeated"),
    )
    return merged.filter(
        rows_or_error("_repeated", F.lit(True), "a series has several rows at one key", keys)
    ).drop("_repeated")


def align_series(keys: Sequence[str], series: Sequence[DataFrame], *, repeats: str = "error") -> DataFrame:
    """One row per key that occurs in any of the series, with the columns of all.

    Each series has at most one row per key and columns of its own. A union and one
    aggregation replace a spine of distinct keys and a join per series, so every
    series is read and shuffled once. A repeated key is an error; with ``repeats="rows"`` each of its rows meets
    each of the other series' rows of that key.
    """
    if one_of(repeats, "error", "rows") == "rows":
        return repeat_rows(counted_series(keys, series), COPIES)
    return merge_rows(stack_series(keys, series), keys)


COPIES = "_copies"


def counted_series(keys: Sequence[str], series: Sequence[DataFrame]) -> DataFrame:
    """The different rows that aligned series with repeated keys have, and how often each is there.

    Equal rows of a series are counted before anything is joined, so only different ones meet, and
    the counts are multiplied.
    """
    counts = [
        s.dropna(subset=list(keys)).groupBy(*s.columns).agg(F.count("*").alias(f"_times_{i}"))
        for i, s in enumerate(series)
    ]
    rows = reduce(DataFrame.unionByName, [c.select(*keys) for c in counts]).distinct()
    for c in counts:
        rows = rows.join(c, list(keys), "left")
    times = [f"_times_{i}" for i in range(len(series))]
    product = reduce(lambda a, b: a * b, (F.coalesce(c, F.lit(1).cast("long")) for c in times))
    return rows.withColumn(COPIES, product).drop(*times)


def stage_cascade(rules: Sequence[tuple[Column, int | None]], otherwise: int | None) -> Column:
    """The stage of the first rule that holds."""
    (condition, stage), *rest = rules
    chain = F.when(condition, F.lit(stage))
    for condition, stage in rest:
        chain = chain.when(condition, F.lit(stage))
    return chain.otherwise(F.lit(otherwise)).cast("int")


def repeat_rows(df: DataFrame, copies: str, *, block: int = 1_000) -> DataFrame:
    """Each row ``copies`` times, without the ``copies`` column.

    Rows are first cut into blocks, so that the copies of one row are not built in one array.
    """
    columns = [c for c in df.columns if c != copies]
    one = F.lit(1).cast("long")
    blocks = df.filter(F.col(copies) > 0).withColumn(
        "_block", F.explode(F.sequence(one, F.ceil(F.col(copies) / block)))
    )
    size = F.least(F.lit(block).cast("long"), F.col(copies) - (F.col("_block") - 1) * block)
    return blocks.withColumn("_copy", F.explode(F.sequence(one, size))).select(*columns)
