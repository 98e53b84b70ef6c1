"""Sums of charted numbers that no order of rows, retry or cluster size changes.

A number counts as the decimal it prints as. Nearly all charted numbers have six places or fewer; those are
whole millionths, found and checked in double arithmetic, and are added as longs: three slices of 18 bits for a
group of any size, which are carried once at the end. The few others are added as decimals of 18 places, and what lies
beyond the 18th place (of numbers under 1 only) as decimals of 36. Every part is a built-in SUM, combined map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLION = 1e6
#: A slice of 18 bits can be added 2^45 times.
SLICE = 18
#: Numbers of millionths that doubles hold apart, and that windows of a segment can add in one long.
MOST, MOST_IN_WINDOWS = 1e15, 1e14


def exact(value: Column) -> Column:
    """A charted number as a decimal with 18 places; an error if it has none that keeps its digits.

    That is so for NaN, infinite numbers, 1e20 or more, and digits beyond the 18th place, whatever the ANSI setting.
    """
    number = value.try_cast("decimal(38,18)")
    lost = number.isNull() | (number.cast("double") != value.cast("double"))
    message = F.concat(F.lit("no decimal with 18 places holds "), value.cast("string"))
    return F.when(value.isNotNull() & lost, F.raise_error(message)).otherwise(number)


def _millionths(value: Column) -> Column:
    return F.rint(value * F.lit(MILLION))


def _is_millionths(value: Column, most: float) -> Column:
    """Whether a number is a whole number of millionths: the nearest one, divided again, gives the same double."""
    units = _millionths(value)
    return (F.abs(units) < most) & (units / F.lit(MILLION) == value)


def _places_36(value: Column) -> Column:
    """A number under 1 with 36 places; an error if it has more."""
    number = value.try_cast("decimal(36,36)")
    lost = number.isNull() | (number.cast("double") != value)
    message = F.concat(F.lit("no decimal with 36 places holds "), value.cast("string"))
    return F.when(lost, F.raise_error(message)).otherwise(number)


#: Columns that `with_parts` adds: millionths, or else a decimal of 18 places and what is beyond them.
_PARTS = ("_units_", "_wide_", "_fine_")


def with_parts(df: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Each number as millionths, or else as a decimal of 18 places and what is beyond them; the unused ones are NULL.

    What several columns need is made one step before them, so that it is worked out once.
    """
    decimals = {n for n, c in sums.items() if isinstance(df.select(c).schema[0].dataType, T.DecimalType)}
    shared, columns = {}, {}
    for name, value in sums.items():
        units, wide, fine = (f"{c}{name}" for c in _PARTS)
        if name in decimals:
            columns |= {units: F.lit(None).cast("long"), wide: exact(value), fine: F.lit(None).cast("decimal(38,36)")}
            continue
        value = value.cast("double")
        whole = F.col(f"_whole_{name}")
        small = F.when(~whole & (F.abs(value) < 1), value)
        narrow = F.round(F.col(f"_small_{name}"), 18)
        shared[f"_whole_{name}"] = _is_millionths(value, MOST)
        shared[f"_small_{name}"] = F.when(~_is_millionths(value, MOST) & (F.abs(value) < 1), _places_36(value))
        columns[units] = F.when(whole, _millionths(value).cast("long"))
        columns[wide] = F.when(~whole, F.when(small.isNotNull(), narrow.cast("decimal(38,18)")).otherwise(exact(value)))
        columns[fine] = F.col(f"_small_{name}") - narrow
    return df.withColumns(shared).withColumns(columns).drop(*shared) if shared else df.withColumns(columns)


def exact_sum(value: Column) -> Column:
    """The sum of the numbers as a decimal of 18 places; an error if it does not fit one."""
    return checked_sum(F.sum(exact(value)), F.count(value))


def checked_sum(total: Column, count: Column) -> Column:
    """A sum of decimals, which Spark makes NULL on overflow unless ANSI is on; here an error."""
    lost = total.isNull() & (count > 0)
    return F.when(lost, F.raise_error(F.lit("a sum overflows its decimal"))).otherwise(total)


def exact_sums(
    df: DataFrame,
    keys: Sequence[Column | str],
    sums: Mapping[str, Column],
    others: Mapping[str, Column] | None = None,
) -> DataFrame:
    """`df` grouped by `keys`: the double nearest the sum of each number's decimals, and other aggregates.

    A sum is NULL without a number. NaN, infinite numbers, 1e20 or more, numbers with digits beyond the 36th place, and
    sums of 1e20 or more are errors. A sum is rounded once, but where it is 9 or more and holds digits beyond the 18th place:
    then to 28 places before (to 18 from 1e8 on).
    """
    mask = F.lit((1 << SLICE) - 1)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    aggregates = []
    for name in sums:
        units, wide, fine = (F.col(f"{c}{name}") for c in _PARTS)
        aggregates += [
            F.sum(F.shiftright(units, 2 * SLICE)).alias(f"_high_{name}"),
            F.sum(F.shiftright(units, SLICE).bitwiseAND(mask)).alias(f"_middle_{name}"),
            F.sum(units.bitwiseAND(mask)).alias(f"_low_{name}"),
            F.sum(wide).alias(f"_wide_{name}"),
            F.count(wide).alias(f"_n_wide_{name}"),
            F.sum(fine).alias(f"_fine_{name}"),
        ]
    named = {name: c.alias(name) for name, c in (others or {}).items()}
    added = with_parts(df, sums).groupBy(*keys).agg(*aggregates, *named.values())
    kept = [c for c in added.columns if not c.startswith(_HIDDEN)]

    def digits(name: str, power: int, width: int) -> Column:
        return F.col(f"_{name}").cast("decimal(26,0)") * F.lit(1 << power * SLICE).cast(f"decimal({width},0)")

    carried = {}
    for name in sums:
        units = digits(f"high_{name}", 2, 11) + digits(f"middle_{name}", 1, 6) + digits(f"low_{name}", 0, 1)
        carried[f"_units_{name}"] = units.cast("decimal(32,0)") * F.lit("0.000001").cast("decimal(6,6)")
        carried[f"_wide_{name}"] = checked_sum(F.col(f"_wide_{name}"), F.col(f"_n_wide_{name}"))
    added = added.withColumns(carried)
    rounded = {n: _rounded(F.col(f"_units_{n}"), F.col(f"_wide_{n}"), F.col(f"_fine_{n}")) for n in sums}
    return added.select(*(c for c in kept if c not in named), *(c.alias(n) for n, c in rounded.items()), *named)


_HIDDEN = ("_high_", "_middle_", "_low_", "_wide_", "_n_wide_", "_fine_")


def _rounded(millionths: Column, wide: Column, fine: Column | None = None) -> Column:
    """The double nearest a sum given as a decimal of 6 places, one of 18 and one of 36, each NULL if there is none."""
    zero = F.lit(0).cast("decimal(37,18)")
    both = F.coalesce(millionths.cast("decimal(37,18)"), zero) + F.coalesce(wide.cast("decimal(37,18)"), zero)
    # two decimals of 38 digits would be added with 17 places; so close to the limit no double has any
    large = (F.abs(millionths) >= 1e18) | (F.abs(wide) >= 1e18)
    coarse = F.coalesce(millionths, zero).cast("double") + F.coalesce(wide, zero).cast("double")
    too_large = F.raise_error(F.lit("a sum overflows its decimal")).cast("double")
    slow = F.when(large & (F.abs(coarse) < 1e20), coarse).when(large, too_large)
    if fine is not None:
        exactly = both.cast("decimal(37,36)") + fine.cast("decimal(37,36)")
        nearly = both.cast("decimal(37,28)") + fine.cast("decimal(37,28)")
        slow = slow.when(fine.isNotNull() & (F.abs(both) < 9), exactly.cast("double"))
        slow = slow.when(fine.isNotNull() & (F.abs(both) < 1e8), nearly.cast("double"))
    return F.when(wide.isNull(), millionths.cast("double")).otherwise(slow.otherwise(both.cast("double")))


def window_parts(value: Column) -> dict[str, Column]:
    """Columns for `window_totals`: millionths, or else a decimal of 18 places (an error if that loses digits)."""
    value = value.cast("double")
    whole = _is_millionths(value, MOST_IN_WINDOWS)
    return {
        "_units": F.when(whole, _millionths(value).cast("long")),
        "_wide": F.when(value.isNotNull() & ~whole, exact(value)),
    }


class Running(NamedTuple):
    """A sum or count, and the type that two of them are subtracted in; without any row it is 0."""

    total: Column
    kind: str = "long"


def running(
    rows: DataFrame, time: str, window: WindowSpec, totals: dict[str, Running], minutes: dict[str, int]
) -> DataFrame:
    """Add `<total>_<frame>`: each total over the last minutes of each frame and the row's own.

    It is what was added up to the row less what was before the frame. Both only grow as the window goes on, so n
    rows take n steps, however long the frames are. Rows without a time see one another: they must be in a window of
    their own, as segments have them, in which rows with a time add nothing.
    """
    upto = {"_here": window.rangeBetween(Window.unboundedPreceding, 0)} | {
        f"_before_{frame}": window.rangeBetween(Window.unboundedPreceding, -m - 1) for frame, m in minutes.items()
    }
    sums = {
        f"{t}{at}": F.coalesce(of.total.over(w).cast(of.kind), F.lit(0).cast(of.kind))
        for t, of in totals.items()
        for at, w in upto.items()
    }
    dated = F.col(time).isNotNull()
    frames = {
        f"{t}_{frame}": F.when(dated, F.col(f"{t}_here") - F.col(f"{t}_before_{frame}")).otherwise(F.col(f"{t}_here"))
        for t in totals
        for frame in minutes
    }
    return rows.withColumns(sums).withColumns(frames).drop(*sums)


def window_totals() -> dict[str, Running]:
    """What `running` has to add of the columns of `window_parts`."""
    return {
        "_units": Running(F.sum("_units")),
        "_wide": Running(F.sum("_wide"), "decimal(37,18)"),
        "_numbers": Running(F.count(F.coalesce(F.col("_units").cast("double"), F.col("_wide").cast("double")))),
    }


def window_sum(frame: str) -> Column:
    """The double nearest the sum that `running` found for a frame, NULL without a number."""
    millionths = F.col(f"_units_{frame}").cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")
    wide = F.col(f"_wide_{frame}")
    return F.when(F.col(f"_numbers_{frame}") > 0, _rounded(millionths, F.when(wide != 0, wide)))
