"""Column expressions shared by the plans. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.functions.sums import checked_sum, exact, exact_sum  # noqa: F401
from wardline.vocab import KILOGRAMS_PER_POUND


def one_of(choice: str, *choices: str) -> str:
    if choice not in choices:
        raise ValueError(f"{choice!r} is none of {', '.join(choices)}")
    return choice


def event_time(documented: str, entered: str) -> Column:
    """The documented offset, or the entry offset where it is missing."""
    return F.coalesce(F.col(documented), F.col(entered))


def rows_or_error(broken: str, wanted: Column, message: str, key: Sequence[str]) -> Column:
    """As a filter: the wanted rows, unless a precondition is broken; then an error that names the key.

    One expression, so that no filter for the wanted rows alone goes before the check.
    """
    shown = [F.concat(F.lit(f"{c} "), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in key]
    error = F.raise_error(F.concat(F.lit(f"{message}: "), F.concat_ws(", ", *shown))).cast("boolean")
    return F.when(F.col(broken), error).otherwise(F.coalesce(wanted, F.lit(False)))


def first_number(text: str) -> Column:
    """The first unsigned number anywhere in a text, NULL if it has none."""
    found = F.regexp_extract(F.col(text), r"([0-9]+(?:\.[0-9]+)?)", 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def kilograms(value: Column, is_pounds: Column) -> Column:
    return F.when(is_pounds, value * F.lit(KILOGRAMS_PER_POUND)).otherwise(value)


def rounded_rate(volume: Column, weight: Column, hours: Column) -> Column:
    """ml/kg/h to four places, rounded as a decimal so that halves go up."""
    return F.round((volume / weight / hours).cast("decimal(28,12)"), 4).cast("double")


def text_rule(
    path: str,
    *,
    prefix: str,
    exactly: Iterable[str] = (),
    starts: str | None = None,
    without: Iterable[str] = (),
    like: Iterable[str] = (),
) -> Column:
    """Whether a path lies under ``prefix`` and meets one of the inclusion rules.

    A path is included if it is listed in ``exactly``, if it begins with ``starts``
    and its lower-cased form holds none of the ``without`` substrings, or if it
    matches one of the ``like`` patterns. A NULL path is not; the first condition is the
    prefix alone, so that as a filter it reaches the file scan.
    """
    value = F.col(path)
    rule = value.isin(list(exactly))
    if starts is not None:
        guarded = value.startswith(starts)
        for part in without:
            guarded = guarded & ~F.lower(value).contains(part)
        rule = rule | guarded
    for pattern in like:
        rule = rule | value.like(pattern)
    return value.isNotNull() & value.startswith(prefix) & rule
