"""All derived tables from the source tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from inspect import signature

from pyspark.sql import DataFrame

from wardline.plans.creatinine import kdigo_creatinine
from wardline.plans.dialysis import dialysis_events
from wardline.plans.mcs import mcs_events
from wardline.plans.stages import kdigo_stages
from wardline.plans.urine_output import urine_output
from wardline.plans.urine_rate import kdigo_uo
from wardline.plans.weight_durations import weight_durations

#: Each derived table with the plan that makes it and the tables that plan takes by name.
PLANS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "mcs_events": (mcs_events, ("treatment", "nursecharting", "nurseassessment", "diagnosis")),
    "dialysis_events": (
        dialysis_events,
        (
            "treatment",
            "nurseassessment",
            "intakeoutput",
            "diagnosis",
            "pasthistory",
            "admissiondx",
        ),
    ),
    "urine_output": (urine_output, ("intakeoutput",)),
    "weight_durations": (
        weight_durations,
        ("patient", "infusiondrug", "physicalexam", "intakeoutput"),
    ),
    "kdigo_creatinine": (kdigo_creatinine, ("patient", "lab")),
    "kdigo_uo": (kdigo_uo, ("urine_output", "patient", "weight_durations")),
    "kdigo_stages": (
        kdigo_stages,
        ("patient", "kdigo_creatinine", "kdigo_uo", "dialysis_events"),
    ),
}


def source_names(name: str) -> set[str]:
    """The source tables a derived table is made from."""
    if name not in PLANS:
        return {name}
    return set().union(*(source_names(n) for n in PLANS[name][1]))


#: Derived tables that some plan reads more than once.
READ_TWICE = {"urine_output", "weight_durations", "dialysis_events"}


def derive(
    name: str,
    sources: Mapping[str, DataFrame],
    *,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
    repeats: str = "error",
    **options: bool | str,
) -> DataFrame:
    """A derived table, made from the source tables in one plan.

    ``sources`` may already hold derived tables it is made from; they are then taken from
    there. ``store``, such as ``store_in(folder)``, is given each table on the way that is
    read more than once, and hands back one that reads what it stored. ``repeats`` goes to every plan on the way that
    knows it; weights are made of stays listed once in any case.
    """
    if name not in PLANS:
        raise ValueError(f"no table {name!r}; there are {', '.join(PLANS)}")
    plan, inputs = PLANS[name]
    tables = {}
    for n in inputs:
        tables[n] = sources[n] if n in sources else derive(n, sources, store=store, repeats=repeats)
        if store is not None and n not in sources and n in READ_TWICE:
            tables[n] = store(tables[n], n)
    if "repeats" in signature(plan).parameters:
        options["repeats"] = repeats
    return plan(**tables, **options)
