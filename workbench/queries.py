"""Named queries over the test tables: the seven plans and each operator by itself."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.columns import (
    event_time,
    first_number,
    kilograms,
    rounded_rate,
    text_rule,
)
from wardline.functions.sums import exact, exact_sums
from wardline.operators.intervals import interval_lookup, validity_intervals
from wardline.operators.labels import label_events
from wardline.operators.series import Trailing, observed_gap, trailing, trailing_sums
from wardline.operators.staging import align_series, near_event
from wardline.plans.creatinine import kdigo_creatinine as creatinine_plan
from wardline.plans.derive import derive, source_names
from wardline.plans.stages import creatinine_stage
from wardline.plans.stages import kdigo_stages as stages_plan
from wardline.plans.urine_rate import kdigo_uo as uo_plan
from wardline.plans.weight_durations import admit_offset
from workbench.adapters import events, sources, table

Query = Callable[[SparkSession, str], DataFrame]

# --- The seven plans --------------------------------------------------------------------


def _derived(name: str, **options: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return derive(name, sources(spark, sf_dir, *sorted(source_names(name))), **options)

    return query


mcs_events = _derived("mcs_events")
dialysis_events = _derived("dialysis_events")
urine_output = _derived("urine_output")
weight_durations = _derived("weight_durations")
kdigo_creatinine = _derived("kdigo_creatinine")
kdigo_uo = _derived("kdigo_uo")
kdigo_stages = _derived("kdigo_stages")
kdigo_stages_normalized = _derived("kdigo_stages", normalize_labels=True)


# --- The plans over tables that repeat stays, offsets and intervals -------------------------


def _twice(patient: DataFrame) -> DataFrame:
    """Every fifth stay is listed again, with another hospital stay and discharge."""
    again = patient.filter(F.col("patientunitstayid") % 5 == 0).withColumns(
        {
            "patienthealthsystemstayid": F.col("patienthealthsystemstayid") + 1000,
            "unitdischargeoffset": F.lit(15000).cast("long"),
        }
    )
    return patient.unionByName(again)


def _repeated(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Derived tables, of which some have rows at one offset or intervals that overlap."""
    tables = sources(spark, sf_dir, *sorted(set().union(*(source_names(n) for n in names))))
    made = {"patient": tables["patient"]} | {n: derive(n, tables) for n in names if n not in tables}
    stay = F.col("patientunitstayid")
    if "urine_output" in made:
        urine = made["urine_output"]
        more = urine.filter(F.col("chartoffset").isNull() | (F.col("chartoffset") % 3 == 0))
        made["urine_output"] = urine.unionByName(more.withColumn("urineoutput", F.col("urineoutput") * 0.5))
    if "weight_durations" in made:
        weights = made["weight_durations"]
        wider = weights.filter(stay % 2 == 0).withColumns(
            {
                "startoffset": F.col("startoffset") - 400,
                "endoffset": F.when(stay % 4 == 0, F.col("endoffset") + 900),
                "weight": F.col("weight") + 7,
            }
        )
        made["weight_durations"] = weights.unionByName(wider)
    return made


def kdigo_creatinine_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sources(spark, sf_dir, "patient", "lab")
    return creatinine_plan(_twice(tables["patient"]), tables["lab"], repeats="rows")


def kdigo_uo_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _repeated(spark, sf_dir, "patient", "urine_output", "weight_durations")
    return uo_plan(made["urine_output"], _twice(made["patient"]), made["weight_durations"], repeats="rows")


def kdigo_stages_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _repeated(spark, sf_dir, "patient", "lab", "urine_output", "weight_durations", "dialysis_events")
    patient = _twice(made["patient"])
    return stages_plan(
        patient,
        kdigo_creatinine_repeats(spark, sf_dir),
        uo_plan(made["urine_output"], patient, made["weight_durations"], repeats="rows"),
        made["dialysis_events"],
        repeats="rows",
    )


# --- Single operators -------------------------------------------------------------------


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and minute: summed and mean event value."""
    rows = exact_sums(
        events(spark, sf_dir), [F.col("sid").alias("user_id"), "off"], {"total": F.col("v")}, {"values": F.count("v")}
    )
    return rows.select("user_id", "off", "total", (F.col("total") / F.col("values")).alias("mean_value"))


def _lows(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.min("mean_value")
    return trailing(
        _series(spark, sf_dir).drop("total"),
        "user_id",
        "off",
        {
            "low_48hr": Trailing(low, 2880, include_current=False),
            "low_7day": Trailing(low, 10080, include_current=False),
        },
    )


def _sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trailing_sums(
        _series(spark, sf_dir).select("user_id", "off", "total"),
        "user_id",
        "off",
        "total",
        {f"sum_{h}hr": 60 * h for h in (6, 12, 24)},
    ).drop("total")


def trailing_min_excl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lows(spark, sf_dir)


def trailing_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(spark, sf_dir)


def trailing_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trailing(
        _series(spark, sf_dir).select("user_id", "off", "mean_value"),
        "user_id",
        "off",
        {"high_6hr": Trailing(F.max("mean_value"), 360)},
    )


def gap_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = events(spark, sf_dir).select(F.col("sid").alias("user_id"), "off").distinct()
    return observed_gap(moments, "user_id", "off", name="gap_minutes", first=60)


def gap_lag_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a user, several of which lie in one minute."""
    moments = events(spark, sf_dir).select(F.col("sid").alias("user_id"), F.floor(F.col("off") / 20).alias("at"), "v")
    return observed_gap(moments, "user_id", "at", name="gap", first=60, ties="rows", ties_by=["v"])


def _signup_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user signed up with, valid until the next signup."""
    starts = (
        events(spark, sf_dir)
        .filter(F.col("et") == "signup")
        .groupBy(F.col("sid").alias("patientunitstayid"), "off")
        .agg(F.max("v").alias("v"))
    )
    patient = sources(spark, sf_dir, "patient")["patient"]
    bounds = patient.select(
        "patientunitstayid", admit_offset(patient).alias("admit"), "unitdischargeoffset"
    )
    return validity_intervals(
        starts,
        bounds,
        "patientunitstayid",
        "off",
        opening="admit",
        closing="unitdischargeoffset",
        margin=120,
        payload=["v"],
    ).withColumnRenamed("patientunitstayid", "user_id")


def interval_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signup_intervals(spark, sf_dir)


def interval_lookup_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = (
        events(spark, sf_dir)
        .filter(F.col("et") == "click")
        .groupBy(F.col("sid").alias("user_id"), "off")
        .agg(F.count("*").alias("clicks"))
    )
    return interval_lookup(
        clicks,
        _signup_intervals(spark, sf_dir),
        "user_id",
        "off",
        start="startoffset",
        end="endoffset",
        values=["v"],
    )


def interval_join_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with what holds of several overlapping spans after signups and errors, some without an end."""
    ev = events(spark, sf_dir)
    off, k = F.col("off"), F.col("k")
    spans = ev.filter(F.col("et").isin("signup", "error")).select(
        F.col("sid").alias("user_id"),
        off.alias("startoffset"),
        F.when(k % 10 != 0, off + k * k).alias("endoffset"),
        "v",
    )
    clicks = ev.filter(F.col("et") == "click").select(F.col("sid").alias("user_id"), "off", "k")
    return interval_lookup(
        clicks, spans, "user_id", "off", start="startoffset", end="endoffset", values=["v"], overlaps="rows"
    )


def near_event_or_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks within 12 hours of an error, and all clicks of users who never signed up."""
    ev = events(spark, sf_dir).withColumnRenamed("sid", "user_id")
    per_minute = (
        ev.filter(F.col("et").isin("click", "error"))
        .groupBy("user_id", "off")
        .agg(
            F.count_if(F.col("et") == "click").alias("clicks"),
            F.count_if(F.col("et") == "error").alias("errors"),
        )
    )
    signed_up = (
        ev.filter(F.col("et") == "signup")
        .select("user_id")
        .distinct()
        .withColumn("_signed_up", F.lit(True))
    )
    near = near_event(
        per_minute, "user_id", "off", flag=F.col("errors") > 0, minutes=720, name="_near"
    ).filter("clicks > 0")
    return (
        near.join(signed_up, "user_id", "left")
        .filter("_near OR _signed_up IS NULL")
        .select("user_id", "off", "clicks")
    )


PRIORITY_LABELS = (
    ("1-URGENT", "rush"),
    ("1-URGENT", "expedite"),
    ("2-HIGH", "rush"),
    ("3-MEDIUM", None),
)


def label_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_events(
        table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITY_LABELS, "label"
    ).select("o_orderkey", "o_orderpriority", "label")


PART_RULE = {
    "prefix": "STANDARD|",
    "exactly": ("STANDARD|red ring", "STANDARD|blue rod", "PROMO|red ring"),
    "starts": "STANDARD|small",
    "without": ("an", "ri"),
    "like": ("STANDARD|%old%gear%", "STANDARD|large w%"),
}


def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("|", "p_type", "p_name").alias("path")
    )
    return paths.withColumn("included", text_rule("path", **PART_RULE).cast("int"))


def case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = table(spark, sf_dir, "part").select(
        "p_partkey", F.initcap("p_name").alias("name"), F.lower("p_type").alias("kind")
    )
    wanted = (F.lower("name") == "red ring") | F.upper("kind").isin("PROMO", "SMALL")
    return mixed.filter(wanted)


def regex_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first number in a free text; user 7k's texts hold none."""
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 7 == 0, F.col("event_type"))
        .otherwise(F.concat(F.lit("wt "), F.col("props"), F.lit("."), F.col("event_id"), F.lit(" kg 9.5")))
        .alias("note"),
        "props",
    )
    return texts.select(
        "event_id", first_number("note").alias("note_number"), first_number("props").alias("k")
    )


def unit_convert_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = events(spark, sf_dir).select(
        F.col("sid").alias("user_id"),
        "off",
        kilograms(F.col("v"), F.col("k") % 2 == 1).alias("weight"),
    )
    return weighed.filter(F.col("weight").between(20, 1000))


def coalesce_offsets_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct pairs of offsets first, one offset chosen after, so offsets may repeat.

    Only rows with an amount other than zero count; signups have none.
    """
    off, k = F.col("off"), F.col("k")
    pairs = events(spark, sf_dir).select(
        F.col("sid").alias("user_id"),
        F.when(F.col("et") != "error", F.floor(off / 60)).alias("documented"),
        F.floor((off + k) / 60).alias("entered"),
        F.when(F.col("et") != "signup", k).alias("amount"),
    )
    return (
        pairs.filter(F.col("amount") != 0)
        .select("user_id", "documented", "entered")
        .distinct()
        .select("user_id", event_time("documented", "entered").alias("hour"))
    )


def group_sum_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    sums = exact_sums(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"sum_qty": F.col("l_quantity"), "sum_price": price},
        {"prices": F.count(price)},
    )
    return sums.withColumn("avg_price", F.col("sum_price") / F.col("prices")).drop("prices")


def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers with a balance, and whether the customer ever had a status F."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    known = (
        table(spark, sf_dir, "customer").filter(F.col("c_acctbal").isNotNull()).select("c_custkey")
    )
    status_f = orders.filter(F.col("o_orderstatus") == "F").select("c_custkey").distinct()
    ever = known.join(status_f, "c_custkey", "left_semi").withColumn("ever_f", F.lit(1))
    customers = known.join(ever, "c_custkey", "left").fillna(0, ["ever_f"])
    return orders.join(customers, "c_custkey").select("o_orderkey", "c_custkey", "ever_f")


def align_three_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)

    def one(kind: str) -> DataFrame:
        keys = [F.col("sid").alias("user_id"), "off"]
        return exact_sums(ev.filter(F.col("et") == kind), keys, {f"{kind}_value": F.col("v")})

    return align_series(["user_id", "off"], [one("click"), one("error"), one("view")])


def align_series_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of three kinds by user and hour, without adding up those of one hour."""
    ev = events(spark, sf_dir).filter(F.col("k") < 40)

    def one(kind: str) -> DataFrame:
        hour = F.floor(F.col("off") / 60).alias("hour")
        rows = ev.filter(F.col("et") == kind).select(F.col("sid").alias("user_id"), hour, F.col("k").alias(f"{kind}_k"))
        return rows.unionByName(rows.filter(F.col(f"{kind}_k") % 4 == 0))

    return align_series(["user_id", "hour"], [one("click"), one("error"), one("view")], repeats="rows")


def stage_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    lows = _lows(spark, sf_dir)
    stage = creatinine_stage(F.col("mean_value"), F.col("low_7day"), F.col("low_48hr"))
    return lows.select("user_id", "off", stage.alias("stage"))


def creatinine_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of labs charted as decimals, where a rise of exactly 0.3 is one."""
    tenths = F.max("k").cast("decimal(6,0)") + 5
    lab = (
        events(spark, sf_dir)
        .filter(F.col("et") == "view")
        .groupBy(F.col("sid").alias("patientunitstayid"), F.col("off").alias("labresultoffset"))
        .agg((tenths * F.lit(Decimal("0.1"))).alias("labresult"))
        .withColumn("labname", F.lit("creatinine"))
    )
    rows = creatinine_plan(sources(spark, sf_dir, "patient")["patient"], lab)
    stage = creatinine_stage(*(F.col(c) for c in ("creat", "creat_low_past_7day", "creat_low_past_48hr")))
    return rows.select(
        "patientunitstayid", "labresultoffset", (F.col("creat") * 10).cast("long").alias("tenths"), stage.alias("stage")
    )


def guarded_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value per unit and hour, only where both are positive."""
    span = F.abs(F.col("off") % 1440)
    weight = (F.col("user_id") % 50).cast("double")
    rate = rounded_rate(F.col("sum_24hr"), weight, span / F.lit(60.0))
    return _sums(spark, sf_dir).select(
        "user_id", "off", F.when((weight > 0) & (span >= 360), rate).alias("rate")
    )


def project_const_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return (
        customers.filter((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") >= 5000))
        .select(
            F.col("c_custkey").alias("patientunitstayid"),
            exact(F.col("c_acctbal")).cast("double").alias("balance"),
            F.lit("admit").alias("weight_type"),
        )
        .orderBy("patientunitstayid", "balance")
    )


QUERIES: dict[str, Query] = {
    "q1_mcs_events": mcs_events,
    "q2_dialysis_events": dialysis_events,
    "q3_urine_output": urine_output,
    "q4_weight_durations": weight_durations,
    "q5_kdigo_creatinine": kdigo_creatinine,
    "q6_kdigo_uo": kdigo_uo,
    "q7_kdigo_stages": kdigo_stages,
    "q7_kdigo_stages_normalized": kdigo_stages_normalized,
    "q5_kdigo_creatinine_repeats": kdigo_creatinine_repeats,
    "q6_kdigo_uo_repeats": kdigo_uo_repeats,
    "q7_kdigo_stages_repeats": kdigo_stages_repeats,
    "trailing_min_excl": trailing_min_excl,
    "trailing_sum": trailing_sum,
    "trailing_max": trailing_max,
    "gap_lag": gap_lag,
    "gap_lag_ties": gap_lag_ties,
    "interval_build": interval_build,
    "interval_lookup": interval_lookup_clicks,
    "interval_join": interval_join_clicks,
    "near_event_or_absent": near_event_or_absent,
    "label_exact": label_exact,
    "text_rules": text_rules,
    "case_insensitive": case_insensitive,
    "regex_number": regex_number,
    "unit_convert_bounds": unit_convert_bounds,
    "coalesce_offsets_distinct": coalesce_offsets_distinct,
    "group_sum_avg": group_sum_avg,
    "semi_join": semi_join,
    "align_series": align_three_series,
    "align_series_repeats": align_series_repeats,
    "stage_cascade": stage_cascade,
    "creatinine_decimal": creatinine_decimal,
    "guarded_rate": guarded_rate,
    "project_const_sort": project_const_sort,
}
