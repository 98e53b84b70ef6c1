"""Body-weight validity intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import vocab
from wardline.functions.columns import first_number, kilograms, rows_or_error
from wardline.operators.segments import SEGMENT, segment_of, segment_width
from wardline.operators.staging import repeat_rows
from wardline.schemas import STAY

LOWEST, HIGHEST = 20, 1000
MARGIN = 120
ADMIT, DAILY = "admit", "daily"


def admit_offset(patient: DataFrame) -> Column:
    """The unit admission offset; the column is optional and defaults to 0."""
    if "unitadmitoffset" not in patient.columns:
        return F.lit(0).cast("long")
    return F.coalesce(F.col("unitadmitoffset"), F.lit(0).cast("long"))


def weight_records(
    patient: DataFrame, infusiondrug: DataFrame, physicalexam: DataFrame, intakeoutput: DataFrame
) -> DataFrame:
    """All charted weights within the plausible range, from five sources."""

    def records(df: DataFrame, offset: Column, weight: Column, kind: Column) -> DataFrame:
        return df.select(
            STAY, offset.alias("chartoffset"), weight.alias("weight"), kind.alias("weight_type")
        )

    daily = F.lit(DAILY)
    path = F.col("physicalexampath")
    cell = F.upper("celllabel")
    sources = [
        records(
            patient,
            admit_offset(patient),
            F.col("admissionweight").try_cast("double"),
            F.lit(ADMIT),
        ),
        records(
            patient,
            F.col("unitdischargeoffset"),
            F.col("dischargeweight").try_cast("double"),
            daily,
        ),
        records(
            infusiondrug,
            F.col("drugstartoffset"),
            F.col("patientweight").try_cast("double"),
            daily,
        ),
        records(
            physicalexam.filter(
                path.isin(vocab.EXAM_WEIGHT_CURRENT, vocab.EXAM_WEIGHT_ADMISSION)
            ),
            F.col("physicalexamoffset"),
            first_number("physicalexamtext"),
            F.when(path == vocab.EXAM_WEIGHT_ADMISSION, F.lit(ADMIT)).otherwise(daily),
        ),
        records(
            intakeoutput.filter(cell.isin(vocab.WEIGHT_CELL_KG, vocab.WEIGHT_CELL_LB)),
            F.col("intakeoutputoffset"),
            kilograms(
                F.col("cellvaluenumeric").cast("double"), cell == vocab.WEIGHT_CELL_LB
            ),
            daily,
        ),
    ]
    return reduce(DataFrame.unionByName, sources).filter(
        F.col("weight").between(LOWEST, HIGHEST)
        & F.col("chartoffset").isNotNull()
        & F.col(STAY).isNotNull()
    )


def weight_durations(
    patient: DataFrame,
    infusiondrug: DataFrame,
    physicalexam: DataFrame,
    intakeoutput: DataFrame,
    *,
    ordered: bool = False,
    width: int | None = None,
) -> DataFrame:
    """One interval per charted weight, and one from admission to the first weight.

    Weights charted at one offset are taken in the order (weight_type, weight): all but
    the last of them get an interval of length zero. A stay listed twice is an error.

    What a stay is, its first admission weight and its charted weights travel as rows of one table, so one
    layout by (stay, segment) serves the order of the weights and the edges of the segments; only those, a row a
    segment, are then laid out by stay.
    """
    records = weight_records(patient, infusiondrug, physicalexam, intakeoutput)
    rows = _counted(records, _per_stay(records, patient), width or segment_width())
    in_order = Window.partitionBy(STAY, SEGMENT).orderBy("startoffset", "weight_type", "weight")
    placed = rows.repartition(STAY, SEGMENT).withColumns(
        {"_next": F.lead("startoffset").over(in_order), "_place": F.row_number().over(in_order)}
    )

    # Where the next segment of a stay begins; the row of a stay that holds no weight is in the last segment.
    by_segment = Window.partitionBy(STAY).orderBy(SEGMENT)
    whole_stay = by_segment.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # naming all columns in both branches keeps them on one layout, which is then made once
    edges = placed.filter((F.col("_place") == 1) & (F.col("copies") >= 0)).select(
        STAY,
        SEGMENT,
        F.lead("startoffset").over(by_segment).alias("_next_head"),
        F.lag("startoffset").over(by_segment).isNull().alias("_opens_stay"),
        F.max("admitoffset").over(whole_stay).alias("_open"),
        F.max("unitdischargeoffset").over(whole_stay).alias("_close"),
    )
    start = F.col("startoffset")
    of_weights = F.col("admitoffset").isNull() & F.col("unitdischargeoffset").isNull() & (F.col("copies") > 0)
    chained = placed.filter(of_weights).drop("admitoffset", "unitdischargeoffset")
    joined = chained.join(edges.filter(F.col("_open").isNotNull()), [STAY, SEGMENT])
    end = F.coalesce("_next", "_next_head", F.coalesce("_close", start) + MARGIN)

    def interval(first: Column, last: Column, copies: Column) -> Column:
        return F.struct(first.alias("startoffset"), last.alias("endoffset"), copies.alias("copies"))

    one = F.lit(1).cast("long")
    before = F.col("_opens_stay") & (F.col("_place") == 1) & (F.col("_open") < start)
    intervals = [
        interval(start, end, one),
        F.when(F.col("copies") > 1, interval(start, start, F.col("copies") - 1)),
        F.when(before, interval(F.col("_open") - MARGIN, start, one)),
    ]
    result = repeat_rows(
        joined.select(
            STAY, F.explode(F.array_compact(F.array(*intervals))).alias("_span"), "weight", "weight_type"
        ).select(STAY, "_span.*", "weight", "weight_type"),
        "copies",
    )
    return result.orderBy(STAY, "startoffset") if ordered else result


#: The first of some (offset, weight) is found as the least decimal offset * 1024 + weight, as weights are below 1024:
#: a number keeps the aggregation in its hash table, which a pair would not.
_PACKED, _RADIX = "decimal(37,17)", 1024


def _per_stay(records: DataFrame, patient: DataFrame) -> DataFrame:
    """One row per listed stay: admission, discharge, and its first admission weight if there is one."""
    packed = (F.col("chartoffset") * _RADIX).cast(_PACKED) + F.col("weight").cast(_PACKED)
    admits = records.filter(F.col("weight_type") == ADMIT).select(STAY, packed.cast(_PACKED).alias("_first"))
    listed = patient.filter(F.col(STAY).isNotNull()).select(
        STAY,
        admit_offset(patient).alias("admitoffset"),
        F.col("unitdischargeoffset").cast("long").alias("unitdischargeoffset"),
    )
    both = listed.unionByName(admits, allowMissingColumns=True)
    found = both.groupBy(STAY).agg(
        F.max("admitoffset").alias("admitoffset"),
        F.max("unitdischargeoffset").alias("unitdischargeoffset"),
        F.min("_first").alias("_first"),
        (F.count("admitoffset") > 1).alias("_repeated"),
    )
    wanted = F.col("admitoffset").isNotNull()
    once = found.filter(rows_or_error("_repeated", wanted, "patient lists a stay more than once", [STAY]))
    first = F.floor(F.col("_first") / F.lit(_RADIX)).cast("long")
    return once.select(
        STAY,
        "admitoffset",
        "unitdischargeoffset",
        first.alias("first_offset"),
        (F.col("_first") - (first * _RADIX).cast(_PACKED)).cast("double").alias("first_weight"),
    )


def _counted(records: DataFrame, per_stay: DataFrame, width: int) -> DataFrame:
    """How often each (stay, start, type, weight) occurs, equal records counted map-side, and a row for each stay.

    One copy of the first admission weight of a stay counts from before admission
    instead of from its own offset.
    """
    kind = "struct<startoffset: bigint, copies: bigint, weight_type: string, weight: double, admitoffset: bigint, unitdischargeoffset: bigint>"

    def row(start: Column, copies: int, weight: Column, *of_stay: str) -> Column:
        given = {"startoffset": start, "copies": F.lit(copies), "weight_type": F.lit(ADMIT), "weight": weight}
        given |= {c: F.col(c) if c in of_stay else F.lit(None) for c in ("admitoffset", "unitdischargeoffset")}
        return F.struct(*(c.alias(n) for n, c in given.items())).cast(kind)

    weight, none = F.col("first_weight"), F.lit(None)
    moved = F.array(
        row(F.col("admitoffset") - MARGIN, 1, weight),
        row(F.col("first_offset"), -1, weight),
        row(none, 0, none, "admitoffset", "unitdischargeoffset"),
    )
    stay_only = F.array(row(none, 0, none, "admitoffset", "unitdischargeoffset"))
    of_stays = per_stay.select(
        STAY, F.explode(F.when(F.col("first_offset").isNull(), stay_only).otherwise(moved)).alias("_row")
    ).select(STAY, "_row.*")
    charted = records.select(
        STAY,
        F.col("chartoffset").cast("long").alias("startoffset"),
        F.lit(1).cast("long").alias("copies"),
        "weight_type",
        "weight",
    )
    return (
        charted.unionByName(of_stays, allowMissingColumns=True)
        .withColumn(SEGMENT, segment_of(F.col("startoffset"), width))
        .groupBy(STAY, SEGMENT, "startoffset", "weight_type", "weight")
        .agg(
            F.sum("copies").alias("copies"),
            F.max("admitoffset").alias("admitoffset"),
            F.max("unitdischargeoffset").alias("unitdischargeoffset"),
        )
        .filter((F.col("copies") > 0) | F.col("startoffset").isNull())
    )
