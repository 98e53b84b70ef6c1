"""Dialysis events by modality, acuity, access and output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import vocab
from wardline.functions.columns import event_time
from wardline.operators.labels import Vocabulary, label_events
from wardline.schemas import STAY

_TYPE = "dialysis_type"


def dialysis_events(
    treatment: DataFrame,
    nurseassessment: DataFrame,
    intakeoutput: DataFrame,
    diagnosis: DataFrame,
    pasthistory: DataFrame,
    admissiondx: DataFrame,
) -> DataFrame:
    """One row per charted event; the type is NULL for one diagnosis string."""

    def events(df: DataFrame, value: str, vocabulary: Vocabulary, offset: Column) -> DataFrame:
        labelled = label_events(df, value, vocabulary, _TYPE)
        return labelled.select(STAY, offset.alias("chartoffset"), _TYPE)

    legs = [
        events(
            treatment, "treatmentstring", vocab.DIALYSIS_TREATMENT, F.col("treatmentoffset")
        ),
        events(
            nurseassessment,
            "celllabel",
            vocab.DIALYSIS_ASSESSMENT_CELL,
            event_time("nurseassessoffset", "nurseassessentryoffset"),
        ),
        _dialysis_output(intakeoutput),
        events(
            diagnosis, "diagnosisstring", vocab.DIALYSIS_DIAGNOSIS, F.col("diagnosisoffset")
        ),
        events(
            pasthistory,
            "pasthistorypath",
            vocab.DIALYSIS_PAST_HISTORY,
            event_time("pasthistoryoffset", "pasthistoryenteredoffset"),
        ),
        events(
            admissiondx,
            "admitdxpath",
            vocab.DIALYSIS_ADMISSION,
            F.col("admitdxenteredoffset"),
        ),
    ]
    return reduce(DataFrame.unionByName, legs)


def _dialysis_output(intakeoutput: DataFrame) -> DataFrame:
    """Charted dialysis volumes, once per pair of offsets.

    The pair is made distinct before one offset is chosen, so an offset may occur
    twice when it was entered at two times.
    """
    documented, entered = "intakeoutputoffset", "intakeoutputentryoffset"
    return (
        intakeoutput.filter(F.col("dialysistotal") != 0)
        .select(STAY, documented, entered)
        .distinct()
        .select(
            STAY,
            event_time(documented, entered).alias("chartoffset"),
            F.lit(vocab.DIALYSIS_OUTPUT).alias(_TYPE),
        )
    )
