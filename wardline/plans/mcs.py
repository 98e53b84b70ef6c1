"""Mechanical circulatory support events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import vocab
from wardline.functions.columns import event_time
from wardline.operators.labels import Vocabulary, label_events
from wardline.schemas import STAY

_TYPE = "mechanical_support_type"


def mcs_events(
    treatment: DataFrame,
    nursecharting: DataFrame,
    nurseassessment: DataFrame,
    diagnosis: DataFrame,
) -> DataFrame:
    """One row per charted event and label. Needs no shuffle."""

    def events(df: DataFrame, value: str, vocabulary: Vocabulary, offset: Column) -> DataFrame:
        labelled = label_events(df, value, vocabulary, _TYPE)
        return labelled.select(STAY, _TYPE, offset.alias("chartoffset"))

    devices = nurseassessment.filter(F.col("celllabel") == vocab.MCS_ASSESSMENT_CELL)
    return (
        events(treatment, "treatmentstring", vocab.MCS_TREATMENT, F.col("treatmentoffset"))
        .unionByName(
            events(
                nursecharting,
                "nursingchartcelltypevallabel",
                vocab.MCS_NURSE_CHART,
                event_time("nursingchartoffset", "nursingchartentryoffset"),
            )
        )
        .unionByName(
            events(
                devices,
                "cellattributevalue",
                vocab.MCS_ASSESSMENT,
                event_time("nurseassessoffset", "nurseassessentryoffset"),
            )
        )
        .unionByName(
            events(diagnosis, "diagnosisstring", vocab.MCS_DIAGNOSIS, F.col("diagnosisoffset"))
        )
    )
