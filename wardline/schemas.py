"""Column names and types of the source and derived tables.

Offsets are whole minutes since unit admission, volumes are millilitres,
weights kilograms unless a column says otherwise.
"""

from __future__ import annotations

from pyspark.sql import types as T

STAY = "patientunitstayid"

_LONG, _DOUBLE, _STRING, _INT = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SOURCES: dict[str, T.StructType] = {
    # One row per stay; every plan relies on patientunitstayid being its key.
    "patient": _table(
        patientunitstayid=_LONG,
        patienthealthsystemstayid=_LONG,
        uniquepid=_STRING,
        unitadmitoffset=_LONG,
        unitdischargeoffset=_LONG,
        admissionweight=_DOUBLE,
        dischargeweight=_DOUBLE,
    ),
    "lab": _table(
        patientunitstayid=_LONG, labname=_STRING, labresult=_DOUBLE, labresultoffset=_LONG
    ),
    "treatment": _table(
        patientunitstayid=_LONG, treatmentoffset=_LONG, treatmentstring=_STRING
    ),
    "nursecharting": _table(
        patientunitstayid=_LONG,
        nursingchartoffset=_LONG,
        nursingchartentryoffset=_LONG,
        nursingchartcelltypevallabel=_STRING,
    ),
    "nurseassessment": _table(
        patientunitstayid=_LONG,
        nurseassessoffset=_LONG,
        nurseassessentryoffset=_LONG,
        celllabel=_STRING,
        cellattributevalue=_STRING,
    ),
    "diagnosis": _table(
        patientunitstayid=_LONG, diagnosisoffset=_LONG, diagnosisstring=_STRING
    ),
    "intakeoutput": _table(
        patientunitstayid=_LONG,
        intakeoutputoffset=_LONG,
        intakeoutputentryoffset=_LONG,
        dialysistotal=_DOUBLE,
        cellpath=_STRING,
        celllabel=_STRING,
        cellvaluenumeric=_DOUBLE,
    ),
    "pasthistory": _table(
        patientunitstayid=_LONG,
        pasthistoryoffset=_LONG,
        pasthistoryenteredoffset=_LONG,
        pasthistorypath=_STRING,
    ),
    "admissiondx": _table(
        patientunitstayid=_LONG, admitdxenteredoffset=_LONG, admitdxpath=_STRING
    ),
    "infusiondrug": _table(
        patientunitstayid=_LONG, drugstartoffset=_LONG, patientweight=_DOUBLE
    ),
    "physicalexam": _table(
        patientunitstayid=_LONG,
        physicalexamoffset=_LONG,
        physicalexampath=_STRING,
        physicalexamtext=_STRING,
    ),
}

#: Source columns that may be missing.
OPTIONAL = {"unitadmitoffset"}

DERIVED: dict[str, T.StructType] = {
    "mcs_events": _table(
        patientunitstayid=_LONG, mechanical_support_type=_STRING, chartoffset=_LONG
    ),
    "dialysis_events": _table(
        patientunitstayid=_LONG, chartoffset=_LONG, dialysis_type=_STRING
    ),
    "urine_output": _table(patientunitstayid=_LONG, chartoffset=_LONG, urineoutput=_DOUBLE),
    "weight_durations": _table(
        patientunitstayid=_LONG,
        startoffset=_LONG,
        endoffset=_LONG,
        weight=_DOUBLE,
        weight_type=_STRING,
    ),
    "kdigo_creatinine": _table(
        patientunitstayid=_LONG,
        patienthealthsystemstayid=_LONG,
        labresultoffset=_LONG,
        creat=_DOUBLE,
        creat_low_past_48hr=_DOUBLE,
        creat_low_past_7day=_DOUBLE,
    ),
    "kdigo_uo": _table(
        patientunitstayid=_LONG,
        chartoffset=_LONG,
        weight=_DOUBLE,
        urineoutput_6hr=_DOUBLE,
        urineoutput_12hr=_DOUBLE,
        urineoutput_24hr=_DOUBLE,
        uo_rt_6hr=_DOUBLE,
        uo_rt_12hr=_DOUBLE,
        uo_rt_24hr=_DOUBLE,
        uo_tm_6hr=_DOUBLE,
        uo_tm_12hr=_DOUBLE,
        uo_tm_24hr=_DOUBLE,
    ),
    "kdigo_stages": _table(
        uniquepid=_STRING,
        patienthealthsystemstayid=_LONG,
        patientunitstayid=_LONG,
        chartoffset=_LONG,
        creat_low_past_7day=_DOUBLE,
        creat_low_past_48hr=_DOUBLE,
        creat=_DOUBLE,
        aki_stage_creat=_INT,
        uo_rt_6hr=_DOUBLE,
        uo_rt_12hr=_DOUBLE,
        uo_rt_24hr=_DOUBLE,
        aki_stage_uo=_INT,
        aki_stage_dialysis=_INT,
        aki_stage=_INT,
        aki_stage_smoothed=_INT,
    ),
}
