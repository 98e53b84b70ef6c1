"""Hand-made rows, one case per rule that the test tables may not reach."""

from __future__ import annotations

import pytest

import wardline as wl
from conftest import values
from wardline import vocab
from wardline.plans.stages import creatinine_stage, urine_stage
from pyspark.sql import functions as F

P = vocab.OUTPUT_PREFIX


# --- Events -----------------------------------------------------------------------------


def _mcs(frame, treatment=(), nursecharting=(), nurseassessment=(), diagnosis=()):
    return wl.mcs_events(
        frame("treatment", *treatment),
        frame("nursecharting", *nursecharting),
        frame("nurseassessment", *nurseassessment),
        frame("diagnosis", *diagnosis),
    )


def _device(value, off=1, entry=None, label="Ventricular Assist Device"):
    return dict(
        patientunitstayid=1,
        nurseassessoffset=off,
        nurseassessentryoffset=entry,
        celllabel=label,
        cellattributevalue=value,
    )


def test_value_with_two_labels_gives_two_rows(frame):
    out = _mcs(frame, nurseassessment=[_device("Impella, IABP"), _device("P8, 1:1", 2)])
    assert values(out, "chartoffset", "mechanical_support_type") == [
        (1, "IABP"),
        (1, "Impella"),
        (2, "IABP"),
        (2, "Impella"),
    ]


def test_strings_match_whole(frame):
    out = _mcs(
        frame,
        nurseassessment=[
            _device("Heartmate II "),
            _device("Heartmate II", 2),
            _device("heartmate ii ", 3),
            _device("Yes", 4, label="Other"),
            _device(None, 5),
        ],
        treatment=[
            dict(
                patientunitstayid=1,
                treatmentoffset=6,
                treatmentstring="cardiovascular|non-operative procedures|intraaortic balloon pump removal",
            )
        ],
    )
    assert values(out, "chartoffset", "mechanical_support_type") == [
        (1, "LVAD"),
        (6, "IABP_discontinued"),
    ]


def test_entry_offset_is_the_fallback(frame):
    out = _mcs(
        frame,
        nursecharting=[
            dict(
                patientunitstayid=1,
                nursingchartoffset=None,
                nursingchartentryoffset=5,
                nursingchartcelltypevallabel="ECMO",
            )
        ],
        nurseassessment=[_device("P2", None, None), _device("P2", 0, 9)],
    )
    assert values(out, "chartoffset", "mechanical_support_type") == [
        (0, "Impella"),
        (5, "ECMO"),
        (None, "Impella"),
    ]


def _dialysis(frame, **rows):
    names = (
        "treatment",
        "nurseassessment",
        "intakeoutput",
        "diagnosis",
        "pasthistory",
        "admissiondx",
    )
    return wl.dialysis_events(*(frame(n, *rows.get(n, ())) for n in names))


def test_diagnosis_without_a_type(frame):
    string = "renal|disorder of kidney|acute renal failure|unstable during hemodialysis"
    out = _dialysis(
        frame, diagnosis=[dict(patientunitstayid=1, diagnosisoffset=3, diagnosisstring=string)]
    )
    assert values(out, "patientunitstayid", "chartoffset", "dialysis_type") == [(1, 3, None)]


def test_dialysis_output_is_distinct_before_the_offset_is_chosen(frame):
    def cell(off, entry, total):
        return dict(
            patientunitstayid=1,
            intakeoutputoffset=off,
            intakeoutputentryoffset=entry,
            dialysistotal=total,
        )

    out = _dialysis(
        frame,
        intakeoutput=[
            cell(10, 11, 100.0),
            cell(10, 11, 100.0),
            cell(10, 11, 7.0),
            cell(10, 12, -50.0),
            cell(20, 21, 0.0),
            cell(30, 31, None),
            cell(None, 40, 1.0),
        ],
    )
    assert values(out, "chartoffset", "dialysis_type") == [
        (10, "dialysis_output"),
        (10, "dialysis_output"),
        (40, "dialysis_output"),
    ]


# --- Urine ------------------------------------------------------------------------------


def _cell(off, path, value, stay=1, **more):
    return dict(
        patientunitstayid=stay,
        intakeoutputoffset=off,
        cellpath=path,
        cellvaluenumeric=value,
        **more,
    )


def test_urine_rules(frame):
    included = [
        P + "Urine",
        P + "Straight  cath",
        P + "foley",
        P + "foley cath 2",
        P + "Output 1 Urinary Catheter x",
        P + "Output Urethral Catheter",
        P + "Urine Output (mL) a",
        P + "Output External Urethral",
        P + "Urinary Catheter Output",
    ]
    excluded = [
        P + "foley or drain",
        P + "foley irrigant",
        P + "foley PACU",
        P + "Foley",
        P + "urine Output (mL)",
        P + "Stool",
        "x" + P + "Urine",
        P.replace("Output", "Intake") + "Urine",
        "Urine",
        None,
    ]
    rows = [_cell(i, p, 2.0**i) for i, p in enumerate(included + excluded)]
    rows.append(_cell(0, P + "Urine", None))
    out = wl.urine_output(frame("intakeoutput", *rows))
    assert values(out, "chartoffset", "urineoutput") == [
        (i, 2.0**i) for i in range(len(included))
    ]


def test_undated_urine_forms_one_group(frame):
    out = wl.urine_output(
        frame(
            "intakeoutput",
            _cell(None, P + "Urine", 1.5),
            _cell(None, P + "URINE", 2.25),
            _cell(4, P + "Urine", -1.0),
        )
    )
    assert values(out, "chartoffset", "urineoutput") == [(4, -1.0), (None, 3.75)]


# --- Weights ----------------------------------------------------------------------------


def _weights(frame, patient=None, **rows):
    stay = dict(patientunitstayid=1, **(patient or {}))
    names = ("infusiondrug", "physicalexam", "intakeoutput")
    out = wl.weight_durations(
        frame("patient", stay), *(frame(n, *rows.get(n, ())) for n in names)
    )
    return values(out, "startoffset", "endoffset", "weight", "weight_type")


def _exam(off, text, kind="Current"):
    path = vocab.EXAM_WEIGHT_CURRENT if kind == "Current" else vocab.EXAM_WEIGHT_ADMISSION
    return dict(
        patientunitstayid=1, physicalexamoffset=off, physicalexampath=path, physicalexamtext=text
    )


def _infusion(off, weight):
    return dict(patientunitstayid=1, drugstartoffset=off, patientweight=weight)


def test_only_the_first_admission_weight_moves(frame):
    got = _weights(
        frame, physicalexam=[_exam(0, "80", "Admission"), _exam(500, "81", "Admission")]
    )
    assert got == [(-120, 500, 80.0, "admit"), (500, 620, 81.0, "admit")]


def test_last_interval_ends_after_discharge(frame):
    assert _weights(frame, infusiondrug=[_infusion(100, 70.0)]) == [
        (-120, 100, 70.0, "daily"),
        (100, 220, 70.0, "daily"),
    ]
    assert _weights(
        frame, dict(unitdischargeoffset=5000), infusiondrug=[_infusion(100, 70.0)]
    ) == [(-120, 100, 70.0, "daily"), (100, 5120, 70.0, "daily")]
    # A start after discharge gives an interval that ends before it starts.
    assert _weights(
        frame, dict(unitdischargeoffset=100), infusiondrug=[_infusion(400, 70.0)]
    ) == [(-120, 400, 70.0, "daily"), (400, 220, 70.0, "daily")]


def test_back_fill_needs_a_first_start_after_admission(frame):
    assert _weights(frame, infusiondrug=[_infusion(-60, 70.0)]) == [(-60, 60, 70.0, "daily")]
    assert _weights(frame, infusiondrug=[_infusion(0, 70.0)]) == [(0, 120, 70.0, "daily")]
    assert _weights(
        frame, dict(unitadmitoffset=30), infusiondrug=[_infusion(31, 70.0)]
    ) == [(-90, 31, 70.0, "daily"), (31, 151, 70.0, "daily")]


def test_pounds_are_converted_before_the_range_check(frame):
    got = _weights(
        frame,
        intakeoutput=[
            _cell(0, None, 220.0, celllabel="BodyWeight (lb)"),
            _cell(9, None, 40.0, celllabel="Bodyweight (LB)"),
            _cell(10, None, 40.0, celllabel="bodyweight (kg)"),
            _cell(11, None, 40.0, celllabel="weight"),
        ],
    )
    assert got == [(0, 10, 220.0 * 0.45359237, "daily"), (10, 130, 40.0, "daily")]
    assert got[0][2] == pytest.approx(99.7903214)


def test_first_number_of_a_text(frame):
    got = _weights(
        frame,
        physicalexam=[
            _exam(0, "wt 72.5 kg"),
            _exam(1, "unknown"),
            _exam(2, "BMI 31 wt 80"),
            _exam(3, None),
            _exam(4, "-90"),
            _exam(5, "1001"),
            dict(_exam(6, "50"), physicalexampath="other"),
        ],
    )
    assert got == [(0, 2, 72.5, "daily"), (2, 4, 31.0, "daily"), (4, 124, 90.0, "daily")]


def test_tied_weights(frame):
    rows = [_infusion(100, w) for w in (90.0, 80.0, 90.0)]
    assert _weights(frame, dict(unitdischargeoffset=100), infusiondrug=rows) == [
        (-120, 100, 80.0, "daily"),
        (100, 100, 80.0, "daily"),
        (100, 100, 90.0, "daily"),
        (100, 220, 90.0, "daily"),
    ]
    # 'admit' comes before 'daily'; the moved admission weight ties with a daily one.
    assert _weights(
        frame, dict(admissionweight=75.0), infusiondrug=[_infusion(-120, 60.0)]
    ) == [(-120, -120, 75.0, "admit"), (-120, 0, 60.0, "daily")]
    # Equal first admission weights: one copy moves, the other stays.
    assert _weights(
        frame, dict(admissionweight=75.0), physicalexam=[_exam(0, "75", "Admission")]
    ) == [(-120, 0, 75.0, "admit"), (0, 120, 75.0, "admit")]


def test_unit_admission_offset_is_optional(frame):
    patient = frame("patient", dict(patientunitstayid=1, admissionweight=75.0)).drop(
        "unitadmitoffset"
    )
    out = wl.weight_durations(
        patient, frame("infusiondrug"), frame("physicalexam"), frame("intakeoutput")
    )
    assert values(out, "startoffset", "endoffset", "weight") == [(-120, 0, 75.0)]


def test_weights_of_unknown_stays_are_dropped(frame):
    assert _weights(frame, infusiondrug=[dict(_infusion(3, 70.0), patientunitstayid=2)] * 2) == []


def test_many_copies_of_one_weight(frame, spark):
    copies = spark.range(2_500).selectExpr(
        "1L AS patientunitstayid", "7L AS drugstartoffset", "70D AS patientweight"
    )
    out = wl.weight_durations(
        frame("patient", dict(patientunitstayid=1)),
        copies,
        frame("physicalexam"),
        frame("intakeoutput"),
    )
    counts = out.groupBy("startoffset", "endoffset").count()
    assert values(counts, "startoffset", "endoffset", "count") == [
        (-120, 7, 1),
        (7, 7, 2_499),
        (7, 127, 1),
    ]


# --- Creatinine -------------------------------------------------------------------------


def _creatinine(frame, *labs, discharge=None):
    out = wl.kdigo_creatinine(
        frame(
            "patient",
            dict(
                patientunitstayid=1, patienthealthsystemstayid=5, unitdischargeoffset=discharge
            ),
        ),
        frame(
            "lab",
            *(
                dict(patientunitstayid=1, labname=n, labresult=v, labresultoffset=t)
                for t, v, n in ((*lab, "creatinine")[:3] for lab in labs)
            ),
        ),
    )
    return values(out, "labresultoffset", "creat", "creat_low_past_48hr", "creat_low_past_7day")


def test_trailing_minima_reach_back_inclusively(frame):
    assert _creatinine(frame, (0, 1.0), (2880, 2.0), (2881, 3.0), (10080, 4.0), (10081, 5.0)) == [
        (0, 1.0, None, None),
        (2880, 2.0, 1.0, 1.0),
        (2881, 3.0, 2.0, 1.0),
        (10080, 4.0, None, 1.0),
        (10081, 5.0, 4.0, 2.0),
    ]


def test_labs_at_one_offset_are_averaged(frame):
    assert _creatinine(frame, (10, 1.0), (10, 2.0)) == [(10, 1.5, None, None)]


def test_lab_filters(frame):
    assert _creatinine(
        frame,
        (1, 1.0, "urinary creatinine"),
        (2, 0.009),
        (3, 150.0, "CREATININE"),
        (4, 150.1),
        (5, None),
        (-10081, 1.0),
        (-10080, 2.0),
        (51, 1.0),
        (50, 3.0, "Creatinine"),
        discharge=50,
    ) == [(-10080, 2.0, None, None), (3, 150.0, None, None), (50, 3.0, 150.0, 150.0)]


# --- Urine rates ------------------------------------------------------------------------


def _rates(frame, urine, weights, *columns):
    out = wl.kdigo_uo(
        frame(
            "urine_output",
            *(dict(patientunitstayid=1, chartoffset=t, urineoutput=v) for t, v in urine),
        ),
        frame("patient", dict(patientunitstayid=1)),
        frame(
            "weight_durations",
            *(
                dict(patientunitstayid=1, startoffset=s, endoffset=e, weight=w)
                for s, e, w in weights
            ),
        ),
    )
    return values(out, "chartoffset", *columns)


def test_six_hour_cadence(frame):
    got = _rates(
        frame,
        [(0, 100.0), (360, 300.0), (720, 300.0)],
        [(-120, 5000, 50.0)],
        "uo_tm_6hr",
        "uo_rt_6hr",
        "uo_rt_12hr",
        "urineoutput_6hr",
    )
    assert got == [
        (0, 1.0, None, None, 100.0),
        (360, 7.0, round(400 / 50 / 7, 4), None, 400.0),
        (720, 12.0, None, round(700 / 50 / 13, 4), 600.0),
    ]


def test_observed_time_meets_the_limit_exactly(frame):
    """Eighteen gaps of twenty minutes are six hours, not a little less."""
    urine = [(20 * i, 1.0) for i in range(60)]
    got = dict((t, r) for t, h, r in _rates(frame, urine, [(0, 9999, 50.0)], "uo_tm_6hr", "uo_rt_6hr"))
    assert got[360] is not None
    assert got[300] == round(16 / 50 / 6, 4)


def test_weight_interval_is_half_open(frame):
    urine = [(99, 1.0), (100, 1.0), (150, 1.0), (199, 1.0), (200, 1.0)]
    intervals = [(0, 100, 60.0), (150, 150, 61.0), (150, 200, 62.0), (300, 200, 63.0)]
    assert _rates(frame, urine, intervals, "weight") == [
        (99, 60.0),
        (100, None),
        (150, 62.0),
        (199, 62.0),
        (200, None),
    ]
    assert _rates(frame, [(5, 1.0), (10**6, 1.0)], [(6, None, 70.0)], "weight") == [
        (5, None),
        (10**6, 70.0),
    ]


def test_weight_and_gap_from_long_before(frame):
    """The row and the weight before the current one lie many segments back."""
    got = _rates(
        frame, [(0, 10.0), (10**6, 20.0)], [(-120, 2 * 10**6, 50.0)], "weight", "uo_tm_6hr", "uo_rt_12hr"
    )
    hours = 10**6 / 60
    assert got == [(0, 50.0, 1.0, None), (10**6, 50.0, hours, round(20 / 50 / hours, 4))]


def test_undated_urine_row(frame):
    """It comes last, adds no time, sees only itself and finds no weight."""
    got = _rates(
        frame, [(None, 5.0), (0, 1.0)], [(-120, None, 50.0)], "weight", "urineoutput_24hr", "uo_tm_24hr"
    )
    assert got == [(0, 50.0, 1.0, 1.0), (None, None, 5.0, 0.0)]
    assert _rates(frame, [(None, 5.0)], [], "urineoutput_6hr", "uo_tm_6hr") == [(None, 5.0, 1.0)]


# --- Stages -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("creat", "low_7day", "low_48hr", "stage"),
    [
        (3.0, 1.0, 1.0, 3),
        (4.2, 3.0, 3.6, 3),
        (4.2, 3.0, None, 0),
        (4.5, 3.0, None, 3),
        (2.0, 1.0, 1.0, 2),
        (1.5, 1.0, 1.3, 1),
        (1.5, 1.0, None, 1),
        (1.4, 1.0, 1.0, 1),
        (1.2, 1.0, 1.0, 0),
        (9.0, None, None, None),
        (None, 1.0, 1.0, None),
    ],
)
def test_creatinine_stage(spark, creat, low_7day, low_48hr, stage):
    df = spark.createDataFrame([(creat, low_7day, low_48hr)], "a double, b double, c double")
    assert df.select(creatinine_stage(F.col("a"), F.col("b"), F.col("c"))).first()[0] == stage


@pytest.mark.parametrize(
    ("offset", "rates", "hours", "stage"),
    [
        (360, (0.1, 0.1, 0.1), (6, 12, 24), 0),
        (361, (None, 0.1, 0.1), (6, 12, 24), None),
        (361, (0.6, 0.6, 0.29), (6, 12, 24), 3),
        (361, (0.6, 0.6, 0.3), (6, 12, 24), 0),
        (361, (0.0, 0.0, None), (6, 12, 23), 3),
        (361, (0.6, 0.49, 0.4), (6, 12, 24), 2),
        (361, (0.49, None, None), (6, 11, 11), 1),
        (361, (0.5, None, None), (6, 11, 11), 0),
    ],
)
def test_urine_stage(spark, offset, rates, hours, stage):
    df = spark.createDataFrame(
        [(offset, *rates, *map(float, hours))],
        "t long, r6 double, r12 double, r24 double, h6 double, h12 double, h24 double",
    )
    rate = {h: F.col(f"r{h}") for h in (6, 12, 24)}
    hour = {h: F.col(f"h{h}") for h in (6, 12, 24)}
    assert df.select(urine_stage(F.col("t"), rate, hour)).first()[0] == stage


def _stages(frame, events=(), creat=(), urine=(), columns=("chartoffset", "aki_stage_dialysis"), **kw):
    out = wl.kdigo_stages(
        frame("patient", dict(patientunitstayid=1, uniquepid="a"), dict(patientunitstayid=2)),
        frame(
            "kdigo_creatinine",
            *(
                dict(
                    patientunitstayid=1,
                    labresultoffset=t,
                    creat=c,
                    creat_low_past_7day=1.0,
                    creat_low_past_48hr=1.0,
                )
                for t, c in creat
            ),
        ),
        frame("kdigo_uo", *(dict(patientunitstayid=1, chartoffset=t) for t in urine)),
        frame(
            "dialysis_events",
            *(dict(patientunitstayid=1, chartoffset=t, dialysis_type=k) for t, k in events),
        ),
        **kw,
    )
    return values(out, *columns)


def test_unknown_modality_does_not_count_in_chronic_stays(frame):
    unknown = (7, "unknown_intermittent_hemodialysis")
    assert _stages(frame, [unknown]) == [(7, 3)]
    assert _stages(frame, [unknown, (900, "av_fistula")]) == []


def test_output_near_an_acute_event(frame):
    events = [(0, "CVVH"), (720, "dialysis_output"), (721, "dialysis_output"), (-720, "dialysis_output")]
    assert _stages(frame, [*events, (5, "av_shunt")]) == [(-720, 3), (0, 3), (720, 3)]
    assert _stages(frame, events) == [(-720, 3), (0, 3), (720, 3), (721, 3)]
    # Unknown modalities are no such event in a chronic stay.
    assert _stages(
        frame, [(0, "unknown_SCUF"), (5, "dialysis_output"), (5, "dialysis_graft")]
    ) == []


def test_undated_history_is_ignored(frame):
    assert _stages(frame, [(None, "past_hemodialysis"), (7, "unknown_SCUF")]) == [(7, 3)]
    assert _stages(frame, [(-999, "past_hemodialysis"), (7, "unknown_SCUF")]) == []


def test_events_at_one_offset_repeat_the_row(frame):
    assert _stages(frame, [(50, "CVVH"), (50, "SLED"), (50, "av_graft")]) == [(50, 3), (50, 3)]
    assert _stages(frame, [(50, "CVVH")] * 2 + [(50, "dialysis_output")], creat=[(50, 1.0)]) == [
        (50, 3)
    ] * 3


def test_many_events_at_one_offset(frame):
    assert len(_stages(frame, [(50, "CVVH")] * 2_345)) == 2_345


def test_smoothing(frame):
    got = _stages(
        frame,
        creat=[(0, 2.0), (360, 1.0), (361, 1.0)],
        columns=("chartoffset", "aki_stage", "aki_stage_smoothed"),
    )
    assert got == [(0, 2, 2), (360, 0, 2), (361, 0, 0)]


def test_rows_hold_only_what_is_charted_at_their_offset(frame):
    got = _stages(
        frame,
        [(5, "SLED"), (6, "chronic_SCUF"), (7, "hemodialysis_catheter"), (8, None)],
        creat=[(3, 1.0)],
        urine=[4, None],
        columns=("chartoffset", "aki_stage_creat", "aki_stage_uo", "aki_stage_dialysis", "aki_stage"),
    )
    assert got == [(3, 0, None, None, 0), (4, None, None, None, 0), (5, None, None, 3, 3)]


def test_peritoneal_labels(frame):
    event = (9, "acute_peritoneal dialysis")
    assert _stages(frame, [event]) == []
    assert _stages(frame, [event], normalize_labels=True) == [(9, 3)]
    past = [(9, "unknown_peritoneal dialysis"), (0, "past_peritoneal_dialysis")]
    assert _stages(frame, past[:1], normalize_labels=True) == [(9, 3)]
    assert _stages(frame, past, normalize_labels=True) == []
