"""What the physical plans must and must not hold, and relations between the results."""

from __future__ import annotations

import os
import re
from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import wardline as wl
from wardline.__main__ import main, run
from wardline.operators.labels import label_events
from wardline.schemas import DERIVED, SOURCES, STAY
from wardline.sources.tables import conform, read_sources, store_in, write_table
from workbench import alternatives as alt
from workbench.adapters import sources
from workbench.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", QUERIES)
def test_no_pairing_of_rows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_labelling_needs_no_shuffle(spark):
    text = plan(QUERIES["q1_mcs_events"](spark, SF_DIR))
    assert "hashpartitioning" not in text
    assert text.count("BroadcastHashJoin") == 4


def test_vocabulary_reaches_the_scan(spark, frame, tmp_path):
    stored = write_table(frame("diagnosis", dict(diagnosisstring="a")), f"{tmp_path}/d")
    text = plan(label_events(stored, "diagnosisstring", [("a", "x"), ("b", "y")], "l"))
    assert "In(diagnosisstring, [a,b])" in text


def test_creatinine_is_read_once_and_partitioned_by_stay_and_segment(spark):
    text = plan(QUERIES["q5_kdigo_creatinine"](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[[^\]]*user_id", text)) == 1
    assert re.search(r"hashpartitioning\(patientunitstayid#\d+L, _segment#\d+L", text)
    assert not re.search(r"windowspecdefinition\(patientunitstayid#\d+L, labresultoffset", text)


def test_no_window_is_partitioned_by_the_key_alone_but_over_segments(spark):
    for name in ("q4_weight_durations", "q5_kdigo_creatinine", "q6_kdigo_uo", "q7_kdigo_stages"):
        for spec in re.findall(r"windowspecdefinition\(([^()]*)", plan(QUERIES[name](spark, SF_DIR))):
            partition, second = [re.sub(r"#\d+L?.*", "", part.strip()) for part in spec.split(",")[:2]]
            assert (partition, second) == ("patientunitstayid", "_segment"), spec


def test_weight_sources_are_read_once_but_for_admissions(spark):
    text = final_plan(QUERIES["q4_weight_durations"](spark, SF_DIR))
    scans = re.findall(r"FileScan parquet \[[^\]]*user_id", text)
    # infusions, exams and cells once; exams again for the first admission weight.
    assert len(scans) == 4


@pytest.mark.parametrize("broadcast_bytes", ["10485760", "-1"])
def test_stored_weight_sources_are_read_once_but_for_admissions(spark, tmp_path, broadcast_bytes):
    names = ("patient", "infusiondrug", "physicalexam", "intakeoutput")
    for name, df in sources(spark, SF_DIR, *names).items():
        write_table(df, f"{tmp_path}/{name}.parquet")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcast_bytes}):
        text = final_plan(wl.derive("weight_durations", read_sources(spark, str(tmp_path), names)))
    scanned = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    for column, times in (("patientweight", 1), ("celllabel", 1), ("physicalexamtext", 2)):
        assert sum(column in s for s in scanned) == times


def test_only_needed_columns_and_prefixes_are_read(spark, tmp_path):
    assert "event_id" not in plan(QUERIES["q3_urine_output"](spark, SF_DIR))
    cells = sources(spark, SF_DIR, "intakeoutput")["intakeoutput"]
    text = plan(wl.urine_output(write_table(cells, f"{tmp_path}/io")))
    assert "StringStartsWith(cellpath" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "patientunitstayid",
        "intakeoutputoffset",
        "cellpath",
        "cellvaluenumeric",
    }


def test_weight_intervals_are_disjoint(spark):
    rows = QUERIES["q4_weight_durations"](spark, SF_DIR).filter("endoffset > startoffset").collect()
    by_stay: dict = {}
    for r in rows:
        by_stay.setdefault(r.patientunitstayid, []).append((r.startoffset, r.endoffset))
    assert by_stay
    for spans in by_stay.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_lows_and_stages_are_consistent(spark):
    creatinine = QUERIES["q5_kdigo_creatinine"](spark, SF_DIR)
    assert creatinine.filter("creat_low_past_7day > creat_low_past_48hr").isEmpty()
    assert creatinine.groupBy("patientunitstayid", "labresultoffset").count().filter("count > 1").isEmpty()
    stages = QUERIES["q7_kdigo_stages"](spark, SF_DIR)
    assert stages.filter(F.col("aki_stage_smoothed") < F.col("aki_stage")).isEmpty()
    assert stages.filter("aki_stage IS NULL OR chartoffset IS NULL").isEmpty()


@contextmanager
def settings(spark, values: dict[str, str]):
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_results_do_not_depend_on_partitions_or_join_strategy(spark):
    query = QUERIES["q7_kdigo_stages"]
    usual = query(spark, SF_DIR)
    plain = {
        "spark.sql.shuffle.partitions": "37",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    with settings(spark, plain):
        other = query(spark, SF_DIR)
        assert "SortMergeJoin" in plan(other)
        assert usual.exceptAll(other).isEmpty()
        assert other.exceptAll(usual).isEmpty()


def test_alternatives_give_the_same_rows(spark, tmp_path):
    series = QUERIES["q5_kdigo_creatinine"](spark, SF_DIR).select(STAY, alt.TIME, "creat")
    points = QUERIES["q3_urine_output"](spark, SF_DIR)
    intervals = store_in(str(tmp_path))(QUERIES["q4_weight_durations"](spark, SF_DIR), "intervals")
    for forms, args in (
        ((alt.lows_by_segment, alt.lows_by_key, alt.lows_by_self_join), (series,)),
        ((alt.weights_by_merge, alt.weights_by_join), (points, intervals)),
    ):
        first, *others = (form(*args) for form in forms)
        for other in others:
            assert first.exceptAll(other.select(*first.columns)).isEmpty()
            assert other.select(*first.columns).exceptAll(first).isEmpty()


@pytest.mark.parametrize("width", [1440, 10**9])
def test_urine_rates_do_not_depend_on_the_segments(spark, tmp_path, width):
    patient = sources(spark, SF_DIR, "patient")["patient"]
    urine = QUERIES["q3_urine_output"](spark, SF_DIR)
    weights = store_in(str(tmp_path))(QUERIES["q4_weight_durations"](spark, SF_DIR), "weights")
    usual = wl.kdigo_uo(urine, patient, weights)
    other = wl.kdigo_uo(urine, patient, weights, width=width)
    assert usual.exceptAll(other).isEmpty()
    assert other.exceptAll(usual).isEmpty()


def test_sources_are_brought_to_their_types(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "70.5", "12.25", "x"), (2, " 80 ", None, "y")],
        "patientUnitStayID int, admissionWeight string, dischargeWeight string, other string",
    ).selectExpr(
        "*",
        "10L AS patienthealthsystemstayid",
        "'p' AS uniquePID",
        "CAST(3 AS SMALLINT) AS unitdischargeoffset",
    )
    write_table(df, f"{tmp_path}/patient.parquet")
    got = read_sources(spark, str(tmp_path), ["patient"])["patient"]
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in SOURCES["patient"]
    ]
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, 10, "p", None, 3, 70.5, 12.25),
        (2, 10, "p", None, 3, 80.0, None),
    ]


def test_sources_and_stored_tables(spark, frame, tmp_path):
    rows = frame("lab", dict(patientunitstayid=1, labname="x", labresult=2.5))
    write_table(rows, f"{tmp_path}/lab.parquet")
    back = read_sources(spark, str(tmp_path), ["lab"])["lab"]
    assert back.schema == rows.schema
    assert back.collect() == rows.collect()
    stored = store_in(f"{tmp_path}/kept/")(rows, "lab")
    assert stored.collect() == rows.collect()
    assert stored.inputFiles()[0].replace("file://", "").startswith(f"{tmp_path}/kept/lab-")
    rows.createOrReplaceTempView("lab")
    assert read_sources(spark, None, ["lab"])["lab"].collect() == rows.collect()
    spark.catalog.dropTempView("lab")


@pytest.mark.parametrize(
    ("column", "kind", "value"),
    [
        ("labresultoffset", "double", 359.9),
        ("labresultoffset", "double", -0.5),
        ("labresultoffset", "string", "10 min"),
        ("labresultoffset", "string", "359.9"),
        ("labresultoffset", "decimal(20,0)", Decimal(2**63)),
        ("patientunitstayid", "string", "a1"),
        ("labresult", "string", "1,2"),
    ],
)
def test_values_that_do_not_survive_their_type_are_errors(spark, column, kind, value):
    row = {"patientunitstayid": 1, "labname": "x", "labresult": 1.0, "labresultoffset": 5}
    kinds = {"patientunitstayid": "long", "labname": "string", "labresult": "double", "labresultoffset": "long"}
    kinds[column] = kind
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    df = spark.createDataFrame([tuple((row | {column: value}).values()), tuple((row | {column: None}).values())], schema)
    assert conform(df.filter(f"{column} IS NULL"), "lab").collect()[0][column] is None
    with pytest.raises(Exception, match=f"{column} cannot be read as"):
        conform(df, "lab").collect()


def test_decimal_and_whole_numbers_are_kept(spark):
    df = spark.createDataFrame([(1, "x", Decimal("1.10"), 360.0)], "patientunitstayid int, labname string, labresult decimal(6,2), labresultoffset double")
    assert conform(df, "lab").collect()[0].asDict() == {
        "patientunitstayid": 1, "labname": "x", "labresult": Decimal("1.10"), "labresultoffset": 360
    }


def test_only_tables_read_twice_are_stored(spark, tmp_path):
    stored = []

    def store(df, name):
        stored.append(name)
        return store_in(str(tmp_path))(df, name)

    tables = sources(spark, SF_DIR, *SOURCES)
    plain = wl.derive("kdigo_stages", tables)
    again = wl.derive("kdigo_stages", tables, store=store)
    assert sorted(stored) == ["dialysis_events", "urine_output", "weight_durations"]
    assert plain.exceptAll(again).isEmpty() and again.exceptAll(plain).isEmpty()
    with pytest.raises(ValueError, match="no table 'nothing'"):
        wl.derive("nothing", tables)


def test_stages_are_not_shuffled_after_their_last_join(spark, tmp_path):
    tables = sources(spark, SF_DIR, *SOURCES)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = final_plan(wl.derive("kdigo_stages", tables, store=store_in(str(tmp_path))))
        above = text[: text.index("SortMergeJoin")]
        assert "Exchange" not in above and "Generate explode" in above
        urine = wl.kdigo_uo(*(store_in(str(tmp_path))(wl.derive(n, tables), n) if n in ("urine_output", "weight_durations") else tables[n] for n in ("urine_output", "patient", "weight_durations")))
        text = final_plan(urine)
        assert "LeftSemi" not in text[: text.index("Window")]


def test_command_line_names_unknown_tables(capsys):
    with pytest.raises(SystemExit):
        main(["in", "out", "nothing"])
    assert "no table nothing" in capsys.readouterr().err


def test_tables_are_derived_from_files_to_files(spark, tmp_path):
    names = sorted(SOURCES)
    for name, df in sources(spark, SF_DIR, *names).items():
        write_table(df, f"{tmp_path}/in/{name}.parquet")
    run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    for name, key in (("kdigo_stages", "q7_kdigo_stages"), ("mcs_events", "q1_mcs_events")):
        written = spark.read.parquet(f"{tmp_path}/out/{name}.parquet")
        assert written.dtypes == [(f.name, f.dataType.simpleString()) for f in DERIVED[name]]
        wanted = QUERIES[key](spark, SF_DIR).select(*written.columns)
        assert written.exceptAll(wanted).isEmpty()
        assert wanted.exceptAll(written).isEmpty()
    assert {p.name for p in (tmp_path / "out").iterdir()} == {f"{n}.parquet" for n in DERIVED}


def test_ordered_results(spark):
    tables = sources(spark, SF_DIR, *SOURCES)
    times = {
        "urine_output": "chartoffset",
        "weight_durations": "startoffset",
        "kdigo_creatinine": "labresultoffset",
        "kdigo_uo": "chartoffset",
        "kdigo_stages": "chartoffset",
    }
    for name, time in times.items():
        rows = wl.derive(name, tables, ordered=True).select(STAY, time).collect()
        keys = [(r[0], r[1] is None, r[1] or 0) for r in rows]
        assert keys and keys == sorted(keys), name


def test_weights_are_laid_out_once(spark):
    """One shuffle each to find what a stay is, to count equal weights and to bring a segment together; the last is shared."""
    text = final_plan(QUERIES["q4_weight_durations"](spark, SF_DIR))
    made = re.findall(r"Exchange hashpartitioning", re.sub(r"ReusedExchange[^\n]*", "", text))
    assert len(made) <= 6 and "ReusedExchange" in text
    assert "SortAggregate" not in text


def test_sums_stay_in_the_hash_table(spark):
    for name in ("q3_urine_output", "group_sum_avg", "q5_kdigo_creatinine"):
        assert "SortAggregate" not in final_plan(QUERIES[name](spark, SF_DIR))


def test_trailing_sums_have_no_sliding_frames(spark):
    text = plan(QUERIES["trailing_sum"](spark, SF_DIR))
    frames = set(re.findall(r"specifiedwindowframe\(RangeFrame, ([^)]*?)\)", text))
    assert frames and all(f.startswith(("unboundedpreceding", "currentrow")) for f in frames)
