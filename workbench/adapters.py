"""The driver's test tables shown as clinical source tables, in Spark and in SQL.

Both sides state the same projections. Every table reads all events of its event
types; ``k`` (0..99, from the event's properties) and the keys choose which charted
string or number a row gets, not whether it is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import vocab
from wardline.schemas import SOURCES, STAY

_P = vocab.OUTPUT_PREFIX

CELL_PATHS = (
    _P + "Urine",
    _P + "3 Way Foley",
    _P + "foley cath",
    _P + "foley or drain",
    _P + "Output Size Urinary Catheter A",
    _P + "Output Size Urethral Catheter A",
    _P + "Urine Output (mL) A",
    _P + "Output External Urethral A",
    _P + "Urinary Catheter Output A",
    _P + "Stool",
    _P.replace("Output", "Intake") + "Urine",
    None,
)
LAB_NAMES = ("creatinine", "Creatinine", "CREATININE", "urinary creatinine")
EXAM_PATHS = (vocab.EXAM_WEIGHT_CURRENT, vocab.EXAM_WEIGHT_ADMISSION, "notes/other")
TREATMENTS = tuple(v for v, _ in vocab.DIALYSIS_TREATMENT + vocab.MCS_TREATMENT)
DEVICE_VALUES = tuple(dict.fromkeys(v for v, _ in vocab.MCS_ASSESSMENT))
DIAGNOSES = tuple(v for v, _ in vocab.MCS_DIAGNOSIS + vocab.DIALYSIS_DIAGNOSIS)
HISTORY_PATHS = tuple(v for v, _ in vocab.DIALYSIS_PAST_HISTORY)
CHART_LABELS = tuple(v for v, _ in vocab.MCS_NURSE_CHART)

# --- Spark ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their offset in minutes and ``k``."""
    minutes = "timestampdiff(MINUTE, TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sid"),
        F.col("event_type").alias("et"),
        F.col("value").alias("v"),
        (F.expr(minutes) - 11000).alias("off"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )


def _pick(index: Column, values: tuple[str | None, ...]) -> Column:
    """The value at an index, NULL outside the list."""
    return F.get(F.array(*(F.lit(v) for v in values)), index)


def sources(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named source tables."""
    ev = events(spark, sf_dir)
    built = {name: _PROJECTIONS[name](ev) for name in names if name != "patient"}
    if "patient" in names:
        built["patient"] = _patient(table(spark, sf_dir, "customer"))
    for name, df in built.items():
        assert df.columns == SOURCES[name].fieldNames(), name
    return built


def _of(ev: DataFrame, *kinds: str) -> DataFrame:
    """The events of some types, with the stay and the time they were entered."""
    return ev.filter(F.col("et").isin(*kinds)).select(
        F.col("sid").alias("patientunitstayid"), "v", "off", (F.col("off") + 15).alias("entered"), "k"
    )


def _patient(customer: DataFrame) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    return customer.select(
        key.alias("patientunitstayid"),
        (F.lit(100000) + key % 50).alias("patienthealthsystemstayid"),
        F.col("c_name").alias("uniquepid"),
        F.when(key % 3 == 1, 0).when(key % 3 == 2, 30).cast("long").alias("unitadmitoffset"),
        F.when(key % 7 != 0, 28000).cast("long").alias("unitdischargeoffset"),
        F.when(key % 4 != 0, balance / 50).alias("admissionweight"),
        F.when(key % 6 != 0, balance / 40).alias("dischargeweight"),
    )


def _lab(ev: DataFrame) -> DataFrame:
    k, v = F.col("k"), F.col("v")
    return _of(ev, "view").select(
        STAY,
        _pick(k % 4, LAB_NAMES).alias("labname"),
        F.when(k % 29 == 0, None).when(k % 31 == 0, v * 10).otherwise(v / 49.7).alias("labresult"),
        F.col("off").alias("labresultoffset"),
    )


def _treatment(ev: DataFrame) -> DataFrame:
    # k = 1 gives two treatments at one offset.
    k = F.col("k")
    entries = F.when(k == 1, F.array(k, F.lit(4))).otherwise(F.array(k))
    return (
        _of(ev, "purchase")
        .withColumn("entry", F.explode(entries))
        .select(
            STAY,
            F.col("off").alias("treatmentoffset"),
            F.coalesce(_pick(F.col("entry"), TREATMENTS), F.lit("other")).alias("treatmentstring"),
        )
    )


def _nursecharting(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    return _of(ev, "error").select(
        STAY,
        F.when(k != 1, F.col("off")).alias("nursingchartoffset"),
        F.col("entered").alias("nursingchartentryoffset"),
        F.coalesce(_pick(k, CHART_LABELS), F.lit("Other")).alias("nursingchartcelltypevallabel"),
    )


def _nurseassessment(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    cell = (
        F.when(k == 0, vocab.DIALYSIS_ASSESSMENT_CELL[0][0])
        .when(k <= 20, vocab.MCS_ASSESSMENT_CELL)
        .otherwise("Other")
    )
    return _of(ev, "signup").select(
        STAY,
        F.when(k % 4 != 0, F.col("off")).alias("nurseassessoffset"),
        F.col("entered").alias("nurseassessentryoffset"),
        cell.alias("celllabel"),
        F.when(k >= 1, _pick(k - 1, DEVICE_VALUES)).alias("cellattributevalue"),
    )


def _diagnosis(ev: DataFrame) -> DataFrame:
    return _of(ev, "view").select(
        STAY,
        F.col("off").alias("diagnosisoffset"),
        F.coalesce(_pick(F.col("k"), DIAGNOSES), F.lit("other")).alias("diagnosisstring"),
    )


def _intakeoutput(ev: DataFrame) -> DataFrame:
    k, v = F.col("k"), F.col("v")
    cell = (
        F.when(k % 17 == 0, "Bodyweight (kg)")
        .when(k % 17 == 1, "Bodyweight (lb)")
        .otherwise("Other")
    )
    return _of(ev, "click", "error").select(
        STAY,
        F.when(k % 23 != 0, F.col("off")).alias("intakeoutputoffset"),
        F.col("entered").alias("intakeoutputentryoffset"),
        F.when(k % 5 == 0, v).when(k % 5 == 1, 0.0).alias("dialysistotal"),
        F.when(k % 12 == 0, _pick(F.abs(F.col("off")) % len(vocab.URINE_PATHS), vocab.URINE_PATHS))
        .otherwise(_pick(k % 12, CELL_PATHS))
        .alias("cellpath"),
        cell.alias("celllabel"),
        F.when(k % 13 != 0, v * 16.0000123).alias("cellvaluenumeric"),
    )


def _pasthistory(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    return _of(ev, "signup").select(
        STAY,
        F.when(k != 31, F.col("off")).alias("pasthistoryoffset"),
        F.col("entered").alias("pasthistoryenteredoffset"),
        F.coalesce(_pick(k - 30, HISTORY_PATHS), F.lit("other")).alias("pasthistorypath"),
    )


def _admissiondx(ev: DataFrame) -> DataFrame:
    graft = F.when(F.col("k") == 40, vocab.DIALYSIS_ADMISSION[0][0]).otherwise("other")
    return _of(ev, "signup").select(
        STAY, F.col("off").alias("admitdxenteredoffset"), graft.alias("admitdxpath")
    )


def _infusiondrug(ev: DataFrame) -> DataFrame:
    return _of(ev, "signup").select(
        STAY,
        F.when(F.col("k") % 19 != 0, F.col("off")).alias("drugstartoffset"),
        F.col("v").alias("patientweight"),
    )


def _physicalexam(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    weight = F.col("v").cast("decimal(10,2)").cast("string")
    text = (
        F.when(k % 5 == 0, None)
        .when(k % 5 == 1, "unknown")
        .otherwise(F.concat(F.lit("wt "), weight, F.lit(" kg")))
    )
    return _of(ev, "purchase").select(
        STAY,
        F.col("off").alias("physicalexamoffset"),
        _pick(k % 3, EXAM_PATHS).alias("physicalexampath"),
        text.alias("physicalexamtext"),
    )


_PROJECTIONS = {
    "lab": _lab,
    "treatment": _treatment,
    "nursecharting": _nursecharting,
    "nurseassessment": _nurseassessment,
    "diagnosis": _diagnosis,
    "intakeoutput": _intakeoutput,
    "pasthistory": _pasthistory,
    "admissiondx": _admissiondx,
    "infusiondrug": _infusiondrug,
    "physicalexam": _physicalexam,
}

# --- SQL ------------------------------------------------------------------------------


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_list(values: tuple[str | None, ...]) -> str:
    return ", ".join(sql_text(v) for v in values)


def _sql_pick(index: str, values: tuple[str | None, ...]) -> str:
    return f"list_extract([{sql_list(values)}], {index} + 1)"


EVENTS_SQL = """ev AS (
  SELECT user_id AS sid, event_type AS et, value AS v,
         date_diff('minute', TIMESTAMP '2024-01-01 00:00:00', ts) - 11000 AS off,
         CAST(regexp_extract(props, '[0-9]+') AS INT) AS k
  FROM events)"""

SOURCES_SQL = {
    "patient": """patient AS (
  SELECT c_custkey AS patientunitstayid,
         100000 + c_custkey % 50 AS patienthealthsystemstayid,
         c_name AS uniquepid,
         CAST(CASE c_custkey % 3 WHEN 1 THEN 0 WHEN 2 THEN 30 END AS BIGINT) AS unitadmitoffset,
         CAST(CASE WHEN c_custkey % 7 <> 0 THEN 28000 END AS BIGINT) AS unitdischargeoffset,
         CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal / 50 END AS admissionweight,
         CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal / 40 END AS dischargeweight
  FROM customer)""",
    "lab": f"""lab AS (
  SELECT sid AS patientunitstayid, {_sql_pick("k % 4", LAB_NAMES)} AS labname,
         CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN v * 10 ELSE v / CAST(49.7 AS DOUBLE) END AS labresult,
         off AS labresultoffset
  FROM ev WHERE et = 'view')""",
    "treatment": f"""treatment AS (
  SELECT sid AS patientunitstayid, off AS treatmentoffset,
         coalesce({_sql_pick("i", TREATMENTS)}, 'other') AS treatmentstring
  FROM (SELECT sid, off, unnest(CASE WHEN k = 1 THEN [k, 4] ELSE [k] END) AS i
        FROM ev WHERE et = 'purchase'))""",
    "nursecharting": f"""nursecharting AS (
  SELECT sid AS patientunitstayid, CASE WHEN k <> 1 THEN off END AS nursingchartoffset,
         off + 15 AS nursingchartentryoffset,
         coalesce({_sql_pick("k", CHART_LABELS)}, 'Other') AS nursingchartcelltypevallabel
  FROM ev WHERE et = 'error')""",
    "nurseassessment": f"""nurseassessment AS (
  SELECT sid AS patientunitstayid, CASE WHEN k % 4 <> 0 THEN off END AS nurseassessoffset,
         off + 15 AS nurseassessentryoffset,
         CASE WHEN k = 0 THEN 'AV Fistula'
              WHEN k <= 20 THEN {sql_text(vocab.MCS_ASSESSMENT_CELL)} ELSE 'Other' END AS celllabel,
         CASE WHEN k >= 1 THEN {_sql_pick("k - 1", DEVICE_VALUES)} END AS cellattributevalue
  FROM ev WHERE et = 'signup')""",
    "diagnosis": f"""diagnosis AS (
  SELECT sid AS patientunitstayid, off AS diagnosisoffset,
         coalesce({_sql_pick("k", DIAGNOSES)}, 'other') AS diagnosisstring
  FROM ev WHERE et = 'view')""",
    "intakeoutput": f"""intakeoutput AS (
  SELECT sid AS patientunitstayid, CASE WHEN k % 23 <> 0 THEN off END AS intakeoutputoffset,
         off + 15 AS intakeoutputentryoffset,
         CASE WHEN k % 5 = 0 THEN v WHEN k % 5 = 1 THEN 0.0 END AS dialysistotal,
         CASE WHEN k % 12 = 0 THEN {_sql_pick(f"abs(off) % {len(vocab.URINE_PATHS)}", vocab.URINE_PATHS)}
              ELSE {_sql_pick("k % 12", CELL_PATHS)} END AS cellpath,
         CASE k % 17 WHEN 0 THEN 'Bodyweight (kg)' WHEN 1 THEN 'Bodyweight (lb)'
                     ELSE 'Other' END AS celllabel,
         CASE WHEN k % 13 <> 0 THEN v * CAST(16.0000123 AS DOUBLE) END AS cellvaluenumeric
  FROM ev WHERE et IN ('click', 'error'))""",
    "pasthistory": f"""pasthistory AS (
  SELECT sid AS patientunitstayid, CASE WHEN k <> 31 THEN off END AS pasthistoryoffset,
         off + 15 AS pasthistoryenteredoffset,
         CASE WHEN k BETWEEN 30 AND 31 THEN {_sql_pick("k - 30", HISTORY_PATHS)}
              ELSE 'other' END AS pasthistorypath
  FROM ev WHERE et = 'signup')""",
    "admissiondx": f"""admissiondx AS (
  SELECT sid AS patientunitstayid, off AS admitdxenteredoffset,
         CASE WHEN k = 40 THEN {sql_text(vocab.DIALYSIS_ADMISSION[0][0])}
              ELSE 'other' END AS admitdxpath
  FROM ev WHERE et = 'signup')""",
    "infusiondrug": """infusiondrug AS (
  SELECT sid AS patientunitstayid, CASE WHEN k % 19 <> 0 THEN off END AS drugstartoffset,
         v AS patientweight
  FROM ev WHERE et = 'signup')""",
    "physicalexam": f"""physicalexam AS (
  SELECT sid AS patientunitstayid, off AS physicalexamoffset,
         {_sql_pick("k % 3", EXAM_PATHS)} AS physicalexampath,
         CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'unknown'
              ELSE 'wt ' || CAST(CAST(v AS DECIMAL(10, 2)) AS VARCHAR) || ' kg' END
           AS physicalexamtext
  FROM ev WHERE et = 'purchase')""",
}
