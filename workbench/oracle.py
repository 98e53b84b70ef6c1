"""The same queries as SQL, stated another way where there is one.

Run by DuckDB on the same Parquet files. Trailing aggregates and lookups are range
joins or correlated subqueries here, windows over segments in Spark.
"""

from __future__ import annotations

import re

from wardline import vocab
from workbench.adapters import EVENTS_SQL, SOURCES_SQL, sql_list, sql_text
from workbench.queries import PART_RULE, PRIORITY_LABELS


def _query(select: str, *parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


def _sources(*names: str) -> list[str]:
    return [EVENTS_SQL, *(SOURCES_SQL[n] for n in names)]


def _dec(expression: str) -> str:
    """All digits of a number as it prints; DuckDB's own cast from a double would round."""
    return f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18))"


def _vocabulary(entries: tuple[tuple[str, str | None], ...]) -> str:
    rows = ", ".join(f"({sql_text(v)}, CAST({sql_text(name)} AS VARCHAR))" for v, name in entries)
    return f"(VALUES {rows}) AS vocabulary(charted, label)"


def _labelled(source: str, value: str, offset: str, entries, where: str = "TRUE") -> str:
    return (
        f"SELECT patientunitstayid, label, {offset} AS chartoffset FROM {source} "
        f"JOIN {_vocabulary(entries)} ON {value} = charted WHERE {where}"
    )


# --- Plans ------------------------------------------------------------------------------

MCS = "mcs AS (\n" + "\nUNION ALL\n".join(
    [
        _labelled("treatment", "treatmentstring", "treatmentoffset", vocab.MCS_TREATMENT),
        _labelled(
            "nursecharting",
            "nursingchartcelltypevallabel",
            "ifnull(nursingchartoffset, nursingchartentryoffset)",
            vocab.MCS_NURSE_CHART,
        ),
        _labelled(
            "nurseassessment",
            "cellattributevalue",
            "ifnull(nurseassessoffset, nurseassessentryoffset)",
            vocab.MCS_ASSESSMENT,
            f"celllabel = {sql_text(vocab.MCS_ASSESSMENT_CELL)}",
        ),
        _labelled("diagnosis", "diagnosisstring", "diagnosisoffset", vocab.MCS_DIAGNOSIS),
    ]
) + ")"

DIALYSIS = "dialysis AS (\n" + "\nUNION ALL\n".join(
    [
        _labelled("treatment", "treatmentstring", "treatmentoffset", vocab.DIALYSIS_TREATMENT),
        _labelled(
            "nurseassessment",
            "celllabel",
            "ifnull(nurseassessoffset, nurseassessentryoffset)",
            vocab.DIALYSIS_ASSESSMENT_CELL,
        ),
        f"""SELECT patientunitstayid, {sql_text(vocab.DIALYSIS_OUTPUT)},
               ifnull(intakeoutputoffset, intakeoutputentryoffset)
            FROM intakeoutput WHERE dialysistotal <> 0
            GROUP BY patientunitstayid, intakeoutputoffset, intakeoutputentryoffset""",
        _labelled("diagnosis", "diagnosisstring", "diagnosisoffset", vocab.DIALYSIS_DIAGNOSIS),
        _labelled(
            "pasthistory",
            "pasthistorypath",
            "ifnull(pasthistoryoffset, pasthistoryenteredoffset)",
            vocab.DIALYSIS_PAST_HISTORY,
        ),
        _labelled("admissiondx", "admitdxpath", "admitdxenteredoffset", vocab.DIALYSIS_ADMISSION),
    ]
) + ")"
DIALYSIS_SOURCES = (
    "treatment",
    "nurseassessment",
    "intakeoutput",
    "diagnosis",
    "pasthistory",
    "admissiondx",
)

URINE = f"""urine AS (
  SELECT patientunitstayid, intakeoutputoffset AS chartoffset,
         CAST(SUM({_dec("cellvaluenumeric")}) AS DOUBLE) AS urineoutput
  FROM intakeoutput
  WHERE cellvaluenumeric IS NOT NULL
    AND starts_with(cellpath, {sql_text(vocab.OUTPUT_PREFIX)})
    AND (cellpath IN ({sql_list(vocab.URINE_PATHS)})
         OR (starts_with(cellpath, {sql_text(vocab.URINE_FOLEY_PREFIX)})
             AND NOT regexp_matches(lower(cellpath), {sql_text("|".join(vocab.URINE_FOLEY_EXCLUDED))}))
         OR {" OR ".join(f"cellpath LIKE {sql_text(p)}" for p in vocab.URINE_PATTERNS)})
  GROUP BY ALL)"""

WEIGHTS = f"""weight_rows AS (
  SELECT patientunitstayid AS stay, off, w, kind FROM (
    SELECT patientunitstayid, ifnull(unitadmitoffset, 0) AS off, admissionweight AS w, 'admit' AS kind
    FROM patient
    UNION ALL
    SELECT patientunitstayid, unitdischargeoffset, dischargeweight, 'daily' FROM patient
    UNION ALL
    SELECT patientunitstayid, drugstartoffset, patientweight, 'daily' FROM infusiondrug
    UNION ALL
    SELECT patientunitstayid, physicalexamoffset,
           TRY_CAST(nullif(regexp_extract(physicalexamtext, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE),
           CASE WHEN physicalexampath = {sql_text(vocab.EXAM_WEIGHT_ADMISSION)} THEN 'admit' ELSE 'daily' END
    FROM physicalexam
    WHERE physicalexampath IN ({sql_list((vocab.EXAM_WEIGHT_CURRENT, vocab.EXAM_WEIGHT_ADMISSION))})
    UNION ALL
    SELECT patientunitstayid, intakeoutputoffset,
           cellvaluenumeric * CASE upper(celllabel) WHEN {sql_text(vocab.WEIGHT_CELL_KG)} THEN 1
             ELSE CAST({vocab.KILOGRAMS_PER_POUND} AS DOUBLE) END,
           'daily'
    FROM intakeoutput
    WHERE upper(celllabel) IN ({sql_list((vocab.WEIGHT_CELL_KG, vocab.WEIGHT_CELL_LB))}))
  WHERE w BETWEEN 20 AND 1000 AND off IS NOT NULL),
weight_starts AS (
  SELECT r.stay, r.w, r.kind, ifnull(p.unitadmitoffset, 0) AS admit, p.unitdischargeoffset AS discharge,
         CASE WHEN r.kind = 'admit'
               AND row_number() OVER (PARTITION BY r.stay, r.kind ORDER BY r.off, r.w) = 1
              THEN ifnull(p.unitadmitoffset, 0) - 120 ELSE r.off END AS start
  FROM weight_rows r JOIN patient p ON p.patientunitstayid = r.stay),
weights AS (
  SELECT stay AS patientunitstayid, start AS startoffset,
         ifnull(lead(start) OVER (PARTITION BY stay ORDER BY start, kind, w),
                ifnull(discharge, start) + 120) AS endoffset,
         w AS weight, kind AS weight_type
  FROM weight_starts
  UNION ALL
  SELECT stay, admit - 120, start, w, kind
  FROM (SELECT DISTINCT ON (stay) * FROM weight_starts ORDER BY stay, start, kind, w)
  WHERE admit < start)"""
WEIGHT_SOURCES = ("patient", "infusiondrug", "physicalexam", "intakeoutput")

CREATININE = f"""creat_series AS (
  SELECT l.patientunitstayid, p.patienthealthsystemstayid, l.labresultoffset,
         CAST(SUM({_dec("l.labresult")}) AS DOUBLE) / COUNT(*) AS creat
  FROM lab l JOIN patient p USING (patientunitstayid)
  WHERE lower(l.labname) = 'creatinine' AND l.labresult BETWEEN 0.01 AND 150
    AND l.labresultoffset BETWEEN -10080 AND ifnull(p.unitdischargeoffset, l.labresultoffset)
  GROUP BY ALL),
creatinine AS (
  SELECT s.*,
         (SELECT MIN(e.creat) FROM creat_series e
          WHERE e.patientunitstayid = s.patientunitstayid
            AND s.labresultoffset - e.labresultoffset BETWEEN 1 AND 2880) AS creat_low_past_48hr,
         (SELECT MIN(e.creat) FROM creat_series e
          WHERE e.patientunitstayid = s.patientunitstayid
            AND s.labresultoffset - e.labresultoffset BETWEEN 1 AND 10080) AS creat_low_past_7day
  FROM creat_series s)"""


def _uo_frames() -> str:
    """Sums by a range join of the urine rows with themselves; undated rows see only themselves."""
    sums = []
    for h in (6, 12, 24):
        inside = f"(u.chartoffset - e.chartoffset <= {60 * h} OR e.chartoffset IS NULL)"
        sums.append(f"SUM({_dec('e.urineoutput')}) FILTER (WHERE {inside}) AS vol_{h}")
        sums.append(f"SUM(e.gap) FILTER (WHERE {inside}) AS min_{h}")
    return ", ".join(sums)


def _uo_rate(h: int) -> str:
    upper = "AND min_6 < 720" if h == 6 else ""
    rate = f"CAST(vol_{h} AS DOUBLE) / w.weight / (CAST(min_{h} AS DOUBLE) / 60)"
    return (
        f"CASE WHEN w.weight IS NOT NULL AND min_{h} >= {60 * h} {upper} "
        f"THEN CAST(round(CAST({rate} AS DECIMAL(28, 12)), 4) AS DOUBLE) END AS uo_rt_{h}hr"
    )


URINE_RATE = f"""urine_gaps AS (
  SELECT *, CASE WHEN previous IS NULL THEN 60 WHEN chartoffset IS NULL THEN 0
                 ELSE chartoffset - previous END AS gap
  FROM (SELECT patientunitstayid, chartoffset, urineoutput,
               lag(chartoffset) OVER (PARTITION BY patientunitstayid
                                      ORDER BY chartoffset NULLS LAST) AS previous
        FROM urine SEMI JOIN patient USING (patientunitstayid))),
urine_frames AS (
  SELECT u.patientunitstayid, u.chartoffset, {_uo_frames()}
  FROM urine_gaps u JOIN urine_gaps e ON e.patientunitstayid = u.patientunitstayid
   AND ((e.chartoffset <= u.chartoffset AND u.chartoffset - e.chartoffset <= 1440)
        OR (e.chartoffset IS NULL AND u.chartoffset IS NULL))
  GROUP BY u.patientunitstayid, u.chartoffset),
urine_rate AS (
  SELECT f.patientunitstayid, f.chartoffset, w.weight,
         {", ".join(f"CAST(vol_{h} AS DOUBLE) AS urineoutput_{h}hr" for h in (6, 12, 24))},
         {", ".join(_uo_rate(h) for h in (6, 12, 24))},
         {", ".join(f"CAST(min_{h} AS DOUBLE) / 60 AS uo_tm_{h}hr" for h in (6, 12, 24))}
  FROM urine_frames f LEFT JOIN weights w ON w.patientunitstayid = f.patientunitstayid
   AND f.chartoffset >= w.startoffset AND f.chartoffset < w.endoffset)"""


def _creatinine_stage(creat: str, low7: str, low48: str) -> str:
    return f"""CASE WHEN {creat} IS NULL OR {low7} IS NULL THEN NULL
      WHEN {creat} >= {low7} * CAST(3.0 AS DOUBLE)
        OR ({creat} >= 4 AND ({low48} <= CAST(3.7 AS DOUBLE) OR {creat} >= {low7} * CAST(1.5 AS DOUBLE))) THEN 3
      WHEN {creat} >= {low7} * CAST(2.0 AS DOUBLE) THEN 2
      WHEN {creat} >= {low48} + CAST(0.3 AS DOUBLE) OR {creat} >= {low7} * CAST(1.5 AS DOUBLE) THEN 1
      ELSE 0 END"""


def _stages(normalize: bool) -> str:
    def names(values: tuple[str, ...]) -> str:
        return sql_list(tuple(v.replace(" ", "_") for v in values) if normalize else values)

    kind = "replace(label, ' ', '_')" if normalize else "label"
    return f"""dated AS (
  SELECT patientunitstayid, chartoffset, {kind} AS kind FROM dialysis WHERE chartoffset IS NOT NULL),
flagged AS (
  SELECT *, patientunitstayid IN (SELECT patientunitstayid FROM dated
                                  WHERE kind IN ({names(vocab.CHRONIC_TYPES)})) AS chronic
  FROM dated),
replaced AS (
  SELECT patientunitstayid, chartoffset FROM flagged
  WHERE kind IN ({names(vocab.ACUTE_TYPES)})
     OR (kind IN ({names(vocab.UNKNOWN_TYPES)}) AND NOT chronic)),
counted AS (
  SELECT * FROM replaced
  UNION ALL
  SELECT patientunitstayid, chartoffset FROM flagged f
  WHERE kind = {sql_text(vocab.DIALYSIS_OUTPUT)}
    AND (NOT chronic OR EXISTS (
      FROM replaced r WHERE r.patientunitstayid = f.patientunitstayid
       AND r.chartoffset BETWEEN f.chartoffset - 720 AND f.chartoffset + 720))),
moments AS (
  SELECT patientunitstayid, labresultoffset AS chartoffset FROM creatinine
  UNION SELECT patientunitstayid, chartoffset FROM urine_rate WHERE chartoffset IS NOT NULL
  UNION SELECT patientunitstayid, chartoffset FROM counted),
staged AS (
  SELECT p.uniquepid, p.patienthealthsystemstayid, p.patientunitstayid, m.chartoffset,
         c.creat_low_past_7day, c.creat_low_past_48hr, c.creat,
         {_creatinine_stage("c.creat", "c.creat_low_past_7day", "c.creat_low_past_48hr")} AS aki_stage_creat,
         u.uo_rt_6hr, u.uo_rt_12hr, u.uo_rt_24hr,
         CASE WHEN u.uo_rt_6hr IS NULL THEN NULL
              WHEN m.chartoffset <= 360 THEN 0
              WHEN u.uo_rt_24hr < 0.3 OR u.uo_rt_12hr = 0 THEN 3
              WHEN u.uo_rt_12hr < 0.5 THEN 2
              WHEN u.uo_rt_6hr < 0.5 THEN 1 ELSE 0 END AS aki_stage_uo,
         CASE WHEN d.patientunitstayid IS NOT NULL THEN 3 END AS aki_stage_dialysis
  FROM moments m JOIN patient p USING (patientunitstayid)
  LEFT JOIN creatinine c ON c.patientunitstayid = m.patientunitstayid AND c.labresultoffset = m.chartoffset
  LEFT JOIN urine_rate u ON u.patientunitstayid = m.patientunitstayid AND u.chartoffset = m.chartoffset
  LEFT JOIN counted d ON d.patientunitstayid = m.patientunitstayid AND d.chartoffset = m.chartoffset),
scored AS (
  SELECT *, greatest(ifnull(aki_stage_creat, 0), ifnull(aki_stage_uo, 0),
                     ifnull(aki_stage_dialysis, 0)) AS aki_stage
  FROM staged)"""


def _kdigo_stages(normalize: bool) -> str:
    return _query(
        """SELECT s.*, (SELECT MAX(e.aki_stage) FROM scored e
                        WHERE e.patientunitstayid = s.patientunitstayid
                          AND s.chartoffset - e.chartoffset BETWEEN 0 AND 360) AS aki_stage_smoothed
           FROM scored s""",
        *_sources(*dict.fromkeys(("lab", *WEIGHT_SOURCES, *DIALYSIS_SOURCES))),
        DIALYSIS,
        URINE,
        WEIGHTS,
        CREATININE,
        URINE_RATE,
        _stages(normalize),
    )


# --- Plans over tables that repeat stays, offsets and intervals ----------------------------


def _patients() -> list[str]:
    """All sources, but `patient` with some stays listed twice; `patient_once` as it was."""
    names = dict.fromkeys(("lab", *WEIGHT_SOURCES, *DIALYSIS_SOURCES))
    once = [c.replace("patient AS (", "patient_once AS (", 1) if n == "patient" else c for n, c in zip(names, _sources(*names)[1:])]
    twice = """patient AS (
  SELECT * FROM patient_once
  UNION ALL
  SELECT * REPLACE (patienthealthsystemstayid + 1000 AS patienthealthsystemstayid,
                    CAST(15000 AS BIGINT) AS unitdischargeoffset)
  FROM patient_once WHERE patientunitstayid % 5 = 0)"""
    return [EVENTS_SQL, *once, twice]


REPEATED = [
    URINE.replace("urine AS (", "urine_once AS (", 1),
    """urine AS (
  SELECT * FROM urine_once
  UNION ALL
  SELECT * REPLACE (urineoutput * 0.5 AS urineoutput) FROM urine_once WHERE chartoffset IS NULL OR chartoffset % 3 = 0)""",
    re.sub(r"\bpatient\b", "patient_once", WEIGHTS).replace("\nweights AS (", "\nweights_once AS ("),
    """weights AS (
  SELECT * FROM weights_once
  UNION ALL
  SELECT patientunitstayid, startoffset - 400, CASE WHEN patientunitstayid % 4 = 0 THEN endoffset + 900 END,
         weight + 7, weight_type
  FROM weights_once WHERE patientunitstayid % 2 = 0)""",
]


def _range_sums() -> str:
    sums = []
    for h in (6, 12, 24):
        frame = f"OVER (PARTITION BY patientunitstayid ORDER BY chartoffset NULLS LAST RANGE BETWEEN {60 * h} PRECEDING AND CURRENT ROW)"
        sums.append(f"SUM({_dec('urineoutput')}) {frame} AS vol_{h}, SUM(gap) {frame} AS min_{h}")
    return ", ".join(sums)


REPEATED_RATE = f"""urine_gaps AS (
  SELECT *, CASE WHEN previous IS NULL THEN 60 WHEN chartoffset IS NULL THEN 0
                 ELSE greatest(chartoffset - previous, 0) END AS gap
  FROM (SELECT u.*, lag(chartoffset) OVER (PARTITION BY patientunitstayid
                                           ORDER BY chartoffset NULLS LAST) AS previous
        FROM urine u JOIN patient USING (patientunitstayid))),
urine_frames AS (SELECT patientunitstayid, chartoffset, {_range_sums()} FROM urine_gaps),
urine_rate AS (
  SELECT f.patientunitstayid, f.chartoffset, w.weight,
         {", ".join(f"CAST(vol_{h} AS DOUBLE) AS urineoutput_{h}hr" for h in (6, 12, 24))},
         {", ".join(_uo_rate(h) for h in (6, 12, 24))},
         {", ".join(f"CAST(min_{h} AS DOUBLE) / 60 AS uo_tm_{h}hr" for h in (6, 12, 24))}
  FROM urine_frames f LEFT JOIN weights w ON w.patientunitstayid = f.patientunitstayid
   AND f.chartoffset >= w.startoffset AND (w.endoffset IS NULL OR f.chartoffset < w.endoffset))"""


def _stages_repeats() -> str:
    return _query(
        """SELECT s.*, MAX(aki_stage) OVER (PARTITION BY patientunitstayid ORDER BY chartoffset
                                            RANGE BETWEEN 360 PRECEDING AND CURRENT ROW) AS aki_stage_smoothed
           FROM scored s""",
        *_patients(),
        DIALYSIS,
        *REPEATED,
        CREATININE,
        REPEATED_RATE,
        _stages(False),
    )


# --- Single operators -------------------------------------------------------------------

SERIES = f"""series AS (
  SELECT sid AS user_id, off, SUM({_dec("v")}) AS total,
         CAST(SUM({_dec("v")}) AS DOUBLE) / COUNT(v) AS mean_value
  FROM ev GROUP BY ALL)"""

LOWS = """lows AS (
  SELECT s.user_id, s.off, ANY_VALUE(s.mean_value) AS mean_value,
         MIN(e.mean_value) FILTER (WHERE s.off - e.off <= 2880) AS low_48hr,
         MIN(e.mean_value) AS low_7day
  FROM series s LEFT JOIN series e
    ON e.user_id = s.user_id AND e.off < s.off AND e.off >= s.off - 10080
  GROUP BY s.user_id, s.off)"""

SUMS = "sums AS (\n  SELECT s.user_id, s.off, " + ", ".join(
    f"CAST(SUM(e.total) FILTER (WHERE s.off - e.off <= {60 * h}) AS DOUBLE) AS sum_{h}hr"
    for h in (6, 12, 24)
) + """
  FROM series s JOIN series e ON e.user_id = s.user_id AND s.off - e.off BETWEEN 0 AND 1440
  GROUP BY s.user_id, s.off)"""

SIGNUPS = """signup AS (
  SELECT sid AS user_id, off, MAX(v) AS v FROM ev WHERE et = 'signup' GROUP BY ALL),
signup_bounds AS (
  SELECT s.*, ifnull(p.unitadmitoffset, 0) AS admit, p.unitdischargeoffset AS discharge,
         (SELECT MIN(n.off) FROM signup n WHERE n.user_id = s.user_id AND n.off > s.off) AS later,
         MIN(s.off) OVER (PARTITION BY s.user_id) AS earliest
  FROM signup s JOIN patient p ON p.patientunitstayid = s.user_id),
signup_intervals AS (
  SELECT user_id, off AS startoffset, coalesce(later, ifnull(discharge, off) + 120) AS endoffset, v
  FROM signup_bounds
  UNION ALL
  SELECT user_id, admit - 120, off, v FROM signup_bounds WHERE off = earliest AND admit < off)"""


def _part_rule() -> str:
    r = PART_RULE
    without = " AND ".join(f"NOT contains(lower(path), {sql_text(x)})" for x in r["without"])
    like = " OR ".join(f"path LIKE {sql_text(x)}" for x in r["like"])
    return (
        f"path LIKE {sql_text(r['prefix'] + '%')} AND (path IN ({sql_list(r['exactly'])}) "
        f"OR (path LIKE {sql_text(r['starts'] + '%')} AND {without}) OR {like})"
    )


ORACLE: dict[str, str] = {
    "q1_mcs_events": _query(
        "SELECT patientunitstayid, label AS mechanical_support_type, chartoffset FROM mcs",
        *_sources("treatment", "nursecharting", "nurseassessment", "diagnosis"),
        MCS,
    ),
    "q2_dialysis_events": _query(
        "SELECT patientunitstayid, chartoffset, label AS dialysis_type FROM dialysis",
        *_sources(*DIALYSIS_SOURCES),
        DIALYSIS,
    ),
    "q3_urine_output": _query("SELECT * FROM urine", *_sources("intakeoutput"), URINE),
    "q4_weight_durations": _query("SELECT * FROM weights", *_sources(*WEIGHT_SOURCES), WEIGHTS),
    "q5_kdigo_creatinine": _query(
        "SELECT * FROM creatinine", *_sources("patient", "lab"), CREATININE
    ),
    "q6_kdigo_uo": _query(
        "SELECT * FROM urine_rate", *_sources(*WEIGHT_SOURCES), URINE, WEIGHTS, URINE_RATE
    ),
    "q7_kdigo_stages": _kdigo_stages(normalize=False),
    "q7_kdigo_stages_normalized": _kdigo_stages(normalize=True),
    "trailing_min_excl": _query("SELECT * FROM lows", EVENTS_SQL, SERIES, LOWS),
    "trailing_sum": _query("SELECT * FROM sums", EVENTS_SQL, SERIES, SUMS),
    "trailing_max": _query(
        """SELECT s.user_id, s.off, s.mean_value, MAX(e.mean_value) AS high_6hr
           FROM series s JOIN series e ON e.user_id = s.user_id AND s.off - e.off BETWEEN 0 AND 360
           GROUP BY ALL""",
        EVENTS_SQL,
        SERIES,
    ),
    "q5_kdigo_creatinine_repeats": _query("SELECT * FROM creatinine", *_patients(), CREATININE),
    "q6_kdigo_uo_repeats": _query("SELECT * FROM urine_rate", *_patients(), *REPEATED, REPEATED_RATE),
    "q7_kdigo_stages_repeats": _stages_repeats(),
    "gap_lag_ties": _query(
        """SELECT user_id, "at", v,
                  ifnull("at" - lag("at") OVER (PARTITION BY user_id ORDER BY "at", v), 60) AS gap
           FROM moments""",
        EVENTS_SQL,
        "moments AS (SELECT sid AS user_id, CAST(floor(off / 20) AS BIGINT) AS \"at\", v FROM ev)",
    ),
    "interval_join": _query(
        """SELECT c.sid AS user_id, c.off, c.k, s.v
           FROM ev c LEFT JOIN ev s
             ON s.et IN ('signup', 'error') AND s.sid = c.sid AND s.off <= c.off
            AND (s.k % 10 = 0 OR c.off < s.off + s.k * s.k)
           WHERE c.et = 'click'""",
        EVENTS_SQL,
    ),
    "align_series_repeats": _query(
        """SELECT user_id, hour, c.k AS click_k, e.k AS error_k, v.k AS view_k
           FROM (SELECT DISTINCT user_id, hour FROM kinds) LEFT JOIN (FROM kinds WHERE et = 'click') c USING (user_id, hour)
           LEFT JOIN (FROM kinds WHERE et = 'error') e USING (user_id, hour)
           LEFT JOIN (FROM kinds WHERE et = 'view') v USING (user_id, hour)""",
        EVENTS_SQL,
        """hours AS (SELECT sid AS user_id, CAST(floor(off / 60) AS BIGINT) AS hour, et, k FROM ev
                     WHERE k < 40 AND et IN ('click', 'error', 'view')),
           kinds AS (FROM hours UNION ALL FROM hours WHERE k % 4 = 0)""",
    ),
    "gap_lag": _query(
        """SELECT user_id, off,
                  ifnull(off - lag(off) OVER (PARTITION BY user_id ORDER BY off), 60) AS gap_minutes
           FROM moments""",
        EVENTS_SQL,
        "moments AS (SELECT DISTINCT sid AS user_id, off FROM ev)",
    ),
    "interval_build": _query("SELECT * FROM signup_intervals", *_sources("patient"), SIGNUPS),
    "interval_lookup": _query(
        """SELECT c.user_id, c.off, c.clicks, i.v
           FROM clicks c LEFT JOIN signup_intervals i
             ON i.user_id = c.user_id AND i.startoffset <= c.off AND c.off < i.endoffset""",
        *_sources("patient"),
        SIGNUPS,
        "clicks AS (SELECT sid AS user_id, off, COUNT(*) AS clicks FROM ev WHERE et = 'click' GROUP BY ALL)",
    ),
    "near_event_or_absent": _query(
        """SELECT sid AS user_id, off, COUNT(*) AS clicks FROM ev c
           WHERE et = 'click' AND (
             EXISTS (SELECT 1 FROM ev e WHERE e.et = 'error' AND e.sid = c.sid AND abs(e.off - c.off) <= 720)
             OR sid NOT IN (SELECT sid FROM ev WHERE et = 'signup'))
           GROUP BY ALL""",
        EVENTS_SQL,
    ),
    "label_exact": f"""SELECT o_orderkey, o_orderpriority, label
        FROM orders JOIN {_vocabulary(PRIORITY_LABELS)} ON o_orderpriority = charted""",
    "text_rules": f"""SELECT p_partkey, path, CASE WHEN {_part_rule()} THEN 1 ELSE 0 END AS included
        FROM (SELECT p_partkey, p_type || '|' || p_name AS path FROM part)""",
    "case_insensitive": """SELECT p_partkey, name, kind FROM (
          SELECT p_partkey, lower(p_type) AS kind,
                 array_to_string(list_transform(string_split(p_name, ' '),
                   lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name
          FROM part)
        WHERE name ILIKE 'red ring' OR kind IN ('promo', 'small')""",
    "regex_number": r"""SELECT event_id,
          TRY_CAST(nullif(regexp_extract(note, '[0-9]+(\.[0-9]+)?'), '') AS DOUBLE) AS note_number,
          TRY_CAST(nullif(regexp_extract(props, '[0-9]+(\.[0-9]+)?'), '') AS DOUBLE) AS k
        FROM (SELECT event_id, props, CASE WHEN user_id % 7 = 0 THEN event_type
                ELSE 'wt ' || props || '.' || event_id || ' kg 9.5' END AS note FROM events)""",
    "unit_convert_bounds": _query(
        f"""SELECT * FROM (
              SELECT sid AS user_id, off,
                     CASE WHEN k % 2 = 1 THEN v * CAST({vocab.KILOGRAMS_PER_POUND} AS DOUBLE) ELSE v END AS weight
              FROM ev) WHERE weight >= 20 AND weight <= 1000""",
        EVENTS_SQL,
    ),
    "coalesce_offsets_distinct": _query(
        """SELECT user_id, ifnull(documented, entered) AS hour
           FROM (SELECT sid AS user_id,
                        CASE WHEN et <> 'error' THEN CAST(floor(off / 60) AS BIGINT) END AS documented,
                        CAST(floor((off + k) / 60) AS BIGINT) AS entered
                 FROM ev WHERE et <> 'signup' AND k <> 0
                 GROUP BY ALL)""",
        EVENTS_SQL,
    ),
    "group_sum_avg": f"""SELECT l_returnflag, l_linestatus,
          CAST(SUM({_dec("l_quantity")}) AS DOUBLE) AS sum_qty,
          CAST(SUM({_dec("l_extendedprice")}) AS DOUBLE) AS sum_price,
          CAST(SUM({_dec("l_extendedprice")}) AS DOUBLE) / COUNT(l_extendedprice) AS avg_price
        FROM lineitem GROUP BY ALL""",
    "semi_join": """SELECT o_orderkey, o_custkey AS c_custkey,
          CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
               THEN 1 ELSE 0 END AS ever_f
        FROM orders WHERE EXISTS (
          SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal IS NOT NULL)""",
    "align_series": _query(
        "SELECT user_id, off, "
        + ", ".join(
            f"CAST(SUM({_dec('v')}) FILTER (WHERE et = '{t}') AS DOUBLE) AS {t}_value"
            for t in ("click", "error", "view")
        )
        + " FROM (SELECT sid AS user_id, off, et, v FROM ev WHERE et IN ('click', 'error', 'view')) GROUP BY user_id, off",
        EVENTS_SQL,
    ),
    "stage_cascade": _query(
        f"SELECT user_id, off, {_creatinine_stage('mean_value', 'low_7day', 'low_48hr')} AS stage FROM lows",
        EVENTS_SQL,
        SERIES,
        LOWS,
    ),
    "creatinine_decimal": _query(
        """SELECT patientunitstayid, labresultoffset, c AS tenths,
             CASE WHEN low_7day IS NULL THEN NULL
                  WHEN c >= 3 * low_7day OR (c >= 40 AND (low_48hr <= 37 OR 2 * c >= 3 * low_7day)) THEN 3
                  WHEN c >= 2 * low_7day THEN 2
                  WHEN c >= low_48hr + 3 OR 2 * c >= 3 * low_7day THEN 1
                  ELSE 0 END::INTEGER AS stage
           FROM (SELECT t.*,
                   MIN(c) OVER (PARTITION BY patientunitstayid ORDER BY labresultoffset
                                RANGE BETWEEN 2880 PRECEDING AND 1 PRECEDING) AS low_48hr,
                   MIN(c) OVER (PARTITION BY patientunitstayid ORDER BY labresultoffset
                                RANGE BETWEEN 10080 PRECEDING AND 1 PRECEDING) AS low_7day
                 FROM tenths t)""",
        *_sources("patient"),
        """tenths AS (
          SELECT sid AS patientunitstayid, off AS labresultoffset, max(k)::BIGINT + 5 AS c
          FROM ev JOIN patient ON patientunitstayid = sid
          WHERE et = 'view' AND off BETWEEN -10080 AND ifnull(unitdischargeoffset, off) GROUP BY ALL)""",
    ),
    "guarded_rate": _query(
        """SELECT user_id, off,
             CASE WHEN user_id % 50 > 0 AND abs(off % 1440) >= 360
                  THEN CAST(round(CAST(sum_24hr / (user_id % 50) / (abs(off % 1440) / CAST(60 AS DOUBLE))
                                       AS DECIMAL(28, 12)), 4) AS DOUBLE) END AS rate
           FROM sums""",
        EVENTS_SQL,
        SERIES,
        SUMS,
    ),
    "project_const_sort": """SELECT c_custkey AS patientunitstayid,
          CAST(CAST(c_acctbal AS DECIMAL(18, 4)) AS DOUBLE) AS balance, 'admit' AS weight_type
        FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal >= 5000
        ORDER BY 1, 2""",
}
