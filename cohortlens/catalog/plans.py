"""Queries over calendar, gates, cohorts and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import FEATURES, view, with_views
from ..plans import calendar as C
from ..plans import cohorts as K
from ..plans import outcomes as O
from ..plans.dimensions import POPULATIONS, STAGES, scored_campuses
from .registry import (
    COMPLETE, RUN_DATE, SQL_CALENDAR, SQL_CONTRIB, SQL_PROB, calendar, cohort, contributions, query, r6,
    scored_complete,
)
from .relational import ROUTED, SNAP

NAMES = ["emplid", "enrl_ind", *FEATURES]
GATE_VIEWS = with_views("fx_term", "fx_run_days", "fx_stage_registration")
STAGE_VALUES = "stages AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', '{s}', {p}, '{g}', '{w}', {'NULL' if r is None else r}, {m})" for t, s, p, g, w, r, m in STAGES
) + ") v(term_type, stage, priority, gate_column, window_column, required_rank, model_id))"
PICK = "CASE {c} WHEN 'term_begin_dt' THEN c.term_begin_dt WHEN 'term_census_dt' THEN c.term_census_dt " \
       "WHEN 'term_midterm_dt' THEN c.term_midterm_dt WHEN 'term_end_dt' THEN c.term_end_dt END"
SQL_GATES = f"""{GATE_VIEWS}, {SQL_CALENDAR}, {STAGE_VALUES},
snaps AS (SELECT strm, max({SNAP}) AS snap_order FROM fx_stage_registration
          WHERE acad_career = 'UGRD' AND substr(strm, 4, 1) <> '9' GROUP BY strm),
ranks AS (SELECT c.strm, (SELECT max_by(s.snap_order, s.strm) FROM snaps s WHERE s.strm <= c.strm) AS snap_order FROM cal c),
gates AS (SELECT d.as_of, c.term_type, c.strm, g.stage, g.priority, g.model_id, {PICK.format(c='g.gate_column')} AS gate_dt, r.snap_order,
                 coalesce(d.as_of >= {PICK.format(c='g.gate_column')}, false) AS date_reached,
                 g.required_rank IS NULL OR coalesce(r.snap_order = g.required_rank, false) AS snapshot_ok,
                 coalesce(d.as_of <= {PICK.format(c='g.window_column')}, false) AS in_window
          FROM fx_run_days d JOIN cal c ON d.as_of BETWEEN c.term_begin_dt AND c.term_end_dt
          JOIN stages g ON g.term_type = c.term_type JOIN ranks r ON r.strm = c.strm),
judged AS (SELECT *, CASE WHEN NOT in_window THEN 'no term' WHEN NOT date_reached THEN 'date exception'
                          WHEN NOT snapshot_ok THEN 'snapshot exception' ELSE 'open' END AS status FROM gates)"""


@query("academic_calendar", f"{with_views('fx_term')}, {SQL_CALENDAR} SELECT * REPLACE ("
       + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("term_begin_dt", "term_census_dt", "term_midterm_dt", "term_eot_dt", "term_end_dt"))
       + ") FROM cal")
def academic_calendar(spark, sf):
    return calendar(spark, sf)


def _sql_cohort(train: str, test: str) -> str:
    cols = ", ".join(FEATURES)
    return f"""{COMPLETE} SELECT split, emplid, CASE WHEN split <> 'testing' THEN enrl_ind END AS enrl_ind, {cols}
FROM complete WHERE CASE WHEN split = 'testing' THEN {test} ELSE {train} END"""


@query("campus_cohort", _sql_cohort(*["adj_acad_prog_primary_campus = 'PULLM'"] * 2))
def campus_cohort(spark, sf):
    return K.campus_cohort(cohort(spark, sf), NAMES, ["PULLM"])


@query("system_cohort", _sql_cohort("true", "adj_acad_prog_primary_campus IN ('EVERE', 'TRICI', 'SPOKA', 'ONLIN')"))
def system_cohort(spark, sf):
    return K.system_cohort(cohort(spark, sf), NAMES, scored_campuses("PVTU", "U"))


@query("pred_outcome", f"""{COMPLETE},
s AS (SELECT emplid, {SQL_PROB} AS p, (least(greatest((fall_lec_count - 10) / 10.0, -1.0), 1.0) + 1) / 2 AS q FROM complete WHERE split = 'testing')
SELECT emplid, round(p, 6) AS lr_prob, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INT) AS lr_pred,
  round(q, 6) AS sgd_prob, CAST(CASE WHEN q > 0.5 THEN 1 ELSE 0 END AS INT) AS sgd_pred,
  round((p + q) / 2, 6) AS vcf_prob, CAST(CASE WHEN (p + q) / 2 > 0.5 THEN 1 ELSE 0 END AS INT) AS vcf_pred FROM s""")
def pred_outcome(spark, sf):
    from ..models.linear import huber_probability, soft_vote

    df = scored_complete(spark, sf).where("split = 'testing'").withColumn("q", huber_probability((F.col("fall_lec_count") - 10) / 10.0))
    out = O.pred_outcome(df.withColumn("v", soft_vote("prob", "q")), {"lr": "prob", "sgd": "q", "vcf": "v"})
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("_prob")})


@query("aggregate_outcome", f"""{COMPLETE}
SELECT lpad(CAST(emplid AS VARCHAR), 9, '0') AS emplid, male AS sex_ind, underrep_minority AS underrep_minority_ind,
  CAST(CASE first_gen_flag WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS INT) AS first_gen_ind, resident AS resident_ind,
  round(1 - round_even({SQL_PROB}, 4), 6) AS risk_prob, CASE male WHEN 1 THEN 'Male' WHEN 0 THEN 'Female' END AS sex_descr,
  CASE underrep_minority WHEN 1 THEN 'Minority' WHEN 0 THEN 'Non-minority' END AS underrep_minority_descr,
  CASE resident WHEN 1 THEN 'Resident' WHEN 0 THEN 'non-Resident' END AS resident_descr,
  CASE first_gen_flag WHEN 'Y' THEN 'non-First Gen' WHEN 'N' THEN 'First Gen' END AS first_gen_descr
FROM complete WHERE split = 'testing'""")
def aggregate_outcome(spark, sf):
    return O.aggregate_outcome(scored_complete(spark, sf).where("split = 'testing'")).withColumn("risk_prob", r6("risk_prob"))


@query("student_outcome", f"""{COMPLETE}
SELECT lpad(CAST(emplid AS VARCHAR), 9, '0') AS emplid, round(1 - round_even({SQL_PROB}, 4), 6) AS risk_prob,
  CASE WHEN split = 'testing' THEN '2001-08-01' ELSE '2001-07-01' END AS date, CAST(CASE WHEN split = 'testing' THEN 2 ELSE 1 END AS INT) AS model_id
FROM complete WHERE split <> 'training'""")
def student_outcome(spark, sf):
    import datetime

    from ..session import fresh_path
    from ..sources import append_with_backup, read_history

    df = scored_complete(spark, sf)
    root = fresh_path(spark, "outcome")
    append_with_backup(O.student_outcome(df.where("split = 'validation'"), datetime.date(2001, 7, 1), 1), root)
    append_with_backup(O.student_outcome(df.where("split = 'testing'"), RUN_DATE, 2), root)
    both = read_history(spark, root)
    return both.withColumn("risk_prob", r6("risk_prob"))


@query("stage_gate", f"""{SQL_GATES} SELECT CAST(as_of AS VARCHAR) AS as_of, term_type, strm, stage, CAST(priority AS INT) AS priority,
  CAST(model_id AS INT) AS model_id, CAST(gate_dt AS VARCHAR) AS gate_dt, CAST(snap_order AS INT) AS snap_order, date_reached, snapshot_ok, status FROM judged""")
def stage_gate(spark, sf):
    return C.stage_gate(view(spark, sf, "fx_run_days"), calendar(spark, sf), view(spark, sf, "fx_stage_registration"))


@query("run_plan", f"""{SQL_GATES},
pops AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{p}')" for i, p, _ in POPULATIONS)}) v(run_order, model_descr)),
first_open AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY priority) AS rn FROM judged WHERE status = 'open') t WHERE rn = 1)
SELECT CAST(as_of AS VARCHAR) AS as_of, term_type, strm, stage, CAST(model_id AS INT) AS model_id, CAST(run_order AS INT) AS run_order, model_descr
FROM first_open CROSS JOIN pops""")
def run_plan(spark, sf):
    return C.run_plan(view(spark, sf, "fx_run_days"), calendar(spark, sf), view(spark, sf, "fx_stage_registration"))


@query("retrain_plan", f"""{with_views('fx_term', 'fx_run_days')}, {SQL_CALENDAR}
SELECT CAST(as_of AS VARCHAR) AS as_of, strm, term_type, as_of = term_begin_dt OR dayofweek(as_of) = 6 AS refit
FROM fx_run_days JOIN cal ON as_of BETWEEN term_begin_dt AND term_end_dt""")
def retrain_plan(spark, sf):
    return C.retrain_plan(view(spark, sf, "fx_run_days"), calendar(spark, sf))


@query("route_units", f"{ROUTED} SELECT unit, split, emplid, adj_acad_prog_primary_campus FROM routed")
def route_units(spark, sf):
    return K.route_units(cohort(spark, sf)).select("unit", "split", "emplid", "adj_acad_prog_primary_campus")


@query("unit_cohorts", f"""{ROUTED} SELECT unit, split, emplid, CASE WHEN split <> 'testing' THEN enrl_ind END AS enrl_ind, {', '.join(FEATURES)}
FROM routed WHERE unmet_need_ofr IS NOT NULL AND high_school_gpa IS NOT NULL""")
def unit_cohorts(spark, sf):
    return K.unit_cohorts(cohort(spark, sf), NAMES)


@query("shap_topn_table", f"""{SQL_CONTRIB} SELECT lpad(CAST(emplid AS VARCHAR), 9, '0') AS emplid, """ + ", ".join(
    f"max(CASE WHEN rank = {k} THEN feature END) AS shap_descr_{k}, max(CASE WHEN rank = {k} THEN round_even(value, 4) + 0.0 END) AS shap_value_{k}"
    for k in range(1, 6)) + ", '2001-08-01' AS date, CAST(2 AS INT) AS model_id FROM ranked WHERE split = 'testing' GROUP BY emplid")
def shap_topn_table(spark, sf):
    df = contributions(spark, sf).where("split = 'testing'")
    # A repeated id keeps its last explanation: the first copy is blank and must lose.
    blank = df.select("emplid", "split", F.filter("contributions", lambda c: F.lit(False)).alias("contributions"))
    twice = blank.withColumn("seq", F.lit(1)).unionByName(df.withColumn("seq", F.lit(2)))
    out = O.student_shap(twice.drop("split"), 5, RUN_DATE, 2, seq="seq")
    return out.withColumns({f"shap_value_{k}": F.col(f"shap_value_{k}") + F.lit(0.0) for k in range(1, 6)})
