"""Queries over sources, projections, filters, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import FEATURES, load, view, with_views
from ..models.grouped import residual, vif
from ..operators import relational as R
from ..operators.metrics import group_metrics
from ..plans.calendar import term_as_of
from ..plans.cohorts import route_units
from ..plans.dimensions import unit_rows
from ..session import fresh_path
from ..sources import append_run, append_with_backup, nested_topn, read_history, scan_calendar, scan_splits, scan_table, write_replace
from .registry import (
    AS_OF_YEAR, COHORT, COMPLETE, SQL_CALENDAR, SQL_CONTRIB, SQL_PROB, calendar, cohort, complete, contributions,
    probability, query, r6,
)

TERM = with_views("fx_term")
REG = with_views("fx_registration")
SCORED = with_views("fx_scored")
UNIT_VALUES = "unit_dim AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{u}', '{c}', {str(t).lower()}, {str(s).lower()})" for u, c, t, s in unit_rows("PVTU")
) + ") v(unit, campus, trains, scores))"
ROUTED = f"""{COHORT}, {UNIT_VALUES},
routed AS (SELECT u.unit, c.* FROM fx_cohort c JOIN unit_dim u ON c.adj_acad_prog_primary_campus = u.campus
           WHERE CASE WHEN c.split = 'testing' THEN u.scores ELSE u.trains END)"""


# --- sources and sinks -------------------------------------------------------------------------

@query("scan_splits", f"{COHORT} SELECT split, emplid, enrl_ind, adj_acad_prog_primary_campus, male FROM fx_cohort")
def scan_splits_q(spark, sf):
    path = fresh_path(spark, "splits")
    df = cohort(spark, sf)
    df.write.partitionBy("split").parquet(path)
    return scan_splits(spark, path, df.schema).select("split", "emplid", "enrl_ind", "adj_acad_prog_primary_campus", "male")


@query("scan_calendar_csv", f"""{TERM}, {SQL_CALENDAR}
SELECT strm, term_type, CAST(term_begin_dt AS VARCHAR) AS term_begin_dt, CAST(term_midterm_dt AS VARCHAR) AS term_midterm_dt,
       CAST(term_end_dt AS VARCHAR) AS term_end_dt, begin_week FROM cal""")
def scan_calendar_csv(spark, sf):
    path = fresh_path(spark, "calendar")
    df = calendar(spark, sf).select("strm", "term_type", "term_begin_dt", "term_midterm_dt", "term_end_dt", "begin_week")
    write_replace(df, path, "csv", header="true", dateFormat="MM-dd-yyyy")
    return scan_calendar(spark, path, df.schema)


@query("scan_registration", f"{REG} SELECT class_nbr, strm, snapshot FROM fx_registration WHERE acad_career = 'UGRD'")
def scan_registration(spark, sf):
    view(spark, sf, "fx_registration").createOrReplaceTempView("class_registration")
    return scan_table(spark, "class_registration", ["class_nbr", "strm", "snapshot"], "acad_career = 'UGRD'")


@query("write_replace", f"{COHORT} SELECT emplid, enrl_ind, high_school_gpa FROM fx_cohort")
def write_replace_q(spark, sf):
    path = fresh_path(spark, "replace")
    df = cohort(spark, sf)
    write_replace(df.select("emplid"), path)
    write_replace(df.select("emplid", "enrl_ind", "high_school_gpa"), path)
    return spark.read.parquet(path)


@query("append_table", f"""{COHORT}
SELECT emplid, enrl_ind, CASE WHEN split = 'testing' THEN '2001-08-01' ELSE '2001-07-01' END AS date,
       CAST(CASE WHEN split = 'testing' THEN 2 ELSE 1 END AS INT) AS model_id FROM fx_cohort""")
def append_table(spark, sf):
    path = fresh_path(spark, "runs")
    df = cohort(spark, sf).select("emplid", "enrl_ind", "split")
    for keep, day, model in (("split <> 'testing'", "2001-07-01", 1), ("split = 'testing'", "2001-08-01", 2)):
        run = df.where(keep).drop("split").withColumns({"date": F.lit(day).cast("date"), "model_id": F.lit(model)})
        append_run(run, path)
    return spark.read.parquet(path)


@query("append_with_backup", f"""{COHORT}
SELECT 'history' AS stored, emplid, CAST(CASE WHEN male = 0 THEN 1 ELSE 2 END AS INT) AS run FROM fx_cohort
UNION ALL SELECT 'backup', emplid, CAST(1 AS INT) FROM fx_cohort WHERE male = 0""")
def append_with_backup_q(spark, sf):
    root, df = fresh_path(spark, "history"), cohort(spark, sf)
    append_with_backup(df.where("male = 0").select("emplid", F.lit(1).alias("run")), root)
    version = append_with_backup(df.where("male = 1").select("emplid", F.lit(2).alias("run")), root)
    history, saved = read_history(spark, root), read_history(spark, root, version - 1)
    return history.withColumn("stored", F.lit("history")).unionByName(saved.withColumn("stored", F.lit("backup")))


@query("export_nested_topn", f"{SQL_CONTRIB} SELECT emplid, rank, feature, round(value, 6) + 0.0 AS value FROM ranked WHERE rank <= 5")
def export_nested_topn(spark, sf):
    path = fresh_path(spark, "nested")
    df = contributions(spark, sf).select("emplid", nested_topn(R.ranked("contributions"), 5).alias("shap_values"))
    write_replace(df, path, "json")
    kind = "array<struct<feature:string,value:double>>"
    back = spark.read.schema("emplid long, shap_values string").json(path).withColumn("c", F.from_json("shap_values", kind))
    return R.rank_long(back, ["emplid"], "c").withColumn("value", r6("value"))


# --- projections and filters -------------------------------------------------------------------

@query("select_features", f"{COHORT} SELECT emplid, enrl_ind, {', '.join(FEATURES)} FROM fx_cohort")
def select_features(spark, sf):
    return R.select_features(cohort(spark, sf), ["emplid", "enrl_ind", *FEATURES])


@query("exclude_vars", f"{COHORT} SELECT {', '.join(FEATURES)} FROM fx_cohort")
def exclude_vars(spark, sf):
    return R.select_features(cohort(spark, sf), R.exclude_vars(["emplid", "enrl_ind", *FEATURES]))


@query("campus_filter", f"{COHORT} SELECT emplid, adj_acad_prog_primary_campus FROM fx_cohort WHERE adj_acad_prog_primary_campus IN ('EVERE', 'SPOKA')")
def campus_filter(spark, sf):
    return R.campus_filter(cohort(spark, sf), ["EVERE", "SPOKA"]).select("emplid", "adj_acad_prog_primary_campus")


@query("complete_cases", f"{COMPLETE} SELECT emplid, unmet_need_ofr, high_school_gpa FROM complete")
def complete_cases(spark, sf):
    return R.complete_cases(cohort(spark, sf), ["emplid", "enrl_ind", *FEATURES]).select("emplid", "unmet_need_ofr", "high_school_gpa")


@query("drop_columns", f"{COHORT} SELECT {', '.join(FEATURES)}, split FROM fx_cohort")
def drop_columns(spark, sf):
    return cohort(spark, sf).drop("emplid", "enrl_ind", "adj_acad_prog_primary_campus")


@query("rename_columns", f"{COHORT} SELECT emplid, male AS sex_ind, underrep_minority AS underrep_minority_ind, resident AS resident_ind FROM fx_cohort")
def rename_columns(spark, sf):
    names = {"male": "sex_ind", "underrep_minority": "underrep_minority_ind", "resident": "resident_ind"}
    return cohort(spark, sf).withColumnsRenamed(names).select("emplid", *names.values())


@query("label_case", f"""{COHORT} SELECT emplid, CASE male WHEN 1 THEN 'Male' WHEN 0 THEN 'Female' END AS sex_descr,
CASE adj_acad_prog_primary_campus WHEN 'PULLM' THEN 'Main' END AS campus_descr FROM fx_cohort""")
def label_case(spark, sf):
    return cohort(spark, sf).select(
        "emplid", R.label_case("male", {1: "Male", 0: "Female"}).alias("sex_descr"),
        R.label_case("adj_acad_prog_primary_campus", {"PULLM": "Main"}).alias("campus_descr"),
    )


@query("where_on_read", f"{TERM} SELECT acad_career, strm, term_year FROM fx_term WHERE acad_career = 'UGRD' AND term_year <= 1999")
def where_on_read(spark, sf):
    return R.where_on_read(view(spark, sf, "fx_term"), 1999).select("acad_career", "strm", "term_year")


@query("distinct_scan", f"{REG} SELECT DISTINCT strm, snapshot FROM fx_registration")
def distinct_scan(spark, sf):
    return view(spark, sf, "fx_registration").select("strm", "snapshot").distinct()


@query("surrogate_row_id", f"{COMPLETE} SELECT emplid, row_number() OVER (ORDER BY emplid) - 1 AS ordinal FROM complete")
def surrogate_row_id(spark, sf):
    return R.row_ordinal(complete(spark, sf).select("emplid"), ["emplid"])


@query("fill_sentinel", f"{COHORT} SELECT emplid, coalesce(unmet_need_ofr, 9999) AS unmet_need_ofr, coalesce(high_school_gpa, 9999) AS high_school_gpa FROM fx_cohort")
def fill_sentinel(spark, sf):
    return R.fill_sentinel(cohort(spark, sf).select("emplid", "unmet_need_ofr", "high_school_gpa"))


@query("date_gate", f"""{with_views('fx_term', 'fx_run_days')}, {SQL_CALENDAR}
SELECT CAST(as_of AS VARCHAR) AS as_of, strm, coalesce(as_of >= term_midterm_dt, false) AS reached
FROM fx_run_days JOIN cal ON as_of BETWEEN term_begin_dt AND term_end_dt""")
def date_gate(spark, sf):
    cal = calendar(spark, sf)
    days = term_as_of(view(spark, sf, "fx_run_days"), cal).select("as_of", "strm")
    return days.join(cal.select("strm", "term_midterm_dt"), "strm").select(
        "as_of", "strm", R.date_gate("as_of", "term_midterm_dt").alias("reached")
    )


# --- joins -------------------------------------------------------------------------------------

@query("calendar_next_term", f"""{TERM} SELECT acad_career, strm,
CAST(CAST(lead(term_begin_dt) OVER (PARTITION BY acad_career ORDER BY strm) AS DATE) AS VARCHAR) AS next_begin FROM fx_term""")
def calendar_next_term(spark, sf):
    df = R.next_in_group(view(spark, sf, "fx_term"), "acad_career", "strm", "term_begin_dt", "next_begin")
    return df.select("acad_career", "strm", F.to_date("next_begin").alias("next_begin"))


@query("attach_residual", f"""{COMPLETE},
fit AS (SELECT split, regr_slope(fall_lec_count, fall_withdrawn_hours) AS b, regr_intercept(fall_lec_count, fall_withdrawn_hours) AS a
        FROM complete GROUP BY split),
res AS (SELECT c.emplid, c.fall_lec_count - (f.a + f.b * c.fall_withdrawn_hours) AS residual FROM complete c JOIN fit f ON c.split = f.split)
SELECT x.emplid, round(r.residual, 6) + 0.0 AS residual FROM fx_cohort x LEFT JOIN res r ON x.emplid = r.emplid""")
def attach_residual(spark, sf):
    df = cohort(spark, sf)
    usable = F.col("unmet_need_ofr").isNotNull() & F.col("high_school_gpa").isNotNull()
    # Incomplete rows have no instrument: hide the outcome there.
    masked = df.withColumn("outcome", F.when(usable, F.col("fall_lec_count").cast("double")))
    return residual(masked, "outcome", ["fall_withdrawn_hours"], "residual", ["split"]).select("emplid", r6("residual").alias("residual"))


@query("term_as_of", f"""{with_views('fx_term', 'fx_run_days')}, {SQL_CALENDAR}
SELECT 'end' AS until, CAST(as_of AS VARCHAR) AS as_of, strm, term_type FROM fx_run_days JOIN cal ON as_of BETWEEN term_begin_dt AND term_end_dt
UNION ALL
SELECT 'midterm', CAST(as_of AS VARCHAR), strm, term_type FROM fx_run_days JOIN cal ON as_of BETWEEN term_begin_dt AND term_midterm_dt""")
def term_as_of_q(spark, sf):
    days, cal = view(spark, sf, "fx_run_days"), calendar(spark, sf)
    hits = [
        term_as_of(days, cal, end=col).select(F.lit(name).alias("until"), "as_of", "strm", "term_type")
        for name, col in (("end", "term_end_dt"), ("midterm", "term_midterm_dt"))
    ]
    return hits[0].unionByName(hits[1])


@query("attach_scores", f"{COMPLETE} SELECT emplid, round({SQL_PROB}, 6) AS prob FROM complete WHERE split = 'testing'")
def attach_scores(spark, sf):
    return complete(spark, sf).where("split = 'testing'").select("emplid", r6(probability()).alias("prob"))


@query("last_wins_dedup", """SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) t WHERE rn = 1""")
def last_wins_dedup(spark, sf):
    df = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    return R.last_wins(df, "o_custkey", "o_orderkey")


@query("removed_rows_anti", f"{COHORT} SELECT emplid, split FROM fx_cohort WHERE unmet_need_ofr IS NULL OR high_school_gpa IS NULL")
def removed_rows_anti(spark, sf):
    return R.removed_rows(cohort(spark, sf).select("emplid", "split"), complete(spark, sf), ["emplid"])


@query("scalar_subquery_filter", f"""{REG} SELECT class_nbr, strm, snapshot FROM fx_registration WHERE acad_career = 'UGRD'
AND strm = (SELECT max(strm) FROM fx_registration WHERE acad_career = 'UGRD' AND substr(strm, 4, 1) <> '9')""")
def scalar_subquery_filter(spark, sf):
    return R.in_latest_term(view(spark, sf, "fx_registration")).select("class_nbr", "strm", "snapshot")


# --- aggregates --------------------------------------------------------------------------------

SNAP = "CASE snapshot WHEN 'census' THEN 1 WHEN 'midterm' THEN 2 WHEN 'eot' THEN 3 ELSE 0 END"


@query("snapshot_rank_max", f"""{with_views('fx_stage_registration')}
SELECT strm, CAST(max({SNAP}) AS INT) AS snap_order FROM fx_stage_registration WHERE acad_career = 'UGRD' GROUP BY strm""")
def snapshot_rank_max(spark, sf):
    return R.snapshot_rank(view(spark, sf, "fx_stage_registration").where("acad_career = 'UGRD'"), ["strm"])


@query("latest_term", f"{REG} SELECT max(strm) AS strm FROM fx_registration WHERE acad_career = 'UGRD' AND substr(strm, 4, 1) <> '9'")
def latest_term(spark, sf):
    return R.latest_term(view(spark, sf, "fx_registration"))


@query("class_weight", f"""{ROUTED},
n AS (SELECT unit, CAST(sum(1 - enrl_ind) AS BIGINT) AS n0, CAST(sum(enrl_ind) AS BIGINT) AS n1 FROM routed WHERE split = 'training' GROUP BY unit)
SELECT unit, n0, n1, round(n0 / CAST(n1 AS DOUBLE), 6) AS pos_weight, round((n0 + n1) / CAST(2 * n0 AS DOUBLE), 6) AS balanced_0,
       round((n0 + n1) / CAST(2 * n1 AS DOUBLE), 6) AS balanced_1 FROM n""")
def class_weight(spark, sf):
    routed = route_units(cohort(spark, sf).select("adj_acad_prog_primary_campus", "split", "enrl_ind")).where("split = 'training'")
    out = R.class_weight(routed, "enrl_ind", ["unit"])
    return out.select("unit", "n0", "n1", *[r6(c).alias(c) for c in ("pos_weight", "balanced_0", "balanced_1")])


@query("group_metrics", f"""{SCORED},
m AS (SELECT male, underrep_minority, count(*) AS headcount,
  count(CASE WHEN y_true = 0 AND prob <= 0.5 THEN 1 END) AS tn, count(CASE WHEN y_true = 0 AND prob > 0.5 THEN 1 END) AS fp,
  count(CASE WHEN y_true = 1 AND prob <= 0.5 THEN 1 END) AS fn, count(CASE WHEN y_true = 1 AND prob > 0.5 THEN 1 END) AS tp
  FROM fx_scored GROUP BY male, underrep_minority)
SELECT *, round((tp + tn) / CAST(headcount AS DOUBLE), 6) AS accuracy, round(tp / CAST(tp + fn AS DOUBLE), 6) AS tpr,
  round(tn / CAST(tn + fp AS DOUBLE), 6) AS tnr, round((tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2, 6) AS balanced FROM m""")
def group_metrics_q(spark, sf):
    df = view(spark, sf, "fx_scored").withColumn("pred", (F.col("prob") > 0.5).cast("int"))
    out = group_metrics(df, "y_true", "pred", ["male", "underrep_minority"])
    return out.withColumns({c: r6(c) for c in ("accuracy", "tpr", "tnr", "balanced")})


@query("column_profile", f"{COHORT} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'text' AS kind" if c in ("first_gen_flag", "parent1_highest_educ_lvl") else
    f"SELECT '{c}', CASE WHEN bool_and(coalesce({c} IN (0, 1), false)) THEN 'binary' ELSE 'continuous' END FROM fx_cohort"
    for c in FEATURES))
def column_profile(spark, sf):
    return R.column_profile(cohort(spark, sf), FEATURES)


@query("headcount", f"{SCORED} SELECT male, underrep_minority, count(*) AS headcount FROM fx_scored GROUP BY male, underrep_minority")
def headcount(spark, sf):
    return view(spark, sf, "fx_scored").groupBy("male", "underrep_minority").agg(F.count("*").alias("headcount"))


# --- sorts, windows, top-k, reshape ------------------------------------------------------------

@query("sort_by_keys", f"{TERM} SELECT acad_career, strm, term_type FROM fx_term ORDER BY acad_career, strm")
def sort_by_keys(spark, sf):
    return view(spark, sf, "fx_term").select("acad_career", "strm", "term_type").orderBy("acad_career", "strm")


@query("running_index", f"""{TERM} SELECT acad_career, strm, row_number() OVER (PARTITION BY acad_career ORDER BY strm) AS idx
FROM fx_term WHERE term_year <= {AS_OF_YEAR}""")
def running_index(spark, sf):
    terms = view(spark, sf, "fx_term").where(F.col("term_year") <= AS_OF_YEAR).select("acad_career", "strm")
    return R.running_index(terms, ["acad_career"], ["strm"])


@query("rank_abs_contrib", f"{SQL_CONTRIB} SELECT emplid, rank, feature, round(value, 6) + 0.0 AS value FROM ranked")
def rank_abs_contrib(spark, sf):
    df = contributions(spark, sf).withColumn("r", R.ranked("contributions"))
    return R.rank_long(df, ["emplid"], "r").withColumn("value", r6("value"))


@query("top_n_contrib", f"{SQL_CONTRIB} SELECT emplid, rank, feature FROM ranked WHERE rank <= 5")
def top_n_contrib(spark, sf):
    df = contributions(spark, sf).withColumn("r", R.ranked("contributions"))
    return R.rank_long(df, ["emplid"], "r", 5).drop("value")


@query("pivot_topn_wide", f"{SQL_CONTRIB} SELECT emplid, " + ", ".join(
    f"max(CASE WHEN rank = {k} THEN feature END) AS shap_descr_{k}, max(CASE WHEN rank = {k} THEN round_even(value, 4) + 0.0 END) AS shap_value_{k}"
    for k in range(1, 6)) + " FROM ranked GROUP BY emplid")
def pivot_topn_wide(spark, sf):
    df = contributions(spark, sf).withColumn("r", R.ranked("contributions")).select("emplid", *R.topn_wide("r", 5))
    return df.withColumns({f"shap_value_{k}": F.col(f"shap_value_{k}") + F.lit(0.0) for k in range(1, 6)})


@query("sort_vif", f"""{COMPLETE},
v AS (SELECT 1 / (1 - power(corr(fall_lec_count, fall_withdrawn_hours), 2)) AS vif FROM complete WHERE split = 'training')
SELECT feature, round(vif, 6) AS vif FROM v, (VALUES ('fall_lec_count'), ('fall_withdrawn_hours')) f(feature) ORDER BY vif DESC""")
def sort_vif(spark, sf):
    df = vif(complete(spark, sf).where("split = 'training'"), ["fall_lec_count", "fall_withdrawn_hours"])
    return df.where("feature <> 'intercept'").withColumn("vif", r6("vif")).orderBy(F.desc("vif"))


# --- set operations ----------------------------------------------------------------------------

@query("union_history", f"""{COHORT} SELECT emplid, CAST(1 AS INT) AS model_id, split FROM fx_cohort
UNION ALL SELECT emplid, CAST(2 AS INT), NULL FROM fx_cohort WHERE split = 'testing'""")
def union_history(spark, sf):
    df = cohort(spark, sf)
    prior = df.select("emplid", F.lit(1).alias("model_id"), "split")
    current = df.where("split = 'testing'").select("emplid", F.lit(2).alias("model_id"))
    return R.union_history(prior, current)


@query("mask_partition", f"""{COHORT} SELECT emplid, CASE WHEN unmet_need_ofr IS NULL THEN 'removed' ELSE 'kept' END AS part FROM fx_cohort""")
def mask_partition(spark, sf):
    df = cohort(spark, sf).select("emplid", F.when(F.col("unmet_need_ofr").isNull(), -1).otherwise(1).alias("mask"))
    kept, removed = R.mask_partition(df)
    return kept.withColumn("part", F.lit("kept")).unionByName(removed.withColumn("part", F.lit("removed")))
