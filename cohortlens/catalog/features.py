"""Queries over feature preparation and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..explain.contributions import linear_contributions
from ..fixtures import CATEGORICAL, FEATURES, NUMERIC, view
from ..operators import features as P
from ..operators import metrics as M
from ..operators import relational as R
from ..plans import outcomes as O
from .registry import (
    COEFFICIENTS, COHORT, COMPLETE, RUN_DATE, SCORED, SQL_CONTRIB, cohort, complete, query, r6, training_means,
)
from .relational import SCORED as SCORED_SQL

EDUC = ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
ONE_HOT = [("first_gen_flag_Y", "first_gen_flag = 'Y'")] + [
    (f"parent1_highest_educ_lvl_{e}", f"parent1_highest_educ_lvl = '{e}'") for e in EDUC
]
ONE_HOT_SQL = ", ".join(f"CASE WHEN {cond} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{name}\"" for name, cond in ONE_HOT)


@query("one_hot_drop_first", f"{COMPLETE} SELECT emplid, {ONE_HOT_SQL} FROM complete")
def one_hot_drop_first(spark, sf):
    df = complete(spark, sf)
    encoder = P.OneHot.fit(df.where("split = 'training'"), CATEGORICAL)
    return encoder.transform(df).select("emplid", *encoder.names())


@query("standard_scale", f"""{COMPLETE}
SELECT emplid, round((high_school_gpa - avg(high_school_gpa) OVER w) / stddev_pop(high_school_gpa) OVER w, 6) + 0.0 AS high_school_gpa,
  round((fall_lec_count - avg(fall_lec_count) OVER w) / stddev_pop(fall_lec_count) OVER w, 6) + 0.0 AS fall_lec_count,
  CAST(0 AS DOUBLE) AS unmet_need_ofr_mi FROM complete WINDOW w AS (PARTITION BY split)""")
def standard_scale(spark, sf):
    cols = ["high_school_gpa", "fall_lec_count", "unmet_need_ofr_mi"]
    return P.standard_scale(complete(spark, sf), cols, ["split"]).select("emplid", *[r6(c).alias(c) for c in cols])


@query("named_features", f"{COMPLETE}, enc AS (SELECT *, {ONE_HOT_SQL} FROM complete) " + " UNION ALL ".join(
    f"SELECT emplid, '{n}' AS feature, CAST(\"{n}\" AS DOUBLE) AS value FROM enc" for n in [*[o for o, _ in ONE_HOT], *NUMERIC]))
def named_features(spark, sf):
    df = complete(spark, sf)
    encoder = P.OneHot.fit(df.where("split = 'training'"), CATEGORICAL)
    coded = encoder.transform(df)
    return P.named_features(P.assemble([*encoder.names(), *NUMERIC]).transform(coded), ["emplid"])


@query("design_matrix", f"""{COMPLETE} SELECT emplid, 1.0::DOUBLE AS intercept, {ONE_HOT_SQL},
  CAST(male AS DOUBLE) AS male, high_school_gpa FROM complete""")
def design_matrix(spark, sf):
    fitted, df = P.design_matrix(complete(spark, sf), "enrl_ind ~ first_gen_flag + parent1_highest_educ_lvl + male + high_school_gpa")
    return P.design_columns(df, ["emplid"], P.feature_names(df, "design"))


@query("continuous_vars", f"{COHORT}, kinds AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", bool_and(coalesce({c} IN (0, 1), false)) AS flag FROM fx_cohort" for c in NUMERIC)
    + ") SELECT \"column\" FROM kinds WHERE NOT flag")
def continuous_vars(spark, sf):
    return R.continuous_vars(R.column_profile(cohort(spark, sf), FEATURES))


# --- evaluation --------------------------------------------------------------------------------

def scored(spark, sf):
    return view(spark, sf, "fx_scored").withColumn("pred", (F.col("prob") > 0.5).cast("int"))


COUNTS = """count(CASE WHEN y_true = 0 AND prob <= 0.5 THEN 1 END) AS tn, count(CASE WHEN y_true = 0 AND prob > 0.5 THEN 1 END) AS fp,
  count(CASE WHEN y_true = 1 AND prob <= 0.5 THEN 1 END) AS fn, count(CASE WHEN y_true = 1 AND prob > 0.5 THEN 1 END) AS tp"""
RATES = """round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy, round(tp / CAST(tp + fn AS DOUBLE), 6) AS tpr,
  round(tn / CAST(tn + fp AS DOUBLE), 6) AS tnr, round((tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2, 6) AS balanced"""
BY_SCORE = """s AS (SELECT split, prob, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM fx_scored GROUP BY split, prob),
run AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY split) AS p, sum(neg) OVER (PARTITION BY split) AS n
        FROM s WINDOW w AS (PARTITION BY split ORDER BY prob DESC))"""


@query("accuracy", f"{SCORED_SQL} SELECT split, round(avg(CASE WHEN (prob > 0.5) = (y_true = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM fx_scored GROUP BY split")
def accuracy(spark, sf):
    return M.accuracy(scored(spark, sf), "y_true", "pred", ["split"]).withColumn("accuracy", r6("accuracy"))


@query("roc_auc", f"{SCORED_SQL}, {BY_SCORE} SELECT split, round(CAST(sum(neg * (tp - pos / 2.0)) AS DOUBLE) / (max(p) * CAST(max(n) AS DOUBLE)), 6) AS auc FROM run GROUP BY split")
def roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf), "y_true", "prob", ["split"]).withColumn("auc", r6("auc"))


@query("roc_curve", f"""{SCORED_SQL}, {BY_SCORE}
SELECT split, round(prob, 6) AS threshold, round(CAST(fp AS DOUBLE) / n, 6) AS fpr, round(CAST(tp AS DOUBLE) / p, 6) AS tpr FROM run
UNION ALL SELECT DISTINCT split, CAST(9 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM run""")
def roc_curve(spark, sf):
    out = M.roc_curve(scored(spark, sf), "y_true", "prob", ["split"])
    # The starting point's infinite threshold is shown as 9.
    shown = F.when(F.col("threshold") == float("inf"), F.lit(9.0)).otherwise(F.round("threshold", 6))
    return out.select("split", shown.alias("threshold"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("calibration_curve", f"""{SCORED_SQL} SELECT split, CAST(least(floor(prob * 10), 9) AS INT) AS bin, round(avg(prob), 6) AS mean_predicted,
  round(avg(CAST(y_true AS DOUBLE)), 6) AS fraction_positive, count(*) AS n FROM fx_scored GROUP BY 1, 2""")
def calibration_curve(spark, sf):
    out = M.calibration_curve(scored(spark, sf), "y_true", "prob", 10, ["split"])
    return out.withColumns({c: r6(c) for c in ("mean_predicted", "fraction_positive")})


@query("confusion_matrix", f"{SCORED_SQL} SELECT split, {COUNTS} FROM fx_scored GROUP BY split")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(scored(spark, sf), "y_true", "pred", ["split"])


@query("rates", f"{SCORED_SQL}, c AS (SELECT split, {COUNTS} FROM fx_scored GROUP BY split) SELECT split, {RATES} FROM c")
def rates(spark, sf):
    out = M.with_rates(M.confusion_matrix(scored(spark, sf), "y_true", "pred", ["split"]))
    return out.select("split", *[r6(c).alias(c) for c in ("accuracy", "tpr", "tnr", "balanced")])


WIDTH = "greatest(length(CAST(tn AS VARCHAR)), length(CAST(fp AS VARCHAR)), length(CAST(fn AS VARCHAR)), length(CAST(tp AS VARCHAR)))"
CELL = {c: f"lpad(CAST({c} AS VARCHAR), CAST({WIDTH} AS INT), ' ')" for c in ("tn", "fp", "fn", "tp")}
MATRIX = f"'[[' || {CELL['tn']} || ' ' || {CELL['fp']} || ']' || chr(10) || ' [' || {CELL['fn']} || ' ' || {CELL['tp']} || ']]'"


@query("fairness_frame", f"""{SCORED_SQL}, c AS (SELECT split AS model_type, male, underrep_minority, count(*) AS headcount, {COUNTS} FROM fx_scored GROUP BY 1, 2, 3)
SELECT model_type, male, underrep_minority, headcount, tn, fp, fn, tp, {RATES}, {MATRIX} AS matrix, '2001-08-01' AS date, CAST(2 AS INT) AS model_id, 'ft_ft_1yr' AS model_descr FROM c""")
def fairness_frame(spark, sf):
    df = scored(spark, sf).withColumnRenamed("split", "model_type")
    out = O.student_fairness(df, RUN_DATE, 2, "ft_ft_1yr", ["model_type"])
    return out.withColumns({c: r6(c) for c in ("accuracy", "tpr", "tnr", "balanced")})


@query("linear_contributions", f"{SQL_CONTRIB} SELECT emplid, feature, round(value, 6) + 0.0 AS value FROM contrib")
def linear_contributions_q(spark, sf):
    df = complete(spark, sf)
    arr = linear_contributions(SCORED, COEFFICIENTS, training_means(df), flip=True)
    out = df.select("emplid", F.inline(arr))
    return out.withColumn("value", r6("value"))
