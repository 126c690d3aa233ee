"""Queries over model fits, searches, scores and explanations."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ..explain.contributions import tree_contributions
from ..fixtures import CATEGORICAL, NUMERIC, load, view
from ..functions import threshold_pred
from ..models import linear as L
from ..models import nets as N
from ..models import batched as E
from ..models import boosting as B
from ..models import calibration as C
from ..models import grouped as Q
from ..models import registry as G
from ..models import search as H
from ..models import trees as T
from ..operators.features import OneHot, assemble, feature_names
from ..operators.metrics import log_loss
from ..operators.relational import row_ordinal
from ..plans.cohorts import unit_cohorts
from ..plans.dimensions import FOREST
from ..plans.flow import per_unit, retention_risk
from ..session import cut, fresh_path
from .features import ONE_HOT
from .plans import NAMES
from .registry import COEFFICIENTS, COMPLETE, INTERCEPT, RUN_DATE, SQL_PROB, cohort, complete, query, r6, scored_complete
from .relational import ROUTED, SCORED

# The original's forest, of 96 trees a round; the rounds of a whole run are cut to three.
SHORT = {**FOREST, "depth": 4, "rounds": 3}
CODED = [*[n for n, _ in ONE_HOT], *NUMERIC]
# Columns that vary, for designs that must have full rank.
PLAIN = ["male", "underrep_minority", "resident", "fall_lec_count", "fall_withdrawn_hours"]


def encoded(spark, sf, by_unit: bool = False):
    """Complete rows with indicators and an assembled vector: the whole table, or routed to units."""
    df = cut(unit_cohorts(cohort(spark, sf), NAMES) if by_unit else complete(spark, sf), "complete")
    by = ["unit"] if by_unit else []
    encoder = OneHot.fit(df.where("split = 'training'"), CATEGORICAL, by, unseen="zero")
    coded = encoder.transform(df).select(*by, "split", "emplid", "enrl_ind", *CODED)
    return assemble(CODED).transform(cut(coded, "encoded"))


def predictions(df, prob):
    return df.select("emplid", r6(prob).alias("prob"), threshold_pred(prob).alias("pred"))


def split_of(df, split):
    return df.where(F.col("split") == split)


FIT2 = """m AS (SELECT {by}avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y,
  var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12 FROM d {group}),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m),
f AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM b)"""
DATA2 = "d AS (SELECT *, CAST(fall_lec_count AS DOUBLE) AS y, CAST(fall_withdrawn_hours AS DOUBLE) AS x1, high_school_gpa / 100000.0 AS x2 FROM complete)"


def two_predictors(spark, sf):
    return complete(spark, sf).withColumns({
        "y": F.col("fall_lec_count").cast("double"), "x1": F.col("fall_withdrawn_hours").cast("double"),
        "x2": F.col("high_school_gpa") / 100000.0,
    })


@query("ols_fit", f"""{COMPLETE}, {DATA2}, {FIT2.format(by='', group='')}
SELECT 'intercept' AS term, round(b0, 6) AS coef FROM f UNION ALL SELECT 'x1', round(b1, 6) FROM f UNION ALL SELECT 'x2', round(b2, 6) FROM f
UNION ALL SELECT 'r_squared', round((b1 * s1y + b2 * s2y) / (SELECT var_pop(y) FROM d), 6) FROM f""")
def ols_fit(spark, sf):
    model = L.ols(two_predictors(spark, sf), "y", ["x1", "x2"])
    rows = [("intercept", model.intercept), ("x1", model.coefficients[0]), ("x2", model.coefficients[1]), ("r_squared", model.summary.r2)]
    return spark.createDataFrame([(t, float(v)) for t, v in rows], "term string, coef double").withColumn("coef", r6("coef"))


@query("residual_instrument", f"""{COMPLETE}, {DATA2}, {FIT2.format(by='split, ', group='GROUP BY split')}
SELECT d.emplid, round(d.y - (f.b0 + f.b1 * d.x1 + f.b2 * d.x2), 6) + 0.0 AS instrument FROM d JOIN f ON d.split = f.split""")
def residual_instrument(spark, sf):
    return Q.residual(two_predictors(spark, sf), "y", ["x1", "x2"], "instrument", ["split"]).select("emplid", r6("instrument").alias("instrument"))


@query("vif", f"""{COMPLETE}, {DATA2}, {FIT2.format(by='split, ', group='GROUP BY split')}
SELECT split, 'x1' AS feature, round(1 / (1 - s12 * s12 / (s11 * s22)), 6) AS vif FROM f
UNION ALL SELECT split, 'x2', round(1 / (1 - s12 * s12 / (s11 * s22)), 6) FROM f
UNION ALL SELECT split, 'intercept', round(1 + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / (s11 * s22 - s12 * s12), 6) FROM f""")
def vif(spark, sf):
    return Q.vif(two_predictors(spark, sf), ["x1", "x2"], ["split"]).withColumn("vif", r6("vif"))


@query("least_squares_many_groups", f"""{COMPLETE}, {DATA2}, g AS (SELECT *, emplid // 25 AS grp FROM d),
f AS (SELECT grp, count(*) AS n, regr_slope(y, x1) AS b1, regr_intercept(y, x1) AS b0 FROM g GROUP BY grp HAVING count(DISTINCT x1) > 1)
SELECT CAST(grp AS BIGINT) AS grp, n, round(b0, 6) + 0.0 AS intercept, round(b1, 6) + 0.0 AS slope FROM f""")
def least_squares_many_groups(spark, sf):
    """A fit for every 25 neighbouring ids: as many groups as the table makes."""
    df = two_predictors(spark, sf).withColumn("grp", F.floor(F.col("emplid") / 25).cast("long"))
    varied = df.groupBy(F.col("grp").alias("g")).agg(F.count_distinct("x1").alias("k")).where("k > 1")
    fits = Q.least_squares(df.join(varied, F.col("grp") == F.col("g"), "left_semi"), "y", ["x1"], ["grp"])
    beta = [F.round(F.get("beta", F.lit(i)), 6) + F.lit(0.0) for i in (0, 1)]
    return fits.select("grp", "n", beta[0].alias("intercept"), beta[1].alias("slope"))


@query("logit_inference")
def logit_inference(spark, sf):
    train = split_of(encoded(spark, sf, by_unit=True), "training").drop("features")
    return Q.logit_inference(train, "enrl_ind", PLAIN, ["unit"])


def newton_sql(steps: int, weight: str = "1", ridge: float = 0.0) -> str:
    """Newton steps of a logit on x1 and x2 for each unit, by Cramer's rule; ``ridge`` is the weight of half the squared slopes."""
    out = ["b0 AS (SELECT DISTINCT unit, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c FROM t)"]
    det = lambda m: f"({m[0]} * ({m[4]} * {m[8]} - {m[5]} * {m[7]}) - {m[1]} * ({m[3]} * {m[8]} - {m[5]} * {m[6]}) + {m[2]} * ({m[3]} * {m[7]} - {m[4]} * {m[6]}))"
    full = ["h", "h1", "h2", "h1", "h11", "h12", "h2", "h12", "h22"]
    swap = lambda j: [f"s{i // 3}" if i % 3 == j else v for i, v in enumerate(full)]
    for k in range(steps):
        out.append(f"""p{k} AS (SELECT t.*, a, b, c, 1 / (1 + exp(-(a + b * x1 + c * x2))) AS p FROM t JOIN b{k} USING (unit)),
e{k} AS (SELECT *, {weight} * (y - p) AS s, {weight} * p * (1 - p) AS q FROM p{k}),
s{k} AS MATERIALIZED (SELECT unit, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, sum(s) AS s0, sum(s * x1) - {ridge} * any_value(b) AS s1, sum(s * x2) - {ridge} * any_value(c) AS s2,
  sum(q) AS h, sum(q * x1) AS h1, sum(q * x2) AS h2, sum(q * x1 * x1) + {ridge} AS h11, sum(q * x1 * x2) AS h12, sum(q * x2 * x2) + {ridge} AS h22 FROM e{k} GROUP BY unit),
b{k + 1} AS MATERIALIZED (SELECT unit, a + {det(swap(0))} / {det(full)} AS a, b + {det(swap(1))} / {det(full)} AS b, c + {det(swap(2))} / {det(full)} AS c FROM s{k})""")
    last = f"s{steps - 1}"
    minor = {"a": "h11 * h22 - h12 * h12", "b": "h * h22 - h2 * h2", "c": "h * h11 - h1 * h1"}
    out.append("told AS (" + " UNION ALL ".join(
        f"SELECT unit, '{term}' AS term, {v} AS coef, sqrt(({minor[v]}) / {det(full)}) AS std_err FROM {last}"
        for term, v in (("intercept", "a"), ("fall_withdrawn_hours", "b"), ("fall_lec_count", "c"))) + ")")
    return ",\n".join(out)


@query("logit_by_newton", f"""{ROUTED},
t AS (SELECT unit, CAST(enrl_ind AS DOUBLE) AS y, CAST(fall_withdrawn_hours AS DOUBLE) AS x1, CAST(fall_lec_count AS DOUBLE) AS x2 FROM routed
      WHERE split = 'training' AND unmet_need_ofr IS NOT NULL AND high_school_gpa IS NOT NULL),
{newton_sql(8)}
SELECT unit, term, round(coef, 6) + 0.0 AS coef, round(std_err, 6) AS std_err, round(coef / std_err, 5) + 0.0 AS z, 'converged' AS status FROM told""")
def logit_by_newton(spark, sf):
    """Logits of all units with their standard errors, against Newton's steps in SQL."""
    df = unit_cohorts(cohort(spark, sf), NAMES).where("split = 'training'")
    out = Q.logit_inference(df, "enrl_ind", ["fall_withdrawn_hours", "fall_lec_count"], ["unit"])
    return out.select("unit", "term", (r6("coef") + F.lit(0.0)).alias("coef"), r6("std_err").alias("std_err"), (F.round("z", 5) + F.lit(0.0)).alias("z"), "status")


@query("logit_score_equations", f"""{ROUTED}, terms AS (SELECT * FROM (VALUES {', '.join(f"('{t}')" for t in [*PLAIN, 'intercept'])}) v(term))
SELECT DISTINCT unit, term, true AS solved FROM routed CROSS JOIN terms WHERE split = 'training'""")
def logit_score_equations(spark, sf):
    """At the maximum, the residuals of the fitted logit are orthogonal to every column."""
    fits = logit_inference(spark, sf).select("unit", "term", "coef").collect()
    train = split_of(encoded(spark, sf, by_unit=True), "training")
    eta = F.lit(0.0)
    for r in fits:
        x = F.lit(1.0) if r["term"] == "intercept" else F.col(r["term"])
        eta = eta + F.when(F.col("unit") == r["unit"], x * r["coef"]).otherwise(0.0)
    resid = F.col("enrl_ind") - 1.0 / (1.0 + F.exp(-eta))
    gaps = train.withColumn("r", resid).groupBy("unit").agg(
        *[F.sum(F.col("r") * F.col(c)).alias(c) for c in PLAIN], F.sum("r").alias("intercept"), F.count("*").alias("n"))
    long = gaps.select("unit", "n", F.inline(F.array(*[F.struct(F.lit(t).alias("term"), F.col(t).alias("gap")) for t in [*PLAIN, "intercept"]])))
    return long.select("unit", "term", (F.abs(F.col("gap")) < 1e-4 * F.col("n")).alias("solved"))


@query("elastic_logit")
def elastic_logit(spark, sf):
    """C = 1, no l1, every unit in the same passes."""
    df = encoded(spark, sf, by_unit=True)
    fitted = E.elastic_logits(split_of(df, "training"), "enrl_ind", {u: [E.Fit(0, E.NO_FOLD, 1.0, 0.0)] for u in "PVTU"}, "unit")
    margin = F.lit(None).cast("double")
    for u, f in fitted.items():
        x = sum((F.col(c) * float(v) for c, v in zip(CODED, f.beta[:-1, 0])), F.lit(float(f.beta[-1, 0])))
        margin = F.when(F.col("unit") == u, x).otherwise(margin)
    scored = split_of(df, "testing").withColumn("prob", 1.0 / (1.0 + F.exp(-margin)))
    return scored.select("emplid", r6("prob").alias("prob"), threshold_pred("prob").alias("pred"), "unit")


RIDGE_STEPS = 8


@query("ridge_logit_by_newton", f"""{ROUTED},
r AS (SELECT unit, CAST(enrl_ind AS DOUBLE) AS y, CAST(fall_withdrawn_hours AS DOUBLE) AS x1, CAST(fall_lec_count AS DOUBLE) AS x2 FROM routed
      WHERE split = 'training' AND unmet_need_ofr IS NOT NULL AND high_school_gpa IS NOT NULL),
t AS (SELECT *, count(*) OVER (PARTITION BY unit) / (2.0 * count(*) OVER (PARTITION BY unit, y)) AS w FROM r),
{newton_sql(RIDGE_STEPS, 'w', 0.01)}
SELECT unit, term, round(coef, 6) + 0.0 AS coef FROM told""")
def ridge_logit_by_newton(spark, sf):
    """Class-balanced logits under an l2 penalty (C = 100) of all units, against Newton's steps in SQL."""
    names = ["fall_withdrawn_hours", "fall_lec_count"]
    df = assemble(names).transform(unit_cohorts(cohort(spark, sf), NAMES).where("split = 'training'"))
    fitted = E.elastic_logits(df, "enrl_ind", {u: [E.Fit(0, E.NO_FOLD, 100.0, 0.0)] for u in "PVTU"}, "unit")
    rows = [(u, t, float(v)) for u, f in fitted.items() for t, v in zip([*names, "intercept"], f.beta[:, 0])]
    return spark.createDataFrame(rows, "unit string, term string, coef double").withColumn("coef", r6("coef") + F.lit(0.0))


# The grid that the original searches: 11 shares of l1 by 20 strengths.
LOGIT_GRID = [{"l1_ratio": round(i / 10, 1), "c": 10 ** (4 * j / 19)} for i in range(11) for j in range(20)]


@query("logit_search")
def logit_search(spark, sf):
    """All 220 candidates, five folds and four units."""
    df = split_of(encoded(spark, sf, by_unit=True), "training").withColumn("fold", F.pmod(F.xxhash64("emplid"), F.lit(5)))
    _, log = E.logit_search(df, "enrl_ind", "emplid", "fold", 5, LOGIT_GRID, "unit")
    rows = [(g, r, LOGIT_GRID[c]["l1_ratio"], LOGIT_GRID[c]["c"], n, round(v, 9)) for g, r, c, n, v in log]
    return spark.createDataFrame(rows, "unit string, rung int, l1_ratio double, c double, resources int, accuracy double")


@query("huber_linear")
def huber_linear(spark, sf):
    df = encoded(spark, sf)
    model = L.huber_linear(split_of(df, "training"), CODED, "enrl_ind")
    return predictions(split_of(df, "testing").withColumn("prob", model.probability()), "prob")


@query("huber_score", f"""{COMPLETE}
SELECT emplid, round((least(greatest((fall_lec_count - 10) / 10.0, -1.0), 1.0) + 1) / 2, 6) AS prob FROM complete""")
def huber_score(spark, sf):
    return complete(spark, sf).select("emplid", r6(L.huber_probability((F.col("fall_lec_count") - 10) / 10.0)).alias("prob"))


@query("mlp")
def mlp(spark, sf):
    df = encoded(spark, sf)
    nets = N.fit_nets(split_of(df, "training"), "enrl_ind", epochs=60)
    return predictions(N.net_scores(nets, split_of(df, "testing")), "prob")


@query("boosted_trees")
def boosted_trees(spark, sf):
    df = encoded(spark, sf)
    model = B.boosted_trees(split_of(df, "training"), "enrl_ind", rounds=20, depth=3)
    return predictions(model.transform(split_of(df, "testing")), "prob")


EXACT = {"rounds": 3, "depth": 2, "step": 0.5, "gamma": 0.05, "min_child_weight": 2.0}


def boosting_sql(columns: list[str], rounds: int, depth: int, step: float, gamma: float, min_child_weight: float) -> str:
    """Boosting stated in SQL: each level's histograms, gains and best splits, each round's leaves and margins."""
    out = ["r AS MATERIALIZED (SELECT emplid, split, enrl_ind AS y, " + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(columns)) + " FROM complete)",
           "w AS (SELECT CAST(count(*) FILTER (y = 0) AS DOUBLE) / count(*) FILTER (y = 1) AS w FROM r WHERE split = 'training')",
           "m0 AS (SELECT emplid, CAST(0 AS DOUBLE) AS m FROM r)"]
    picked = " ".join(f"WHEN {i} THEN x{i}" for i in range(len(columns)))
    for k in range(rounds):
        out.append(f"""g{k} AS MATERIALIZED (SELECT r.*, m, CASE WHEN y = 1 THEN w ELSE 1 END * (1 / (1 + exp(-m)) - y) AS g,
  CASE WHEN y = 1 THEN w ELSE 1 END / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m))) AS h FROM r JOIN m{k} USING (emplid), w)""")
        out.append(f"n{k}_0 AS (SELECT *, 0 AS node FROM g{k})")
        for level in range(depth):
            long = " UNION ALL ".join(f"SELECT node, {i} AS f, x{i} AS v, g, h FROM n{k}_{level} WHERE split = 'training' AND node >= {2 ** level - 1}" for i in range(len(columns)))
            out.append(f"""h{k}_{level} AS (SELECT node, f, v, sum(sum(g)) OVER a AS gl, sum(sum(h)) OVER a AS hl, sum(sum(g)) OVER t AS g, sum(sum(h)) OVER t AS h
  FROM ({long}) GROUP BY node, f, v WINDOW a AS (PARTITION BY node, f ORDER BY v), t AS (PARTITION BY node, f))""")
            out.append(f"""s{k}_{level} AS MATERIALIZED (SELECT node, f, v FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) AS place
  FROM (SELECT *, round(gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1), 6) AS gain FROM h{k}_{level}
        WHERE hl >= {min_child_weight} AND h - hl >= {min_child_weight})) WHERE place = 1 AND gain > 1e-6 AND gain >= {gamma})""")
            out.append(f"""n{k}_{level + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN n.node WHEN CASE f {picked} END <= s.v THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node
  FROM n{k}_{level} n LEFT JOIN s{k}_{level} s ON n.node = s.node)""")
        out.append(f"l{k} AS (SELECT node, -sum(g) / (sum(h) + 1) AS weight FROM n{k}_{depth} WHERE split = 'training' GROUP BY node)")
        out.append(f"m{k + 1} AS MATERIALIZED (SELECT emplid, m + {step} * weight AS m FROM n{k}_{depth} JOIN l{k} USING (node))")
    return ",\n".join(out)


@query("boosted_trees_exact", f"""{COMPLETE},
{boosting_sql(PLAIN, **EXACT)}
SELECT emplid, round(1 / (1 + exp(-m)), 6) AS prob, CAST(CASE WHEN 1 / (1 + exp(-m)) > 0.5 THEN 1 ELSE 0 END AS INT) AS pred
FROM r JOIN m{EXACT['rounds']} USING (emplid) WHERE split = 'testing'""")
def boosted_trees_exact(spark, sf):
    """Boosting on columns of few values, whose bins are exact: the same trees, leaves and scores as in SQL."""
    df = assemble(PLAIN).transform(complete(spark, sf))
    model = B.boosted_trees(split_of(df, "training"), "enrl_ind", **EXACT)
    return predictions(model.transform(split_of(df, "testing")), "prob")


@query("boosted_forest")
def boosted_forest(spark, sf):
    df = encoded(spark, sf)
    model = B.boosted_forest(split_of(df, "training"), split_of(df, "validation"), "enrl_ind", rounds=500, **FOREST)
    return predictions(model.transform(split_of(df, "testing")), "prob")


@query("random_forest")
def random_forest(spark, sf):
    df = encoded(spark, sf)
    model = T.random_forest(split_of(df, "training"), "enrl_ind", trees=100, depth=4)
    return predictions(model.transform(split_of(df, "testing")).withColumn("prob", L.prob_of_one()), "prob")


@query("soft_vote", f"""{COMPLETE}, s AS (SELECT emplid, {SQL_PROB} AS p, (least(greatest((fall_lec_count - 10) / 10.0, -1.0), 1.0) + 1) / 2 AS q FROM complete)
SELECT emplid, round((p + q) / 2, 6) AS prob FROM s""")
def soft_vote(spark, sf):
    df = scored_complete(spark, sf).withColumn("q", L.huber_probability((F.col("fall_lec_count") - 10) / 10.0))
    return df.select("emplid", r6(L.soft_vote("prob", "q")).alias("prob"))


@query("isotonic_calibration")
def isotonic_calibration(spark, sf):
    df = view(spark, sf, "fx_scored").withColumn("fold", F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_suppkey"), F.lit(5)).cast("int"))
    out = C.isotonic_calibration(df.select("y_true", "prob", "fold"), "y_true", "prob", "fold")
    return out.groupBy("prob").agg(F.max("calibrated").alias("calibrated"), F.count("*").alias("n"))


@query("isotonic_pools", f"""{SCORED}, p AS (SELECT CAST(l_orderkey % 5 AS INT) AS fold, CAST(round(prob, 2) AS DOUBLE) AS s, CAST(sum(y_true) AS DOUBLE) AS wy, CAST(count(*) AS DOUBLE) AS w FROM fx_scored GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY s) AS i, sum(wy) OVER o AS cy, sum(w) OVER o AS cw FROM p WINDOW o AS (PARTITION BY fold ORDER BY s)),
m AS (SELECT a.fold, a.i AS a, b.i AS b, (b.cy - a.cy + a.wy) / (b.cw - a.cw + a.w) AS mean FROM n a JOIN n b ON a.fold = b.fold AND a.i <= b.i),
low AS (SELECT n.fold, n.s, n.i, m.a, min(mean) AS least FROM n JOIN m ON m.fold = n.fold AND m.a <= n.i AND m.b >= n.i GROUP BY ALL)
SELECT fold, s AS score, round(max(least), 6) AS calibrated FROM low GROUP BY fold, s""")
def isotonic_pools(spark, sf):
    """The fit at every score, against the greatest of the least means of the stretches around it."""
    df = view(spark, sf, "fx_scored").select((F.col("l_orderkey") % 5).cast("int").alias("fold"), F.round("prob", 2).cast("double").alias("score"), F.col("y_true").cast("double").alias("y"))
    points = cut(df.groupBy("fold", "score").agg(F.avg("y").alias("y"), F.count("*").alias("w")), "points")
    pools = C.isotonic(points, ["fold"], "score", "y", "w")
    hit = points.join(pools.withColumnRenamed("fold", "f"), (F.col("fold") == F.col("f")) & F.col("score").between(F.col("lo"), F.col("hi")))
    return hit.select("fold", "score", r6("value").alias("calibrated"))


@query("calibrated_logit")
def calibrated_logit(spark, sf):
    """A logit fitted anew without each of five folds and calibrated on that fold, as the mean of the five."""
    df = encoded(spark, sf)
    train = cut(split_of(df, "training").withColumn("fold", F.pmod(F.xxhash64("emplid"), F.lit(5)).cast("int")), "folds")

    def fit(rows):
        fitted = E.elastic_logits(rows, "enrl_ind", {E.ONE: [E.Fit(0, k, 1.0, 0.0) for k in range(5)]}, fold="fold")[E.ONE]
        if not fitted.rows.all():
            raise ValueError(f"no training rows outside fold {int(fitted.rows.argmin())}")
        return [scorer(beta) for beta in fitted.beta.T]

    def scorer(beta):
        margin = sum((F.col(c) * float(v) for c, v in zip(CODED, beta[:-1])), F.lit(float(beta[-1])))
        return lambda rows: rows.withColumn("prob", 1.0 / (1.0 + F.exp(-margin)))

    return predictions(C.refitted_calibration(train, split_of(df, "testing"), "enrl_ind", "emplid", "fold", 5, fit, together=True), "calibrated")


@query("isotonic_monotone", f"{SCORED} SELECT count(DISTINCT prob) AS scores, count(*) AS n, true AS monotone FROM fx_scored")
def isotonic_monotone(spark, sf):
    """A calibrated score never falls as the score rises: compare every score with the next, in slices along the score."""
    points = cut(isotonic_calibration(spark, sf), "calibrated")
    placed = row_ordinal(points, ["prob"])
    following = placed.select((F.col("ordinal") - 1).alias("ordinal"), F.col("calibrated").alias("next"))
    return placed.join(following, "ordinal", "left").agg(
        F.count("*").alias("scores"), F.sum("n").alias("n"),
        F.bool_and(F.coalesce(F.col("next") >= F.col("calibrated") - 1e-12, F.lit(True))).alias("monotone"))


@query("halving_search")
def halving_search(spark, sf):
    df = cut(split_of(encoded(spark, sf), "training").withColumn("fold", F.pmod(F.xxhash64("emplid"), F.lit(3))), "folds")
    choices = H.grid(depth=[1, 3], step=[0.1, 0.5])

    def fit(rows, candidate, resources):
        return B.boosted_trees(rows, "enrl_ind", resources, candidate["depth"], candidate["step"]).transform

    _, log = H.halving_search(df, "enrl_ind", "fold", 3, choices, fit, 1, 3)
    rows = [(r, str(choices[c]), n, k, a) for r, c, n, k, a in log]
    return spark.createDataFrame(rows, "rung int, candidate string, resources int, fold int, auc double")


@query("halving_survivors", f"""{SCORED}, s AS (SELECT l_suppkey AS candidate, l_orderkey % 3 AS fold, avg(CASE WHEN (prob > 0.5) = (y_true = 1) THEN 1.0 ELSE 0.0 END) AS score
  FROM fx_scored GROUP BY 1, 2), m AS (SELECT candidate, round(avg(score), 9) AS mean_score FROM s GROUP BY candidate)
SELECT candidate, round(mean_score, 6) AS mean_score FROM (SELECT *, row_number() OVER (ORDER BY mean_score DESC, candidate) AS rn, count(*) OVER () AS n FROM m) t
WHERE rn <= ceil(n / 3.0)""")
def halving_survivors(spark, sf):
    df = view(spark, sf, "fx_scored")
    right = ((F.col("prob") > 0.5) == (F.col("y_true") == 1)).cast("double")
    scores = df.groupBy(F.col("l_suppkey").alias("candidate"), (F.col("l_orderkey") % 3).alias("fold")).agg(F.avg(right).alias("score"))
    return H.survivors(scores, "candidate", "score").withColumn("mean_score", r6("mean_score"))


LOSSES = """loss AS (SELECT l_returnflag AS unit, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INT) AS round,
  avg(-ln(CASE WHEN l_linestatus = 'O' THEN 0.05 + 9 * l_discount ELSE 1 - (0.05 + 9 * l_discount) END)) AS loss FROM lineitem GROUP BY 1, 2)"""


@query("early_stop", f"""WITH {LOSSES},
p AS (SELECT *, row_number() OVER w AS pos, min(loss) OVER (w ROWS UNBOUNDED PRECEDING) AS low,
        arg_min(round, loss) OVER (w ROWS UNBOUNDED PRECEDING) AS best_at FROM loss WINDOW w AS (PARTITION BY unit ORDER BY round)),
q AS (SELECT p.*, b.pos AS best_pos FROM p JOIN p b ON b.unit = p.unit AND b.round = p.best_at),
s AS (SELECT *, coalesce(min(CASE WHEN pos - best_pos >= 5 THEN pos END) OVER (PARTITION BY unit), max(pos) OVER (PARTITION BY unit)) AS stop FROM q)
SELECT unit, CAST(best_at AS INT) AS best_round, round(low, 6) AS best_loss, CAST(pos AS INT) AS rounds_run FROM s WHERE pos = stop""")
def early_stop(spark, sf):
    df = load(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("unit"), (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("round"),
        (F.col("l_linestatus") == "O").cast("int").alias("y"), (0.05 + 9 * F.col("l_discount")).alias("p"),
    )
    losses = df.groupBy("unit", "round").agg(log_loss("y", "p").alias("loss"))
    return T.early_stop(losses, ["unit"], "round", "loss", 5).withColumn("best_loss", r6("best_loss"))


def _linear_model(train):
    return Pipeline(stages=[assemble(PLAIN, "x"), LogisticRegression(featuresCol="x", labelCol="enrl_ind", maxIter=20)]).fit(train)


@query("score_batch", f"""{COMPLETE}, s AS (SELECT emplid, {SQL_PROB} AS p FROM complete WHERE split = 'testing')
SELECT emplid, round(p, 6) AS prob, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INT) AS pred FROM s""")
def score_batch(spark, sf):
    """A saved pipeline with known coefficients, loaded and applied to the testing rows."""
    df, root = complete(spark, sf), fresh_path(spark, "models")
    terms = " + ".join([f"({INTERCEPT}D)", *(f"({b!r}D) * _v[{i}]" for i, b in enumerate(COEFFICIENTS.values()))])
    stages = [
        SQLTransformer(statement="SELECT *, array(" + ", ".join(f"CAST({c} AS DOUBLE)" for c in COEFFICIENTS) + ") AS _v FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, 1D / (1D + exp(-({terms}))) AS prob FROM __THIS__"),
    ]
    G.save_model(Pipeline(stages=stages).fit(df), root, "U", "fixed", {"features": list(COEFFICIENTS)})
    return predictions(G.load_model(root, "U", "fixed").transform(split_of(df, "testing")), "prob")


@query("score_batch_fitted")
def score_batch_fitted(spark, sf):
    df = complete(spark, sf)
    model = _linear_model(split_of(df, "training"))
    return predictions(model.transform(split_of(df, "testing")).withColumn("prob", L.prob_of_one()), "prob")


@query("model_registry", f"{COMPLETE} SELECT 'U' AS unit, 'ft_ft_1yr' AS model_descr, emplid, true AS same FROM complete WHERE split = 'testing'")
def model_registry(spark, sf):
    df, root = complete(spark, sf), fresh_path(spark, "models")
    model = _linear_model(split_of(df, "training"))
    path = G.save_model(model, root, "U", "ft_ft_1yr")
    again = G.load_model(root, "U", "ft_ft_1yr")
    test = split_of(df, "testing")
    first = model.transform(test).select("emplid", L.prob_of_one().alias("prob"))
    second = again.transform(test).select("emplid", L.prob_of_one().alias("reloaded"))
    row = G.registry_rows(spark, [("U", "ft_ft_1yr", path)])
    both = first.join(second, "emplid").withColumn("unit", F.lit("U")).join(row, "unit")
    return both.select("unit", "model_descr", "emplid", (F.col("prob") == F.col("reloaded")).alias("same"))


def _explained(spark, sf):
    """Testing rows with the model's own probability and their contributions for class 0."""
    df = encoded(spark, sf)
    train = split_of(df, "training")
    model = B.boosted_forest(train, split_of(df, "validation"), "enrl_ind", **SHORT)
    told = tree_contributions(split_of(df, "testing"), ["emplid"], train, model, feature_names(df))
    own = model.transform(split_of(df, "testing")).select("emplid", F.col("prob").alias("model_prob"))
    return told, own


# A model of two rounds of one tree: (round, tree, node, column or -1, split, left, right, weight).
FIXED_TREES = [(0, 0, 0, 1, 10.0, 1, 2, 0.0), (0, 0, 1, 0, 0.0, 3, 4, 0.0), (0, 0, 2, 2, 4.0, 5, 6, 0.0), (0, 0, 3, -1, 0.0, 0, 0, -1.5), (0, 0, 4, -1, 0.0, 0, 0, -0.25),
               (0, 0, 5, -1, 0.0, 0, 0, 2.0), (0, 0, 6, -1, 0.0, 0, 0, 0.5), (1, 0, 0, 2, 2.0, 1, 2, 0.0), (1, 0, 1, -1, 0.0, 0, 0, 1.0), (1, 0, 2, 1, 20.0, 3, 4, 0.0),
               (1, 0, 3, -1, 0.0, 0, 0, -0.75), (1, 0, 4, -1, 0.0, 0, 0, 0.25)]
FIXED_STEP = 0.5
FIXED_COLUMNS = ["male", "fall_lec_count", "fall_withdrawn_hours"]


def tree_sql(at: int, tree: list[tuple], names: list[str]) -> str:
    """A tree as nested CASE expressions over the columns ``names``."""
    f, cutoff, left, right, weight = tree[at][3:]
    return str(weight) if f < 0 else f"CASE WHEN {names[f]} <= {cutoff} THEN {tree_sql(left, tree, names)} ELSE {tree_sql(right, tree, names)} END"


def margin_sql(names: list[str]) -> str:
    return " + ".join(f"{FIXED_STEP} * ({tree_sql(0, [n for n in FIXED_TREES if n[0] == k], names)})" for k in (0, 1))


def shapley_sql() -> str:
    """Shapley values by definition: the mean margin of every mix of a row's columns with the background's."""
    mixes = ", ".join(f"avg({margin_sql([f'x.{c}' if s >> i & 1 else f'b.{c}' for i, c in enumerate(FIXED_COLUMNS)])}) AS v{s}" for s in range(8))
    term = lambda i: " + ".join(
        f"{[2, 1, 2][bin(s).count('1')]} / 6.0 * (v{s | 1 << i} - v{s})" for s in range(8) if not s >> i & 1)
    told = " UNION ALL ".join(f"SELECT emplid, '{c}' AS feature, {term(i)} AS phi, v7, v0 FROM v" for i, c in enumerate(FIXED_COLUMNS))
    return f"""v AS (SELECT x.emplid, {mixes} FROM complete x, complete b WHERE x.split = 'testing' AND b.split = 'training' GROUP BY x.emplid),
mean AS (SELECT avg(1 / (1 + exp(-({margin_sql(FIXED_COLUMNS)})))) AS p FROM complete WHERE split = 'training'),
told AS ({told})"""


@query("contributions_by_definition", f"""{COMPLETE}, {shapley_sql()}
SELECT emplid, feature, round(-phi * CASE WHEN abs(v7 - v0) > 1e-12 THEN (1 / (1 + exp(-v7)) - p) / (v7 - v0) ELSE 0 END, 6) AS value,
       round(1 / (1 + exp(-v7)), 6) AS prob, round(1 - p, 6) AS base FROM told, mean""")
def contributions_by_definition(spark, sf):
    """A model with known trees, explained against the training rows."""
    df = assemble(FIXED_COLUMNS).transform(complete(spark, sf))
    told = tree_contributions(split_of(df, "testing"), ["emplid"], split_of(df, "training"), B.BoostedForest.of_rows(FIXED_TREES, FIXED_STEP), FIXED_COLUMNS)
    long = told.select("emplid", "prob", "base", F.inline("contributions"))
    return long.select("emplid", "feature", r6("value").alias("value"), r6("prob").alias("prob"), r6("base").alias("base"))


@query("tree_contributions")
def tree_contributions_q(spark, sf):
    told, _ = _explained(spark, sf)
    return told.select("emplid", "prob", "base", F.inline("contributions")).withColumn("value", r6("value"))


@query("contributions_add_up", f"{COMPLETE} SELECT emplid, true AS prob_agrees, true AS adds_up FROM complete WHERE split = 'testing'")
def contributions_add_up(spark, sf):
    told, own = _explained(spark, sf)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["value"]) + F.col("base")
    return told.join(own, "emplid").select(
        "emplid", (F.abs(F.col("prob") - F.col("model_prob")) < 1e-9).alias("prob_agrees"),
        (F.abs(total - (1 - F.col("model_prob"))) < 1e-9).alias("adds_up"),
    )


@query("retention_risk")
def retention_risk_q(spark, sf):
    run = retention_risk(cohort(spark, sf), CATEGORICAL, NUMERIC, "PVTU", 2, "ft_ft_1yr", RUN_DATE,
                         unseen="zero", **SHORT)
    return run.outcome


@query("retention_scope", f"""{ROUTED} SELECT unit, lpad(CAST(emplid AS VARCHAR), 9, '0') AS emplid, '2001-08-01' AS date, CAST(2 AS INT) AS model_id,
  true AS is_probability FROM routed WHERE split = 'testing' AND unmet_need_ofr IS NOT NULL AND high_school_gpa IS NOT NULL""")
def retention_scope(spark, sf):
    """Who the whole run scores: every complete testing row, once per unit that scores its campus."""
    run = retention_risk(cohort(spark, sf), CATEGORICAL, NUMERIC, "PVTU", 2, "ft_ft_1yr", RUN_DATE,
                         unseen="zero", **{**SHORT, "rounds": 1})
    return run.outcome.select("unit", "emplid", "date", "model_id", F.col("risk_prob").between(0, 1).alias("is_probability"))


@query("retention_explained")
def retention_explained(spark, sf):
    run = retention_risk(cohort(spark, sf), CATEGORICAL, NUMERIC, "PVTU", 2, "ft_ft_1yr", RUN_DATE,
                         explain=True, unseen="zero", **SHORT)
    return run.shap
