"""Queries over neighbours, outliers and class-overlap sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import CATEGORICAL, NUMERIC, load
from ..operators import neighbors as N
from ..operators.features import OneHot, as_array
from ..plans.cohorts import unit_cohorts
from ..session import cut
from .features import ONE_HOT, ONE_HOT_SQL
from .plans import NAMES
from .registry import cohort, query, r6
from .relational import ROUTED

GROUP = ["unit", "split"]
CODED = [*[n for n, _ in ONE_HOT], *NUMERIC]

# From sf0.01 on, every unit trains on every category, so that one base serves all units in SQL.
CODED_SQL = f"""{ROUTED},
pool AS (SELECT *, {ONE_HOT_SQL} FROM routed WHERE split <> 'testing' AND unmet_need_ofr IS NOT NULL AND high_school_gpa IS NOT NULL)"""


def _edge(c: str, f: str) -> str:
    return f"CAST({f}(\"{c}\") OVER g AS DOUBLE)"


GOWER_SQL = f"""{CODED_SQL},
scaled AS (SELECT unit, split, emplid, enrl_ind, {', '.join(
    f'CASE WHEN {_edge(c, "max")} - {_edge(c, "min")} > 0 THEN (CAST("{c}" AS DOUBLE) - {_edge(c, "min")}) / ({_edge(c, "max")} - {_edge(c, "min")}) ELSE 0.0 END AS x{i}'
    for i, c in enumerate(CODED))} FROM pool WINDOW g AS (PARTITION BY unit, split)),
pairs AS (SELECT a.unit, a.split, a.emplid, b.emplid AS nbr, ({' + '.join(f'abs(a.x{i} - b.x{i})' for i in range(len(CODED)))}) / {len(CODED)} AS dist
          FROM scaled a JOIN scaled b ON a.unit = b.unit AND a.split = b.split AND a.emplid <> b.emplid),
near AS (SELECT *, row_number() OVER (PARTITION BY unit, split, emplid ORDER BY dist, nbr) AS rank FROM pairs)"""
LOF_SQL = f"""{GOWER_SQL},
e AS (SELECT * FROM near WHERE rank <= 20),
kd AS (SELECT unit, split, emplid, max(dist) AS kdist FROM e GROUP BY ALL),
lrd AS (SELECT e.unit, e.split, e.emplid, 1.0 / (avg(greatest(e.dist, kd.kdist)) + 1e-10) AS lrd
        FROM e JOIN kd ON e.unit = kd.unit AND e.split = kd.split AND e.nbr = kd.emplid GROUP BY ALL),
fac AS (SELECT e.unit, e.split, e.emplid, avg(n.lrd) / max(s.lrd) AS lof FROM e
        JOIN lrd n ON e.unit = n.unit AND e.split = n.split AND e.nbr = n.emplid
        JOIN lrd s ON e.unit = s.unit AND e.split = s.split AND e.emplid = s.emplid GROUP BY ALL),
lof AS (SELECT p.unit, p.split, p.emplid, p.enrl_ind, coalesce(fac.lof, 1.0) AS lof FROM pool p
        LEFT JOIN fac ON p.unit = fac.unit AND p.split = fac.split AND p.emplid = fac.emplid)"""
TOMEK_SQL = f"""{CODED_SQL},
pairs AS (SELECT a.unit, a.split, a.emplid, a.enrl_ind AS y, b.emplid AS nbr, b.enrl_ind AS ny,
            ({' + '.join(f'''(CAST(a."{c}" AS DOUBLE) - CAST(b."{c}" AS DOUBLE)) * (CAST(a."{c}" AS DOUBLE) - CAST(b."{c}" AS DOUBLE))''' for c in CODED)}) AS sq
          FROM pool a JOIN pool b ON a.unit = b.unit AND a.split = b.split AND a.emplid <> b.emplid),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit, split, emplid ORDER BY sqrt(sq), nbr) AS rn FROM pairs) t WHERE rn = 1),
links AS (SELECT a.unit, a.split, a.emplid AS a, a.nbr AS b, a.y AS label_a, a.ny AS label_b FROM one a
          JOIN one b ON a.unit = b.unit AND a.split = b.split AND a.nbr = b.emplid AND b.nbr = a.emplid WHERE a.emplid < a.nbr AND a.y <> a.ny)"""


def pool(spark, sf):
    """Training and validation rows of every unit, encoded on the unit's training categories."""
    df = cut(unit_cohorts(cohort(spark, sf).where("split <> 'testing'"), NAMES), "pool")
    encoder = OneHot.fit(df.where("split = 'training'"), CATEGORICAL, ["unit"], unseen="zero")
    coded = encoder.transform(df)
    return coded.select(*GROUP, "emplid", "enrl_ind", *CODED)


@query("gower_pairs", f"{GOWER_SQL} SELECT unit, split, emplid, nbr, round(dist, 6) AS dist, CAST(rank AS INT) AS rank FROM near WHERE rank <= 5")
def gower_pairs(spark, sf):
    out = N.gower_neighbours(pool(spark, sf), "emplid", CODED, 5, GROUP)
    return out.withColumn("dist", r6("dist"))


@query("knn_topk", """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS nbr, list_distance(a.x, b.x) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT vec_id, nbr, round(dist, 6) AS dist, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nbr) AS rank FROM d) t WHERE rank <= 10""")
def knn_topk(spark, sf):
    df = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return N.knn(df, "vec_id", "x", 10).withColumn("dist", r6("dist"))


@query("lof_scores", f"{LOF_SQL} SELECT unit, split, emplid, round(lof, 6) AS lof, CAST(CASE WHEN lof > 1.5 THEN -1 ELSE 1 END AS INT) AS mask FROM lof")
def lof_scores(spark, sf):
    scaled = N.gower_scale(pool(spark, sf), CODED, GROUP)
    return N.lof(scaled, "emplid", "gower", 20, "mean_abs", GROUP).withColumn("lof", r6("lof"))


@query("outlier_split", f"{LOF_SQL} SELECT unit, split, emplid, enrl_ind, CASE WHEN lof > 1.5 THEN 'removed' ELSE 'kept' END AS part FROM lof")
def outlier_split(spark, sf):
    kept, removed = N.remove_outliers(pool(spark, sf), "emplid", CODED, 20, GROUP)
    both = kept.withColumn("part", F.lit("kept")).unionByName(removed.withColumn("part", F.lit("removed")))
    return both.select(*GROUP, "emplid", "enrl_ind", "part")


@query("tomek_links", f"{TOMEK_SQL} SELECT unit, split, a, b, label_a, label_b FROM links")
def tomek_links(spark, sf):
    return N.tomek_links(pool(spark, sf).withColumn("x", as_array(CODED)), "emplid", "x", "enrl_ind", GROUP)


@query("tomek_undersample", f"""{TOMEK_SQL},
ends AS (SELECT unit, split, a AS emplid, label_a AS y FROM links UNION ALL SELECT unit, split, b, label_b FROM links),
sizes AS (SELECT unit, split, enrl_ind AS y, count(*) AS n FROM pool GROUP BY ALL),
rare AS (SELECT unit, split, y FROM (SELECT *, row_number() OVER (PARTITION BY unit, split ORDER BY n, y) AS rn FROM sizes) t WHERE rn = 1)
SELECT 'all' AS strategy, p.unit, p.split, p.emplid FROM pool p WHERE NOT EXISTS
  (SELECT 1 FROM ends e WHERE e.unit = p.unit AND e.split = p.split AND e.emplid = p.emplid)
UNION ALL SELECT 'auto', p.unit, p.split, p.emplid FROM pool p WHERE NOT EXISTS
  (SELECT 1 FROM ends e JOIN rare r ON e.unit = r.unit AND e.split = r.split WHERE e.y <> r.y AND e.unit = p.unit AND e.split = p.split AND e.emplid = p.emplid)""")
def tomek_undersample(spark, sf):
    df = pool(spark, sf).withColumn("x", as_array(CODED))
    kept = [
        N.tomek_undersample(df, "emplid", "x", "enrl_ind", s, GROUP)[0].select(F.lit(s).alias("strategy"), *GROUP, "emplid")
        for s in ("all", "auto")
    ]
    return kept[0].unionByName(kept[1])


SQUARES = " + ".join(f'''(CAST(a."{c}" AS DOUBLE) - CAST(b."{c}" AS DOUBLE)) * (CAST(a."{c}" AS DOUBLE) - CAST(b."{c}" AS DOUBLE))''' for c in CODED)


@query("nearmiss3", f"""{CODED_SQL},
tr AS (SELECT * FROM pool WHERE split = 'training'),
counted AS (SELECT unit, enrl_ind, count(*) AS n FROM tr GROUP BY unit, enrl_ind),
sizes AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY n, enrl_ind) = 1 AS minority FROM counted),
rare AS (SELECT t.* FROM tr t JOIN sizes s ON s.unit = t.unit AND s.enrl_ind = t.enrl_ind WHERE s.minority),
pairs AS (SELECT a.unit, a.emplid AS rare_id, b.emplid AS pool_id, b.enrl_ind AS y, sqrt({SQUARES}) AS dist FROM rare a JOIN tr b ON a.unit = b.unit),
short AS (SELECT DISTINCT unit, y, pool_id FROM
  (SELECT *, row_number() OVER (PARTITION BY unit, y, rare_id ORDER BY dist, pool_id) AS rn FROM pairs) t WHERE rn <= 3),
far AS (SELECT p.unit, p.y, p.pool_id, avg(p.dist) AS mean_dist FROM
  (SELECT *, row_number() OVER (PARTITION BY unit, pool_id ORDER BY dist, rare_id) AS rn FROM pairs) p
  JOIN short s ON s.unit = p.unit AND s.pool_id = p.pool_id WHERE p.rn <= 3 GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY unit, y ORDER BY mean_dist DESC, pool_id) AS rn FROM far)
SELECT b.unit, b.pool_id AS emplid, b.y AS enrl_ind, round(b.mean_dist, 6) AS mean_dist FROM best b
JOIN sizes s ON s.unit = b.unit AND s.enrl_ind = b.y WHERE b.rn <= floor(s.n / 5)""")
def nearmiss3(spark, sf):
    df = pool(spark, sf).where("split = 'training'").withColumn("x", as_array(CODED))
    return N.near_miss(df, "emplid", "x", "enrl_ind", 5, 3, ["unit"]).withColumn("mean_dist", r6("mean_dist"))
