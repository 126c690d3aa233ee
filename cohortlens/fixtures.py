"""Stand-in inputs: views over the test tables that have the shape of the real inputs.

The text is plain SQL that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_STRM = (
    "concat(lpad(CAST(year(o_orderdate) - 1900 AS VARCHAR(4)), 3, '0'), "
    "CAST(quarter(o_orderdate) * 2 + 1 AS VARCHAR(4)))"
)
_CAREER = "CASE WHEN o_orderstatus = 'P' THEN 'GRAD' ELSE 'UGRD' END"

VIEWS = {
    # Term table: quarters stand for terms; summer terms have no census or midterm date.
    "fx_term": f"""
SELECT acad_career, strm, term_type, term_year, full_acad_year, term_begin_dt,
       CASE WHEN q = 2 THEN NULL ELSE term_begin_dt + INTERVAL 10 DAY END AS term_census_dt,
       CASE WHEN q = 2 THEN NULL ELSE term_begin_dt + INTERVAL 45 DAY END AS term_midterm_dt,
       term_begin_dt + INTERVAL 84 DAY AS term_end_dt
FROM (SELECT DISTINCT {_CAREER} AS acad_career, {_STRM} AS strm,
             CASE quarter(o_orderdate) WHEN 1 THEN 'SPR' WHEN 2 THEN 'SUM' WHEN 3 THEN 'FAL' ELSE 'WIN' END AS term_type,
             CAST(year(o_orderdate) AS INT) AS term_year,
             CAST(year(o_orderdate) + CASE WHEN quarter(o_orderdate) >= 3 THEN 1 ELSE 0 END AS INT) AS full_acad_year,
             quarter(o_orderdate) AS q,
             CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS term_begin_dt
      FROM orders) t""",
    # One registration per order; every term holds every kind of snapshot.
    "fx_registration": f"""
SELECT o_orderkey AS class_nbr, o_custkey AS emplid, {_CAREER} AS acad_career, {_STRM} AS strm,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'census' WHEN '2-HIGH' THEN 'midterm'
                            WHEN '3-MEDIUM' THEN 'eot' ELSE 'other' END AS snapshot
FROM orders""",
    # The same registrations with the snapshot stage turning by year, so that gates open and close.
    "fx_stage_registration": f"""
SELECT o_orderkey AS class_nbr, o_custkey AS emplid, {_CAREER} AS acad_career, {_STRM} AS strm,
       CASE year(o_orderdate) % 4 WHEN 0 THEN 'census' WHEN 1 THEN 'midterm' WHEN 2 THEN 'eot' ELSE 'other' END AS snapshot
FROM orders""",
    # Days on which a run might start.
    "fx_run_days": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders",
    # The three split sets as one cohort; the label is "ordered again in 2001".
    "fx_cohort": """
SELECT c.c_custkey AS emplid,
       CASE c.c_mktsegment WHEN 'BUILDING' THEN 'PULLM' WHEN 'AUTOMOBILE' THEN 'VANCO'
            WHEN 'MACHINERY' THEN 'TRICI' WHEN 'HOUSEHOLD' THEN 'SPOKA' ELSE 'EVERE' END AS adj_acad_prog_primary_campus,
       CASE WHEN c.c_custkey % 10 < 6 THEN 'training' WHEN c.c_custkey % 10 < 8 THEN 'validation' ELSE 'testing' END AS split,
       CASE WHEN coalesce(o.n_after, 0) > 0 THEN 1 ELSE 0 END AS enrl_ind,
       CAST(c.c_custkey % 2 AS INT) AS male,
       CASE WHEN c.c_nationkey % 3 = 0 THEN 1 ELSE 0 END AS underrep_minority,
       CASE WHEN c.c_nationkey % 5 = 0 THEN 'Y' ELSE 'N' END AS first_gen_flag,
       CASE WHEN n.n_regionkey = 1 THEN 1 ELSE 0 END AS resident,
       CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS unmet_need_ofr,
       CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS unmet_need_ofr_mi,
       r.r_name AS parent1_highest_educ_lvl,
       CAST(coalesce(o.n_before, 0) AS INT) AS fall_lec_count,
       CAST(coalesce(o.n_urgent, 0) AS INT) AS fall_withdrawn_hours,
       o.max_price AS high_school_gpa
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey,
                  count(CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' THEN 1 END) AS n_after,
                  count(CASE WHEN o_orderdate <  TIMESTAMP '2001-01-01 00:00:00' THEN 1 END) AS n_before,
                  count(CASE WHEN o_orderdate <  TIMESTAMP '2001-01-01 00:00:00' AND o_orderpriority = '1-URGENT' THEN 1 END) AS n_urgent,
                  max(CASE WHEN o_orderdate <  TIMESTAMP '2001-01-01 00:00:00' THEN o_totalprice END) AS max_price
           FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
    # Scored rows with labels, two sensitive groups and tied scores.
    "fx_scored": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true,
       CAST(l_orderkey % 2 AS INT) AS male, CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS underrep_minority,
       CASE WHEN l_linestatus = 'O' THEN 'train' ELSE 'valid' END AS split,
       ((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 10007) / CAST(10007 AS DOUBLE) AS prob
FROM lineitem""",
}

CATEGORICAL = ["first_gen_flag", "parent1_highest_educ_lvl"]
NUMERIC = [
    "male", "underrep_minority", "resident", "unmet_need_ofr", "unmet_need_ofr_mi",
    "fall_lec_count", "fall_withdrawn_hours", "high_school_gpa",
]
FEATURES = CATEGORICAL + NUMERIC


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base table, columns pruned and filters pushed by the reader. Its timestamps are in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stand-in input built from the base tables below ``sf_dir``."""
    sql = VIEWS[name]
    for table in TABLES:
        if table in sql:
            load(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(sql)


def with_views(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for SQL that reads the stand-ins by name."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
