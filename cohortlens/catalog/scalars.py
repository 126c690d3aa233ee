"""Queries that show each scalar function over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as S
from ..fixtures import load, view, with_views
from .registry import COHORT, cohort, query

ORDER_DAY = "CAST(o_orderdate AS DATE)"


def orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderdate")


@query("date_part", f"SELECT o_orderkey, CAST({ORDER_DAY} AS VARCHAR) AS day FROM orders")
def date_part(spark, sf):
    return orders(spark, sf).select("o_orderkey", S.date_part("o_orderdate").alias("day"))


@query("date_fields", f"""SELECT o_orderkey, CAST(day(o_orderdate) AS INT) AS order_day, CAST(strftime({ORDER_DAY}, '%U') AS INT) AS order_week,
CAST(month(o_orderdate) AS INT) AS order_month, CAST(year(o_orderdate) AS INT) AS order_year FROM orders""")
def date_fields(spark, sf):
    return orders(spark, sf).withColumn("d", S.date_part("o_orderdate")).select("o_orderkey", *S.date_fields("d", "order"))


@query("week_sunday_zero", f"SELECT o_orderkey, CAST(strftime({ORDER_DAY}, '%U') AS INT) AS week FROM orders")
def week_sunday_zero(spark, sf):
    return orders(spark, sf).select("o_orderkey", S.week_sunday_zero(F.to_date("o_orderdate")).alias("week"))


@query("prev_day", f"SELECT o_orderkey, CAST({ORDER_DAY} - 1 AS VARCHAR) AS day FROM orders")
def prev_day(spark, sf):
    return orders(spark, sf).select("o_orderkey", S.prev_day("o_orderdate").alias("day"))


@query("coalesce_sentinel", f"""{with_views('fx_term')} SELECT acad_career, strm,
CAST(coalesce(CAST(term_census_dt AS DATE), DATE '2233-10-15') AS VARCHAR) AS term_census_dt,
CAST(coalesce(day(term_census_dt), 99999) AS INT) AS census_day, CAST(coalesce(CAST(strftime(term_census_dt, '%U') AS INT), 99999) AS INT) AS census_week,
CAST(coalesce(month(term_census_dt), 99999) AS INT) AS census_month, CAST(coalesce(year(term_census_dt), 99999) AS INT) AS census_year FROM fx_term""")
def coalesce_sentinel(spark, sf):
    df = view(spark, sf, "fx_term").withColumn("d", S.date_part("term_census_dt"))
    return df.select("acad_career", "strm", S.coalesce_days("d").alias("term_census_dt"), *S.date_fields("d", "census"))


@query("term_kind", f"{with_views('fx_registration')} SELECT class_nbr, substr(strm, 4, 1) AS kind, substr(strm, 4, 1) <> '9' AS regular FROM fx_registration")
def term_kind(spark, sf):
    df = view(spark, sf, "fx_registration")
    return df.select("class_nbr", S.term_kind("strm").alias("kind"), (S.term_kind("strm") != "9").alias("regular"))


@query("pad_student_id", """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS emplid,
concat('1234567890', CAST(c_custkey AS VARCHAR)) AS long_id FROM customer""")
def pad_student_id(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey")
    longer = F.concat(F.lit("1234567890"), F.col("c_custkey").cast("string"))
    return df.select("c_custkey", S.pad_student_id("c_custkey").alias("emplid"), S.pad_student_id(longer).alias("long_id"))


@query("risk_prob", f"""{with_views('fx_scored')}
SELECT round(1 - round_even(prob, 4), 6) AS risk_prob, count(*) AS n FROM fx_scored GROUP BY 1""")
def risk_prob(spark, sf):
    risk = F.round(S.risk_prob("prob"), 6)
    return view(spark, sf, "fx_scored").groupBy(risk.alias("risk_prob")).agg(F.count("*").alias("n"))


@query("casts", f"{COHORT} SELECT CAST(emplid AS VARCHAR) AS emplid, CAST(fall_lec_count AS DOUBLE) AS lec, CAST(enrl_ind AS VARCHAR) AS enrl, CAST(floor(high_school_gpa) AS INT) AS gpa FROM fx_cohort")
def casts(spark, sf):
    return cohort(spark, sf).select(
        F.col("emplid").cast("string").alias("emplid"), F.col("fall_lec_count").cast("double").alias("lec"),
        F.col("enrl_ind").cast("string").alias("enrl"), F.floor("high_school_gpa").cast("int").alias("gpa"),
    )


@query("day_of_week", f"SELECT o_orderkey, dayofweek(o_orderdate) = 6 AS saturday, {ORDER_DAY} = DATE '1999-12-31' AS on_day FROM orders")
def day_of_week(spark, sf):
    return orders(spark, sf).select(
        "o_orderkey", S.is_saturday("o_orderdate").alias("saturday"),
        (F.to_date("o_orderdate") == F.lit("1999-12-31").cast("date")).alias("on_day"),
    )


@query("date_text", f"SELECT o_orderkey, strftime(o_orderdate, '%m-%d-%Y') AS text, CAST({ORDER_DAY} AS VARCHAR) AS back FROM orders")
def date_text(spark, sf):
    df = orders(spark, sf).withColumn("text", S.format_day("o_orderdate"))
    return df.select("o_orderkey", "text", S.parse_day("text").alias("back"))


@query("threshold_pred", f"{with_views('fx_scored')} SELECT male, CAST(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS INT) AS pred, count(*) AS n FROM fx_scored GROUP BY 1, 2")
def threshold_pred(spark, sf):
    return view(spark, sf, "fx_scored").groupBy("male", S.threshold_pred("prob").alias("pred")).agg(F.count("*").alias("n"))


@query("round_display", f"{COHORT} SELECT emplid, round_even(high_school_gpa * 0.1234567, 1) AS one, round_even(high_school_gpa * 0.0000123457, 4) AS four FROM fx_cohort")
def round_display(spark, sf):
    return cohort(spark, sf).select(
        "emplid", S.round_display(F.col("high_school_gpa") * 0.1234567, 1).alias("one"),
        S.round_display(F.col("high_school_gpa") * 0.0000123457, 4).alias("four"),
    )
