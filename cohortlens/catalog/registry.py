"""The registry, and what several queries share."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..explain.contributions import linear_contributions
from ..fixtures import view, with_views
from ..operators.relational import complete_cases
from ..plans.calendar import academic_calendar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF_YEAR = 2001
RUN_DATE = datetime.date(2001, 8, 1)
RUN_DAY = "DATE '2001-08-01'"

# A fixed linear score, so that everything built on a score has an exact counterpart in SQL.
INTERCEPT = -0.3
COEFFICIENTS = {
    "male": 0.1, "underrep_minority": -0.2, "resident": 0.3, "unmet_need_ofr": -0.0001,
    "fall_lec_count": 0.05, "fall_withdrawn_hours": -0.15, "high_school_gpa": 0.000002,
}
SCORED = list(COEFFICIENTS)


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every engine prints alike."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf: plain(fn(spark, sf))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def r6(c: str | Column) -> Column:
    """Rounded to six places, without negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def cohort(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_cohort")


def complete(spark: SparkSession, sf: str) -> DataFrame:
    return complete_cases(cohort(spark, sf), ["unmet_need_ofr", "high_school_gpa"])


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return academic_calendar(view(spark, sf, "fx_term"), AS_OF_YEAR)


def score() -> Column:
    total = F.lit(INTERCEPT)
    for c, b in COEFFICIENTS.items():
        total = total + F.lit(b) * F.col(c)
    return total


def probability() -> Column:
    return 1.0 / (1.0 + F.exp(-score()))


def scored_complete(spark: SparkSession, sf: str) -> DataFrame:
    return complete(spark, sf).withColumn("prob", probability())


def training_means(df: DataFrame) -> dict[str, float]:
    """Feature means of the training rows, rounded so that every engine gets the same ones."""
    row = df.where("split = 'training'").agg(*[F.round(F.avg(c), 6).alias(c) for c in SCORED]).first()
    return {c: row[c] for c in SCORED}


def contributions(spark: SparkSession, sf: str) -> DataFrame:
    """emplid, split and the contributions of the fixed score for class 0."""
    df = complete(spark, sf)
    return df.select("emplid", "split", linear_contributions(SCORED, COEFFICIENTS, training_means(df), flip=True).alias("contributions"))


# --- SQL counterparts --------------------------------------------------------------------------

SQL_COMPLETE = "complete AS (SELECT * FROM fx_cohort WHERE unmet_need_ofr IS NOT NULL AND high_school_gpa IS NOT NULL)"
SQL_SCORE = f"({INTERCEPT} + " + " + ".join(f"CAST({b:.10f} AS DOUBLE) * {c}" for c, b in COEFFICIENTS.items()) + ")"
SQL_PROB = f"(1.0 / (1.0 + exp(-{SQL_SCORE})))"
COHORT = with_views("fx_cohort")
COMPLETE = f"{COHORT},\n{SQL_COMPLETE}"
SQL_CONTRIB = f"""{COMPLETE},
means AS (SELECT {', '.join(f'round(avg({c}), 6) AS {c}' for c in SCORED)} FROM complete WHERE split = 'training'),
contrib AS ({' UNION ALL '.join(
    f"SELECT a.emplid, a.split, '{c}' AS feature, CAST({-b:.10f} AS DOUBLE) * (CAST(a.{c} AS DOUBLE) - m.{c}) AS value FROM complete a, means m"
    for c, b in COEFFICIENTS.items())}),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY emplid ORDER BY abs(value) DESC, feature) AS INT) AS rank FROM contrib)"""


def _parts(d: str, prefix: str, sentinel: bool = True) -> str:
    wrap = (lambda e: f"coalesce({e}, 99999)") if sentinel else (lambda e: e)
    return ", ".join([
        f"CAST({wrap(f'day({d})')} AS INT) AS {prefix}_day",
        f"CAST({wrap(f'''CAST(strftime({d}, '%U') AS INT)''')} AS INT) AS {prefix}_week",
        f"CAST({wrap(f'month({d})')} AS INT) AS {prefix}_month",
        f"CAST({wrap(f'year({d})')} AS INT) AS {prefix}_year",
    ])


SQL_CALENDAR = f"""cal AS (
SELECT acad_career, term_year, term_type, strm, full_acad_year,
       b AS term_begin_dt, {_parts('b', 'begin')}, c AS term_census_dt, {_parts('c', 'census')},
       m AS term_midterm_dt, {_parts('m', 'midterm')}, e AS term_eot_dt, {_parts('e', 'eot', False)},
       coalesce(n, DATE '2233-10-15') AS term_end_dt, {_parts('n', 'end')}
FROM (SELECT acad_career, term_year, term_type, strm, full_acad_year,
             CAST(term_begin_dt AS DATE) AS b, CAST(term_census_dt AS DATE) AS c, CAST(term_midterm_dt AS DATE) AS m,
             CAST(term_end_dt AS DATE) AS e,
             CAST(lead(term_begin_dt) OVER (PARTITION BY acad_career ORDER BY strm) AS DATE) - 1 AS n
      FROM fx_term WHERE acad_career = 'UGRD' AND term_year <= {AS_OF_YEAR}) t)"""
