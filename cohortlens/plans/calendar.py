"""The academic calendar, the stage gates, and the plan of runs they allow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coalesce_days, date_fields, date_part, is_saturday, prev_day, term_kind
from ..operators.relational import date_gate, interval_lookup, next_in_group, snapshot_rank, where_on_read
from .dimensions import POPULATIONS, STAGES, stage_table


def academic_calendar(terms: DataFrame, as_of_year: int, career: str = "UGRD") -> DataFrame:
    """One row per term with date parts; a term ends the day before the next one begins.

    The last term has no next one and gets the sentinel end date and parts.
    """
    following = next_in_group(where_on_read(terms, as_of_year, career), "acad_career", "strm", "term_begin_dt", "_next")
    days = following.withColumns({
        "_begin": date_part("term_begin_dt"), "_census": date_part("term_census_dt"),
        "_midterm": date_part("term_midterm_dt"), "_eot": date_part("term_end_dt"), "_end": prev_day("_next"),
    })
    return days.select(
        "acad_career", "term_year", "term_type", "strm", "full_acad_year",
        F.col("_begin").alias("term_begin_dt"), *date_fields("_begin", "begin"),
        F.col("_census").alias("term_census_dt"), *date_fields("_census", "census"),
        F.col("_midterm").alias("term_midterm_dt"), *date_fields("_midterm", "midterm"),
        F.col("_eot").alias("term_eot_dt"), *date_fields("_eot", "eot", sentinel=False),
        coalesce_days("_end").alias("term_end_dt"), *date_fields("_end", "end"),
    )


def term_as_of(days: DataFrame, calendar: DataFrame, day: str = "as_of", end: str = "term_end_dt") -> DataFrame:
    """The term each day falls in; days in no term drop out."""
    return interval_lookup(days, calendar, day, "term_begin_dt", end, ["strm", "term_type", "term_begin_dt"])


def _pick(choice: str, names: list[str]) -> Column:
    """The value of the column whose name stands in ``choice``."""
    return reduce(lambda acc, n: acc.when(F.col(choice) == n, F.col(n)), names[1:],
                  F.when(F.col(choice) == names[0], F.col(names[0])))


def rank_by_term(registration: DataFrame, calendar: DataFrame, career: str = "UGRD") -> DataFrame:
    """For each calendar term the snapshot rank of the latest regular term registered by then.

    Works on one row per term, after the registrations are aggregated.
    """
    per_term = snapshot_rank(
        registration.where((F.col("acad_career") == career) & (term_kind("strm") != "9")), ["strm"]
    )
    upto = Window.partitionBy("acad_career").orderBy("strm")
    # Registered terms that the calendar lacks still count as earlier ones.
    every = calendar.select("strm").join(per_term, "strm", "full").withColumn("acad_career", F.lit(career))
    return every.select("strm", F.last("snap_order", ignorenulls=True).over(upto).alias("snap_order"))


def stage_gate(days: DataFrame, calendar: DataFrame, registration: DataFrame, day: str = "as_of") -> DataFrame:
    """For every day and stage of its term: is the date reached, is the snapshot right, is the stage open."""
    spark = days.sparkSession
    dates = ["term_begin_dt", "term_census_dt", "term_midterm_dt", "term_end_dt"]
    ranks = rank_by_term(registration, calendar)
    per_term = calendar.select("term_type", "strm", *dates).join(ranks, "strm").join(stage_table(spark), "term_type")
    gates = per_term.select(
        "term_type", "strm", "stage", "priority", "model_id", "required_rank", "snap_order",
        _pick("gate_column", sorted({s[3] for s in STAGES})).alias("gate_dt"),
        _pick("window_column", sorted({s[4] for s in STAGES})).alias("window_end_dt"),
    )
    term = term_as_of(days, calendar, day).select(day, "strm")
    checked = term.join(gates, "strm").withColumns({
        "in_window": F.coalesce(F.col(day) <= F.col("window_end_dt"), F.lit(False)),
        "date_reached": date_gate(day, "gate_dt"),
        "snapshot_ok": F.col("required_rank").isNull() | F.coalesce(F.col("snap_order") == F.col("required_rank"), F.lit(False)),
    })
    status = (
        F.when(~F.col("in_window"), "no term")
        .when(~F.col("date_reached"), "date exception")
        .when(~F.col("snapshot_ok"), "snapshot exception")
        .otherwise("open")
    )
    return checked.withColumn("status", status).select(
        day, "term_type", "strm", "stage", "priority", "model_id", "gate_dt", "snap_order", "date_reached",
        "snapshot_ok", "status",
    )


def run_plan(days: DataFrame, calendar: DataFrame, registration: DataFrame, day: str = "as_of") -> DataFrame:
    """The first open stage of each day, run for all populations in order; no open stage, no rows."""
    gates = stage_gate(days, calendar, registration, day)
    chosen = gates.where(F.col("status") == "open").groupBy(day).agg(
        F.min_by(F.struct("term_type", "strm", "stage", "model_id"), F.col("priority")).alias("_run")
    ).select(day, "_run.*")
    # Every stage lists the same populations, so they come from an array rather than a join.
    pops = F.array(*[
        F.struct(F.lit(order).alias("run_order"), F.lit(name).alias("model_descr")) for order, name, _ in POPULATIONS
    ])
    return chosen.select(day, "term_type", "strm", "stage", "model_id", F.inline(pops))


def retrain_plan(days: DataFrame, calendar: DataFrame, day: str = "as_of") -> DataFrame:
    """Days on which data sets are rebuilt and models refitted: a term's first day, and Saturdays."""
    term = term_as_of(days, calendar, day)
    return term.select(
        day, "strm", "term_type", ((F.col(day) == F.col("term_begin_dt")) | is_saturday(day)).alias("refit")
    )
