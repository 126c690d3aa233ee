"""Cohorts: every unit's training, validation and testing rows from one pass over the split sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import campus_filter, complete_cases
from .dimensions import unit_table

CAMPUS = "adj_acad_prog_primary_campus"


def campus_cohort(df: DataFrame, names: list[str], campuses: list[str], require_label: bool = True) -> DataFrame:
    """Complete rows of some campuses with the named columns and their split.

    ``require_label`` also drops testing rows whose label is missing, and the label of testing rows
    is not part of the result.
    """
    return _finish(campus_filter(df, campuses), names, [], require_label)


def system_cohort(df: DataFrame, names: list[str], campuses: list[str], require_label: bool = True) -> DataFrame:
    """As ``campus_cohort``, but training and validation rows come from every campus."""
    return _finish(df.where((F.col("split") != "testing") | F.col(CAMPUS).isin(*campuses)), names, [], require_label)


def _finish(df: DataFrame, names: list[str], extra: list[str], require_label: bool) -> DataFrame:
    testing = F.col("split") == "testing"
    if require_label or "enrl_ind" not in names:
        kept = complete_cases(df, names)
    else:
        kept = complete_cases(df, [n for n in names if n != "enrl_ind"]).where(testing | F.col("enrl_ind").isNotNull())
    picked = [F.when(~testing, F.col(n)).alias(n) if n == "enrl_ind" else F.col(n) for n in names]
    return kept.select(*extra, "split", *picked)


def route_units(df: DataFrame, units: str = "PVTU") -> DataFrame:
    """Each row once per unit that trains on it or scores it. A campus may be scored by two units."""
    dim = unit_table(df.sparkSession, units).withColumnRenamed("campus", CAMPUS)
    testing = F.col("split") == "testing"
    return df.join(dim, CAMPUS).where((testing & F.col("scores")) | (~testing & F.col("trains"))).drop("trains", "scores")


def unit_cohorts(df: DataFrame, names: list[str], units: str = "PVTU", require_label: bool = True) -> DataFrame:
    """All units' complete-case cohorts in one table with a ``unit`` column."""
    return _finish(route_units(df, units), names, ["unit"], require_label)
