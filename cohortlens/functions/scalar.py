"""Column functions. All are built from Spark's own expressions and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a missing date and its parts are replaced by.
MISSING_PART = 99999
MISSING_DATE = "2233-10-15"  # 99999 days after 1960-01-01
DAY_TEXT = "MM-dd-yyyy"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_part(ts: str | Column) -> Column:
    """The date of a timestamp."""
    return F.to_date(_col(ts))


def day_of_month(d: str | Column) -> Column:
    return F.dayofmonth(_col(d))


def week_sunday_zero(d: str | Column) -> Column:
    """Week of the year with weeks starting on Sunday; days before the first Sunday are week 0."""
    d = _col(d)
    return F.floor((F.dayofyear(d) - F.dayofweek(d) + 7) / 7).cast("int")


def prev_day(ts: str | Column) -> Column:
    """The day before the day of a timestamp."""
    return F.date_sub(F.to_date(_col(ts)), 1)


def coalesce_days(d: str | Column) -> Column:
    """A date, or the sentinel date when it is missing."""
    return F.coalesce(_col(d), F.lit(MISSING_DATE).cast("date"))


def date_fields(d: str | Column, prefix: str, sentinel: bool = True) -> list[Column]:
    """Day, week, month and year of a date; with ``sentinel`` a missing date gives 99999 in each."""
    d = _col(d)
    parts = {"day": F.dayofmonth(d), "week": week_sunday_zero(d), "month": F.month(d), "year": F.year(d)}
    return [
        (F.coalesce(p, F.lit(MISSING_PART)) if sentinel else p).alias(f"{prefix}_{name}")
        for name, p in parts.items()
    ]


def term_kind(strm: str | Column) -> Column:
    """The fourth character of a term code, blank when there is none."""
    return F.coalesce(F.substring(_col(strm), 4, 1), F.lit(""))


def pad_student_id(emplid: str | Column, width: int = 9) -> Column:
    """Left-pad an id with zeros; longer ids stay whole."""
    s = _col(emplid).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def risk_prob(prob: str | Column, places: int = 4) -> Column:
    """One minus the probability rounded half to even."""
    return F.lit(1.0) - F.bround(_col(prob), places)


def round_display(value: str | Column, places: int) -> Column:
    """Half-even rounding for display."""
    return F.bround(_col(value), places)


def is_saturday(d: str | Column) -> Column:
    return F.dayofweek(_col(d)) == 7


def parse_day(text: str | Column) -> Column:
    return F.to_date(_col(text), DAY_TEXT)


def format_day(d: str | Column) -> Column:
    return F.date_format(_col(d), DAY_TEXT)


def threshold_pred(prob: str | Column, cut: float = 0.5) -> Column:
    """1 when the probability is above the cut, else 0."""
    return (_col(prob) > cut).cast("int")
