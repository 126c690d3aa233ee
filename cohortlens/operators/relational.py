"""Projections, filters, joins, aggregates and windows of the scoring flow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import term_kind
from ..session import cut, join_groups

# The order of registration snapshots.
SNAPSHOT_ORDER = {"census": 1, "midterm": 2, "eot": 3}



# --- projections and filters -------------------------------------------------------------------

def select_features(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)


def exclude_vars(names: list[str], unwanted: tuple[str, ...] = ("emplid", "enrl_ind")) -> list[str]:
    """The listed names without id and label, order kept."""
    return [n for n in names if n not in unwanted]


def campus_filter(df: DataFrame, campuses: list[str], column: str = "adj_acad_prog_primary_campus") -> DataFrame:
    return df.where(F.col(column).isin(*campuses))


def complete_cases(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows with no NULL and no NaN in the named columns.

    One condition per column, so that each reaches the scan and turns outer joins into inner ones.
    """
    kinds = dict(df.dtypes)
    present = [F.col(n).isNotNull() & ~F.isnan(n) if kinds[n] in ("double", "float") else F.col(n).isNotNull() for n in names]
    return df.where(reduce(Column.__and__, present)) if present else df


def label_case(code: str | Column, labels: dict) -> Column:
    """A description for each code; other codes stay NULL."""
    code = F.col(code) if isinstance(code, str) else code
    arms = iter(labels.items())
    first, text = next(arms)
    return reduce(lambda acc, kv: acc.when(code == kv[0], kv[1]), arms, F.when(code == first, text))


def where_on_read(terms: DataFrame, as_of_year: int, career: str = "UGRD") -> DataFrame:
    """Terms of one career up to a year, filtered at the scan."""
    return terms.where((F.col("acad_career") == career) & (F.col("term_year") <= as_of_year))


def fill_sentinel(df: DataFrame, value: int = 9999) -> DataFrame:
    """A sentinel for every missing numeric value."""
    return df.na.fill(value)


def date_gate(day: str | Column, gate: str | Column) -> Column:
    """True from the gate date on; a missing gate date keeps the gate closed."""
    day = F.col(day) if isinstance(day, str) else day
    gate = F.col(gate) if isinstance(gate, str) else gate
    return F.coalesce(day >= gate, F.lit(False))


# --- ordinals ----------------------------------------------------------------------------------

def row_ordinal(df: DataFrame, keys: list[str], name: str = "ordinal") -> DataFrame:
    """0..n-1 in the order of ``keys`` (which must be unique), without a one-task window.

    Rows are range partitioned and sorted; a row's ordinal is its place in its partition plus the
    rows of the partitions before it. The sorted rows are written once, so that places and counts
    come from the same layout. The offsets table has one row per partition.
    """
    placed = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ordinal",
    )
    # monotonically_increasing_id keeps the partition above bit 33 and the place below it.
    placed = placed.withColumn("_part", F.shiftright("_place", 33)).withColumn(
        "_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return placed.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_place")).drop(
        "_part", "_place", "_before"
    )


def running_index(df: DataFrame, groups: list[str], keys: list[str], name: str = "idx") -> DataFrame:
    """1, 2, 3, ... inside each group in the order of ``keys``; safe for a group of any size."""
    if not groups:
        return row_ordinal(df, keys, "_ordinal").withColumn(name, F.col("_ordinal") + 1).drop("_ordinal")
    numbered = row_ordinal(df, [*groups, *keys], "_ordinal")
    starts = numbered.groupBy(*groups).agg(F.min("_ordinal").alias("_start"))
    return join_groups(numbered, starts, groups).withColumn(name, F.col("_ordinal") - F.col("_start") + 1).drop(
        "_ordinal", "_start"
    )


# --- joins -------------------------------------------------------------------------------------

def hot_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, how: str = "inner", rows: int = 1_000_000) -> DataFrame:
    """Equi-join (inner or left) that spreads each key in ``hot`` over a task per ``rows`` of its rows, two at least.

    ``right`` holds one row per key. ``hot`` has the keys with their number of rows as ``c``, and must be small by
    construction: the keys holding more than 1/m of all rows number fewer than m.
    """
    parts = F.greatest(F.lit(2), F.ceil(F.col("c") / rows)).cast("int")
    mark = F.broadcast(hot.select(*on, parts.alias("_parts")))
    spread = F.pmod(F.xxhash64(*[c for c in left.columns]), F.col("_parts")).cast("int")
    salted = left.join(mark, on, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_parts")
    every = F.explode(F.coalesce(F.sequence(F.lit(0), F.col("_parts") - 1), F.array(F.lit(0))))
    copied = right.join(mark, on, "left").withColumn("_salt", every).drop("_parts")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def next_in_group(df: DataFrame, group: str, order: str, column: str, name: str) -> DataFrame:
    """The value of ``column`` in the next row of the group. For dimension tables such as calendars."""
    return df.withColumn(name, F.lead(column).over(Window.partitionBy(group).orderBy(order)))


def interval_lookup(days: DataFrame, calendar: DataFrame, day: str, begin: str, end: str, keep: list[str]) -> DataFrame:
    """Each row with the first calendar row (by ``strm``) whose interval holds its day; others drop out.

    Distinct days are looked up, and their terms joined back, so a long table is only aggregated to
    its days. Each interval is listed once per year it touches, which makes the match an equi-join
    on the year with the interval as a residual filter.
    """
    listed = calendar.where(F.col(begin).isNotNull() & F.col(end).isNotNull()).withColumn(
        "_year", F.explode(F.sequence(F.year(begin), F.year(end)))
    )
    asked = days.select(F.col(day).alias("_day")).distinct().withColumn("_year", F.year("_day"))
    hits = asked.join(listed, "_year").where(F.col("_day").between(F.col(begin), F.col(end)))
    terms = hits.groupBy("_day").agg(F.min_by(F.struct(*keep), F.col("strm")).alias("_hit")).select("_day", "_hit.*")
    return days.join(terms.withColumnRenamed("_day", day), day)


def last_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """For each key the row with the highest ``seq``; partial aggregation absorbs hot keys."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_row")).select(key, "_row.*")


def removed_rows(before: DataFrame, kept: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``before`` whose key was not kept."""
    return before.join(kept.select(*key), key, "left_anti")


def in_latest_term(registration: DataFrame, career: str = "UGRD") -> DataFrame:
    """Registrations of the latest regular term, found by a scalar subquery."""
    regs = registration.where(F.col("acad_career") == career)
    return regs.where(F.col("strm") == latest_term(registration, career).scalar())


# --- aggregates --------------------------------------------------------------------------------

def snapshot_order(snapshot: str = "snapshot") -> Column:
    arms = reduce(
        lambda acc, kv: acc.when(F.col(snapshot) == kv[0], kv[1]) if acc is not None
        else F.when(F.col(snapshot) == kv[0], kv[1]),
        SNAPSHOT_ORDER.items(), None,
    )
    return arms.otherwise(0)


def snapshot_rank(registration: DataFrame, by: list[str]) -> DataFrame:
    """The furthest snapshot reached, per group."""
    return registration.groupBy(*by).agg(F.max(snapshot_order()).alias("snap_order"))


def latest_term(registration: DataFrame, career: str = "UGRD") -> DataFrame:
    """The highest term code of a career, terms of kind 9 left out."""
    return registration.where((F.col("acad_career") == career) & (term_kind("strm") != "9")).agg(
        F.max("strm").alias("strm")
    )


def class_weight(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """Class counts, the weight of the positive class, and the balanced weight of each class."""
    n0 = F.count_if(F.col(label) == 0)
    n1 = F.count_if(F.col(label) == 1)
    counted = df.groupBy(*by).agg(n0.alias("n0"), n1.alias("n1"))
    total = F.col("n0") + F.col("n1")

    def over(num, den):
        return F.when(den > 0, num.cast("double") / den)

    return counted.select(
        *by, "n0", "n1",
        over(F.col("n0"), F.col("n1")).alias("pos_weight"),
        over(total, 2 * F.col("n0")).alias("balanced_0"),
        over(total, 2 * F.col("n1")).alias("balanced_1"),
    )


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, kind) rows: text by type, binary when only 0 and 1 occur, else continuous. One pass."""
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in cols if isinstance(types[c], T.StringType)]
    flags = [F.bool_and(F.coalesce(F.col(c).isin(0, 1), F.lit(False))).alias(c) for c in cols if c not in text]
    kinds = [
        F.struct(
            F.lit(c).alias("column"),
            (F.lit("text") if c in text else F.when(F.col(c), "binary").otherwise("continuous")).alias("kind"),
        )
        for c in cols
    ]
    profiled = df.agg(*flags) if flags else df.limit(1)
    return profiled.select(F.inline(F.array(*kinds)))


def continuous_vars(profile: DataFrame, substring: bool = False) -> DataFrame:
    """Columns that are neither text nor binary.

    ``substring`` also hides a column whose name contains the name of a text or binary column, as
    name matching by containment does.
    """
    found = profile.where(F.col("kind") == "continuous").select("column")
    if not substring:
        return found
    other = profile.where(F.col("kind") != "continuous").agg(F.collect_set("column").alias("others"))
    return found.withColumn("others", other.scalar()).where(
        ~F.exists("others", lambda o: F.col("column").contains(o))
    ).select("column")


# --- ranked contributions and reshape ----------------------------------------------------------

def ranked(contributions: str | Column) -> Column:
    """An array of (feature, value) ordered by absolute value, ties by name. No shuffle: row by row."""
    col = F.col(contributions) if isinstance(contributions, str) else contributions
    keyed = F.transform(col, lambda c: F.struct(
        (-F.abs(c["value"])).alias("k"), c["feature"].alias("feature"), c["value"].alias("value")
    ))
    return F.transform(F.array_sort(keyed), lambda c: F.struct(c["feature"].alias("feature"), c["value"].alias("value")))


def rank_long(df: DataFrame, key: list[str], ranked_col: str, n: int | None = None) -> DataFrame:
    """Long rows (key, rank, feature, value) from a ranked array, the first ``n`` only if given."""
    col = F.col(ranked_col) if n is None else F.slice(ranked_col, 1, n)
    return df.select(*key, F.posexplode(col).alias("pos", "c")).select(
        *key, (F.col("pos") + 1).alias("rank"), F.col("c.feature").alias("feature"), F.col("c.value").alias("value")
    )


def topn_wide(ranked_col: str, n: int, places: int = 4) -> list[Column]:
    """2n columns shap_descr_k, shap_value_k from a ranked array; absent entries are NULL."""
    out = []
    for k in range(1, n + 1):
        entry = F.get(F.col(ranked_col), k - 1)
        out += [entry["feature"].alias(f"shap_descr_{k}"), F.bround(entry["value"], places).alias(f"shap_value_{k}")]
    return out


# --- set operations ----------------------------------------------------------------------------

def union_history(prior: DataFrame, current: DataFrame) -> DataFrame:
    return prior.unionByName(current, allowMissingColumns=True)


def mask_partition(df: DataFrame, mask: str = "mask") -> tuple[DataFrame, DataFrame]:
    """(kept, removed) by a mask of 1 and -1."""
    return df.where(F.col(mask) == 1).drop(mask), df.where(F.col(mask) == -1).drop(mask)
