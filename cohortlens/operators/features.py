"""Feature preparation as column expressions: one-hot, scaling, design matrix, named features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import RFormula, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_groups


def levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The sorted categories of each column, in one pass.

    They become names of columns, so the driver must know them all; there are as many as the result has columns.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    found = df.select(F.inline(pairs)).where("v IS NOT NULL").distinct().collect()
    return {c: sorted(r["v"] for r in found if r["c"] == c) for c in columns}


@dataclass
class OneHot:
    """Indicators for every category but the first of each column, by unit.

    ``categories`` is the sorted union over all units; the dropped category is the first one a unit
    has, so each unit is encoded as if it were alone.
    """

    categories: dict[str, list[str]]
    by: list[str]
    known: DataFrame | None
    unseen: str = "error"

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], by: list[str] = (), unseen: str = "error") -> "OneHot":
        """``unseen`` is what to do with a category that the fitted rows lack: ``error`` or all ``zero``."""
        by = list(by)
        cats = levels(df, columns)
        if not by:
            return cls(cats, by, None, unseen)
        known = df.groupBy(*by).agg(*[F.sort_array(F.collect_set(c)).alias(f"_lv_{c}") for c in columns])
        return cls(cats, by, known, unseen)

    def _missing(self, column: str) -> Column:
        if self.unseen == "zero":
            return F.lit(0.0)
        return F.raise_error(F.concat(F.lit(f"unseen category in {column}: "), F.col(column))).cast("double")

    def names(self, dropped_first: bool | None = None) -> list[str]:
        drop = not self.by if dropped_first is None else dropped_first
        return [f"{c}_{v}" for c, vs in self.categories.items() for v in (vs[1:] if drop else vs)]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the indicator columns."""
        if not self.by:
            out = {}
            for c, vs in self.categories.items():
                seen = F.col(c).isin(*vs)
                for v in vs[1:]:
                    out[f"{c}_{v}"] = F.when(seen, (F.col(c) == v).cast("double")).otherwise(self._missing(c))
            return df.withColumns(out) if out else df
        joined = join_groups(df, self.known, self.by, "left")  # a group that was not fitted has seen nothing
        out = {}
        for c, vs in self.categories.items():
            seen = F.coalesce(F.array_contains(f"_lv_{c}", F.col(c)), F.lit(False))
            first = F.get(F.col(f"_lv_{c}"), 0)
            for v in vs:
                out[f"{c}_{v}"] = F.when(seen, ((F.col(c) == v) & (first != v)).cast("double")).otherwise(self._missing(c))
        return joined.withColumns(out).drop(*[f"_lv_{c}" for c in self.categories])


def standard_scale(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    stats = df.groupBy(*by).agg(*[
        f(c).alias(f"_{tag}_{c}") for c in columns for tag, f in (("mu", F.avg), ("sd", F.stddev_pop))
    ])
    if by:
        joined, stat = join_groups(df, stats, list(by)), F.col
    else:
        joined, row = df, stats.first()
        stat = lambda name: F.lit(row[name])
    scaled = {}
    for c in columns:
        sd = stat(f"_sd_{c}")
        scaled[c] = (F.col(c) - stat(f"_mu_{c}")) / F.when(sd > 0, sd).otherwise(F.lit(1.0))
    return joined.withColumns(scaled).drop(*[c for c in stats.columns if c.startswith("_")])


def as_array(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def assemble(columns: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error")


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """The names of a vector's entries, from its ML attributes."""
    groups = df.schema[vector].metadata["ml_attr"]["attrs"]
    entries = [a for kind in groups.values() for a in kind]
    return [a["name"] for a in sorted(entries, key=lambda a: a["idx"])]


def named_features(df: DataFrame, key: list[str], vector: str = "features") -> DataFrame:
    """(key, feature, value) rows from an assembled vector."""
    names = F.array(*[F.lit(n) for n in feature_names(df, vector)])
    return df.select(*key, F.posexplode(vector_to_array(vector)).alias("pos", "value")).select(
        *key, F.get(names, F.col("pos")).alias("feature"), "value"
    )


def design_matrix(df: DataFrame, formula: str) -> tuple[PipelineModel, DataFrame]:
    """Treatment-coded features and label from ``y ~ a + b``; the first category is the base."""
    coder = RFormula(formula=formula, featuresCol="design", labelCol="outcome",
                     stringIndexerOrderType="alphabetDesc", handleInvalid="error")
    fitted = Pipeline(stages=[coder]).fit(df)
    return fitted, fitted.transform(df)


def design_columns(df: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """The design vector as columns, with the intercept first."""
    unpacked = df.withColumn("_x", vector_to_array("design"))
    return unpacked.select(
        *key, F.lit(1.0).alias("intercept"), *[F.get(F.col("_x"), i).alias(n) for i, n in enumerate(names)]
    )
