"""Linear models of one data set: least squares with a summary, the Huber classifier, votes."""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import assemble
from ..operators.relational import complete_cases

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def prob_of_one(vector: str = "probability") -> Column:
    return F.get(vector_to_array(F.col(vector)), F.lit(1))


# --- cross products: one pass for every group ---------------------------------------------------

def _partial_sums(width: int, value):
    """Sum ``value(x, tag)`` per tag inside a partition and emit one row per tag."""

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("_x").flatten(), dtype=float).reshape(-1, width)
            tags = batch.column("tag").dictionary_encode()
            codes = tags.indices.to_numpy()
            for i, tag in enumerate(tags.dictionary.to_pylist()):
                part = value(x[codes == i], tag)
                held[tag] = held[tag] + part if tag in held else part
        for tag, total in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([tag]), pa.array([total.ravel().tolist()], type=pa.list_(pa.float64()))],
                names=["tag", "total"],
            )

    return run


def grouped_sums(df: DataFrame, by: list[str], value, width: int) -> dict[tuple, np.ndarray]:
    """Sums of a per-row array over each group, added up in Spark; the result is bounded by groups x entries."""
    tag = F.to_json(F.array(*[F.col(c).cast("string") for c in by])) if by else F.lit("[]")
    parts = df.select(tag.alias("tag"), "_x").mapInArrow(_partial_sums(width, value), "tag string, total array<double>")
    total = parts.select("tag", F.posexplode("total").alias("i", "v")).groupBy("tag", "i").agg(F.sum("v").alias("v"))
    packed = total.groupBy("tag").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("t"))
    return {tuple(json.loads(r["tag"])): np.array([e["v"] for e in r["t"]])
            for r in packed.collect()}


def ols(df: DataFrame, y: str, xs: list[str]):
    """Least squares with its summary (standard errors, t, p, R squared)."""
    data = assemble(xs).transform(complete_cases(df, [y, *xs]))
    return LinearRegression(labelCol=y, solver="normal", predictionCol="predicted").fit(data)


# --- classifiers -------------------------------------------------------------------------------

def balanced_weight(df: DataFrame, label: str) -> Column:
    """Row weight n / (2 n_class) of a data set, as an expression."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    n0, n1 = row["n0"], row["n1"]
    if not n0 or not n1:
        return F.lit(1.0)
    return F.when(F.col(label) == 0, (n0 + n1) / (2.0 * n0)).otherwise((n0 + n1) / (2.0 * n1))


@dataclass
class HuberLinear:
    """A linear score with the probability (clip(f, -1, 1) + 1) / 2."""

    columns: list[str]
    coefficients: np.ndarray
    intercept: float
    losses: list[float]
    converged: bool

    def score(self) -> Column:
        f = F.lit(float(self.intercept))
        for c, b in zip(self.columns, self.coefficients):
            f = f + F.col(c) * float(b)
        return f

    def probability(self) -> Column:
        return huber_probability(self.score())


def huber_probability(f: Column) -> Column:
    return (F.least(F.greatest(f, F.lit(-1.0)), F.lit(1.0)) + 1) / 2


def huber_linear(train: DataFrame, columns: list[str], label: str, l2: float = 1e-4, steps: int = 5000,
                 eta: float = 0.5, tol: float = 1e-4, patience: int = 3) -> HuberLinear:
    """Class-balanced linear classifier under the modified Huber loss, by full-batch gradient steps.

    One aggregate per step; the rate halves when the loss does not improve. Features are centred
    and scaled for the descent and the result is stated for the raw columns.
    """
    stats = train.agg(*[f(c).alias(f"{t}{i}") for i, c in enumerate(columns)
                        for t, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mu = np.array([float(stats[f"m{i}"]) for i in range(len(columns))])
    sd = np.array([float(stats[f"s{i}"]) or 1.0 for i in range(len(columns))])
    p = len(columns)
    sign = F.when(F.col(label) == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
    entries = [(F.col(c).cast("double") - float(m)) / float(s) for c, m, s in zip(columns, mu, sd)]
    rows = train.select(F.array(*entries, sign, balanced_weight(train, label)).alias("_x")).persist()
    beta, best, best_loss, grad = np.zeros(p + 1), np.zeros(p + 1), np.inf, None
    losses, stale, converged = [], 0, False
    for _ in range(steps):

        def value(x, tag, beta=beta):
            feats, y, w = x[:, :p], x[:, p], x[:, p + 1]
            z = y * (feats @ beta[:p] + beta[p])
            loss = np.where(z >= 1, 0.0, np.where(z >= -1, (1 - z) ** 2, -4 * z))
            slope = np.where(z >= 1, 0.0, np.where(z >= -1, -2 * (1 - z), -4.0)) * y * w
            return np.concatenate([feats.T @ slope, [slope.sum(), (loss * w).sum(), w.sum()]])

        total = grouped_sums(rows, [], value, p + 2)[()]
        loss = total[p + 1] / total[p + 2] + 0.5 * l2 * float(beta[:p] @ beta[:p])
        losses.append(float(loss))
        if loss < best_loss - tol:
            stale = 0
        else:
            stale += 1
        if loss < best_loss:
            best, best_loss = beta, loss
            grad = total[: p + 1] / total[p + 2] + l2 * np.append(beta[:p], 0.0)
        else:
            eta /= 2
        if stale > patience:
            converged = True
            break
        beta = best - eta * grad
    rows.unpersist()
    raw = best[:p] / sd
    return HuberLinear(columns, raw, float(best[p] - raw @ mu), losses, converged)


def soft_vote(*probs: str) -> Column:
    """The equal-weight mean of several probabilities."""
    total = F.col(probs[0])
    for p in probs[1:]:
        total = total + F.col(p)
    return total / len(probs)
