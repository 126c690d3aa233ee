"""Least squares, inflation factors and logits of any number of groups, fitted inside Spark.

Rows are centred on their group's means, tasks add up cross products (or scores and Hessians) by group, and the sums of
a group meet in one task, which solves the group's small system. Results are tables with a row for each group, joined to
rows where they are needed; nothing about a group comes to the driver, so there may be as many as rows allow. A logit
takes one job for each Newton step of all groups that have not converged.

A null in a group column is a group like any other.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import complete_cases
from ..session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FLUSH = 4 << 20  # numbers that a task holds before it passes them on
BUCKET = 4 << 20  # numbers that one task solves
RANK = 1e-12  # least share of the largest eigenvalue in a scaled system of full rank
STEPS = 100
FLAT = 1e-9  # mean score, in deviations of the columns, at which a logit has converged


def tag_of(by: list[str]) -> Column:
    return F.to_json(F.array(*[F.col(c).cast("string") for c in by])) if by else F.lit("[]")


def group_means(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """tag, the group columns, n, mu and sd of each group, in the shared folder."""
    array = lambda f: F.array(*[F.coalesce(f(F.col(c).cast("double")), F.lit(0.0)) for c in columns])
    return cut(df.groupBy(*by).agg(F.count("*").alias("n"), array(F.avg).alias("mu"), array(F.stddev_pop).alias("sd")).where("n > 0").withColumn("tag", tag_of(by)), "means")


def rows_by_tag(tags: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
    coded = tags.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    marks = np.flatnonzero(np.diff(codes[order])) + 1
    for tag, rows in zip(coded.dictionary.to_pylist(), np.split(order, marks)):
        yield tag, rows


def matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def group_sums(rows: DataFrame, value: Callable) -> DataFrame:
    """(tag, sums): ``value(x, extra)`` of the rows (tag, x and, if any, b) of each tag in a task, as partial sums."""
    has = "b" in rows.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        size = 0
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["tag", "sums"])
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            for tag, at in rows_by_tag(b.column("tag")):
                beta = np.array(b.column("b")[int(at[0])].as_py()) if has else None
                mine = value(x[at], beta)
                size += 0 if tag in held else mine.size
                held[tag] = held[tag] + mine if tag in held else mine
            if size > FLUSH:
                yield emit()
                held, size = {}, 0
        if held:
            yield emit()

    return rows.mapInArrow(add, "tag string, sums binary")


def solved(sums: DataFrame, facts: DataFrame, numbers: int, solve: Callable, schema: str) -> DataFrame:
    """The rows that ``solve(fact, sums)`` gives for each tag; ``facts`` has a row per tag, ``numbers`` the sums of a tag."""
    tasks = 1 + facts.count() * numbers // BUCKET
    tasks = max(tasks, min(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8))
    bucket = F.pmod(F.xxhash64("tag"), F.lit(tasks))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        total: dict[str, np.ndarray] = {}
        for tag, raw in zip(left.column("tag").to_pylist(), left.column("sums").to_pylist()):
            mine = np.frombuffer(raw, np.float64)
            total[tag] = total[tag] + mine if tag in total else mine
        out = [row for fact in right.to_pylist() if fact["tag"] in total for row in solve(fact, total[fact["tag"]])]
        kinds = [pa.string() if t.endswith(" string") else pa.list_(pa.float64()) if "array" in t else pa.float64() if t.endswith("double") else pa.int64() if t.endswith("long") else pa.bool_()
                 for t in schema.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)

    return sums.groupBy(bucket).cogroup(facts.groupBy(bucket)).applyInArrow(run, schema)


def cross_products(df: DataFrame, columns: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(means, sums of the centred cross products) of each group."""
    means = group_means(df, columns, by)
    x = F.array(*[F.col(c).cast("double") - F.get("mu", F.lit(i)) for i, c in enumerate(columns)]).alias("x")
    rows = df.withColumn("tag", tag_of(by)).join(means.select("tag", "mu"), "tag").select("tag", x)
    return means, group_sums(rows, lambda x, _: (x.T @ x).ravel())


# --- least squares -----------------------------------------------------------------------------

def least_squares(df: DataFrame, y: str, xs: list[str], by: list[str] = ()) -> DataFrame:
    """The group columns, tag, n and beta (intercept first) of each group's fit over complete rows."""
    by, p = list(by), len(xs) + 1
    means, sums = cross_products(complete_cases(df, [y, *xs]), [y, *xs], by)

    def solve(fact: dict, total: np.ndarray) -> list[tuple]:
        cross, mu = total.reshape(p, p), np.array(fact["mu"])
        slope = np.linalg.lstsq(cross[1:, 1:], cross[1:, 0], rcond=None)[0]
        return [(fact["tag"], [float(mu[0] - mu[1:] @ slope), *slope.tolist()])]

    fits = solved(sums, means.select("tag", "mu"), p * p, solve, "tag string, beta array<double>")
    return cut(means.select(*by, "tag", "n").join(fits, "tag"), "fits")


def coefficients(fits: DataFrame, xs: list[str], by: list[str] = ()) -> DataFrame:
    """(group columns, term, coef) of ``least_squares``."""
    terms = F.array(*[F.lit(t) for t in ["intercept", *xs]])
    return fits.select(*by, F.explode(F.arrays_zip(terms.alias("term"), F.col("beta").alias("coef"))).alias("t")).select(*by, "t.term", "t.coef")


def residual(df: DataFrame, y: str, xs: list[str], name: str, by: list[str] = ()) -> DataFrame:
    """Actual minus predicted as a new column, each group fitted on its own; incomplete rows get NULL."""
    by = list(by)
    fits = least_squares(df, y, xs, by).select(F.col("tag").alias("_tag"), F.col("beta").alias("_beta"))
    fit = F.get("_beta", F.lit(0))
    for i, x in enumerate(xs):
        fit = fit + F.col(x) * F.get("_beta", F.lit(i + 1))
    joined = df.withColumn("_tag", tag_of(by)).join(fits, "_tag", "left")
    return joined.withColumn(name, F.col(y) - fit).drop("_tag", "_beta")


def vif(df: DataFrame, xs: list[str], by: list[str] = ()) -> DataFrame:
    """(group columns, feature, vif) with the intercept included.

    A feature that the others determine is infinite and leaves unrelated ones alone; a feature that does not vary has none.
    """
    by, p = list(by), len(xs)
    means, sums = cross_products(complete_cases(df, xs), xs, by)

    def solve(fact: dict, total: np.ndarray) -> list[tuple]:
        cross, mu, n = total.reshape(p, p), np.array(fact["mu"]), fact["n"]
        scale = np.sqrt(np.diag(cross))
        varies = np.flatnonzero(scale > RANK * (1 + np.abs(mu)) * np.sqrt(n))
        corr = cross[np.ix_(varies, varies)] / np.outer(scale[varies], scale[varies])
        fixed = np.setdiff1d(np.arange(p), varies)
        if np.any(mu[fixed] != 0):
            intercept = float("inf")
        else:  # the regression for the intercept has no constant, so raw moments count
            m = mu[varies] / scale[varies]
            intercept = float(1.0 + n * (m @ np.linalg.pinv(corr, hermitian=True) @ m))
        factors = {}
        for i, at in enumerate(varies):
            rest, r2 = np.delete(np.arange(len(varies)), i), 0.0
            if len(rest):
                c = corr[rest, i]
                r2 = float(c @ np.linalg.lstsq(corr[np.ix_(rest, rest)], c, rcond=1e-10)[0])
            factors[at] = 1.0 / (1.0 - r2) if r2 < 1 - 1e-10 else float("inf")
        return [(fact["tag"], "intercept", intercept), *[(fact["tag"], x, factors.get(i)) for i, x in enumerate(xs)]]

    told = solved(sums, means.select("tag", "mu", "n"), p * p, solve, "tag string, feature string, vif double")
    return means.select(*by, "tag").join(told, "tag").drop("tag")


# --- logit -------------------------------------------------------------------------------------

def logit_sums(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Score, Hessian, log likelihood and the largest residual's complement, of rows whose last column is the label."""
    y, x = x[:, -1], np.hstack((x[:, :-1], np.ones((len(x), 1))))
    eta = x @ beta
    p = 1.0 / (1.0 + np.exp(-eta))
    score, curve = x.T @ (y - p), (x * (p * (1 - p))[:, None]).T @ x
    return np.concatenate((score, curve.ravel(), [-np.logaddexp(0, np.where(y == 1, -eta, eta)).sum(), (np.abs(y - p) > 1e-4).sum(), y.sum()]))


def logit_inference(df: DataFrame, y: str, xs: list[str], by: list[str] = ()) -> DataFrame:
    """(group columns, term, coef, std_err, z, p, status) of a maximum-likelihood logit of each group over its complete rows.

    Columns that do not vary in a group are left out of its fit. A fit that fails is one row with its status: one class
    only, a singular design, separated classes, or no convergence.
    """
    by, k = list(by), len(xs) + 1
    data = complete_cases(df, [y, *xs])
    means = group_means(data, xs, by)
    x = [F.when(F.get("sd", F.lit(i)) > 0, (F.col(c).cast("double") - F.get("mu", F.lit(i))) / F.get("sd", F.lit(i))).otherwise(0.0) for i, c in enumerate(xs)]
    rows = data.withColumn("tag", tag_of(by)).join(means.select("tag", "mu", "sd"), "tag").select("tag", F.array(*x, F.col(y).cast("double")).alias("x"))
    rows = cut(rows, "logit")
    state = cut(means.withColumns({"b": F.array(*[F.lit(0.0)] * k), "last": F.array(*[F.lit(0.0)] * k), "ll": F.lit(float("-inf"))}), "logit")
    names, ended = ["tag", "term", "coef", "std_err", "z", "p", "status"], None

    def step(fact: dict, total: np.ndarray) -> list[tuple]:
        """The next coefficients, or the end: (tag, b, last, ll, terms...)."""
        tag, b, n = fact["tag"], np.array(fact["b"]), fact["n"]
        varies = np.append(np.array(fact["sd"]) > RANK * (1 + np.abs(np.array(fact["mu"]))), True)
        score, curve = total[:k][varies], total[k : k + k * k].reshape(k, k)[np.ix_(varies, varies)]
        ll, far, ones = total[-3:]
        fail = lambda why: [(tag, None, None, None, None, None, None, None, f"failed: {why}")]
        if ones in (0, n):
            return fail("one class")
        if far == 0:
            return fail("separation")
        if ll < fact["ll"] - 1e-9 * abs(ll):  # too far: half the way
            return [(tag, [*((b + np.array(fact["last"])) / 2)], fact["last"], fact["ll"], *[None] * 5)]
        values, vectors = np.linalg.eigh(curve)
        if values[0] <= RANK * values[-1]:
            return fail("singular design" if not fact["started"] else "separation")
        inverse = (vectors / values) @ vectors.T
        if np.abs(score).max() > FLAT * n:
            new = b.copy()
            new[varies] += inverse @ score
            return [(tag, new.tolist(), b.tolist(), float(ll), *[None] * 5)]
        # back to the columns as they are
        mu, sd = np.array(fact["mu"])[varies[:-1]], np.array(fact["sd"])[varies[:-1]]
        back = np.diag(np.append(1 / sd, 1.0))
        back[-1, :-1] = -mu / sd
        beta, errors = back @ b[varies], np.sqrt(np.diag(back @ inverse @ back.T))
        terms = [t for t, v in zip([*xs, "intercept"], varies) if v]
        return [(tag, None, None, None, t, float(c), float(e), float(c / e), "converged") for t, c, e in zip(terms, beta, errors)]

    for i in range(STEPS):
        facts = state.withColumn("started", F.lit(i > 0))
        sums = group_sums(rows.join(state.select("tag", "b"), "tag"), logit_sums)
        now = cut(solved(sums, facts.select("tag", "n", "mu", "sd", "b", "last", "ll", "started"), k * k + k + 3, step,
                         "tag string, b array<double>, last array<double>, ll double, term string, coef double, std_err double, z double, status string"), "logit")
        done = now.where("status IS NOT NULL").select("tag", "term", "coef", "std_err", "z", "status")
        ended = done if ended is None else ended.unionByName(done)
        state = cut(means.join(now.where("status IS NULL").select("tag", "b", "last", "ll"), "tag"), "logit")
        if state.isEmpty():
            break
    none = lambda kind: F.lit(None).cast(kind)
    late = state.select("tag", none("string").alias("term"), *[none("double").alias(c) for c in ("coef", "std_err", "z")], F.lit("failed: not converged").alias("status"))

    @F.arrow_udf("double")
    def two_sided(z: pa.Array) -> pa.Array:
        return pa.array([None if v is None else math.erfc(abs(v) / math.sqrt(2)) for v in z.to_pylist()], pa.float64())

    told = ended.unionByName(late).withColumn("p", two_sided("z"))
    return means.select(*by, "tag").join(told, "tag").select(*by, *names[1:])
