"""Elastic-net logits of many candidates, folds and groups at once, and their search by halving over rows.

The coefficients of all fits of a group are one matrix. A pass over the rows gives every fit's gradient, Hessian and loss:
tasks multiply blocks of rows with the matrix and add up, and Spark sums over tasks. The driver, which holds the
coefficients and nothing else, takes a Newton step under the penalty for all fits together (the quadratic model's system is
solved where no absolute values count, and descended by coordinates elsewhere), so that a handful of passes serves any
number of candidates. Fits of many columns are dealt to passes of bounded size.

A fit minimises C sum_i w_i log-loss_i + l1_ratio |b|_1 + (1 - l1_ratio) |b|^2 / 2 with balanced class weights w and an
intercept that is not penalised, in the columns as they are; inside, columns are centred and scaled.
"""

from __future__ import annotations

import contextlib
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .search import exhausting_minimum, rungs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NUMBERS = 2 << 20  # sums of one pass and group
SWEEPS, STEPS = 200, 100
FLAT = 1e-9  # step of the scaled coefficients below which a fit has converged; the search, which only ranks, uses 1e-4
ONE, NO_FOLD = "_one", -1


@dataclass(frozen=True)
class Fit:
    """One fit: its candidate, and the fold it leaves out (NO_FOLD: none)."""

    candidate: int
    fold: int
    c: float
    l1_ratio: float


@dataclass
class Fitted:
    """The fits of a group: a column of ``beta`` each, the intercept last, for the columns as they are, and how many rows it saw."""

    fits: list[Fit]
    beta: np.ndarray
    converged: np.ndarray
    rows: np.ndarray


def block_sums(x: np.ndarray, y: np.ndarray, fold: np.ndarray, b: np.ndarray, fits: list[Fit], weights: dict) -> np.ndarray:
    """Per fit: loss, gradient and Hessian of the weighted log loss over the rows of its folds."""
    x = np.hstack((x, np.ones((len(x), 1))))
    margin = x @ b
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.empty_like(p)
    for f in {f.fold for f in fits}:
        at = [i for i, one in enumerate(fits) if one.fold == f]
        w[:, at] = (np.where(y == 1, weights[f][1], weights[f][0]) * (fold != f))[:, None]
    loss = (w * np.logaddexp(0, np.where(y[:, None] == 1, -margin, margin))).sum(0)
    gradient = (w * (p - y[:, None])).T @ x
    q = w * p * (1 - p)
    if len(fits) <= x.shape[1]:  # a product for each fit is cheaper than all products of columns
        hessian = np.stack([(x * q[:, i, None]).T @ x for i in range(len(fits))]).reshape(len(fits), -1)
    else:
        hessian = q.T @ (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    return np.hstack((loss[:, None], gradient, hessian))


def newton(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, l1: np.ndarray, l2: np.ndarray, flat: float, solve: bool = True) -> np.ndarray:
    """The minimisers of the quadratic models at ``b`` (fits x columns) plus penalties.

    Without ``l1`` it is one linear system a fit, if they may ``solve`` it. Descent would need sweeps in proportion to rows
    where columns are nearly collinear, as only the penalty tells those apart.
    """
    new = b.copy()
    smooth = ~l1.any(1) & solve
    if smooth.any():
        new[smooth] = b[smooth] + ridge_steps(b[smooth], gradient[smooth], hessian[smooth], l2[smooth])
    rest = ~smooth | ~np.isfinite(new).all(1)
    if rest.any():
        new[rest] = descent(b[rest], gradient[rest], hessian[rest], l1[rest], l2[rest], flat)
    return new


def ridge_steps(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The steps of fits without ``l1``; NaN for one whose system is singular."""
    out = np.full(b.shape, np.nan)
    for i in range(len(b)):
        system = hessian[i] + np.diag(l2[i])
        at = np.flatnonzero(system.diagonal() <= 0)  # columns that do not vary
        system[at, at] = 1.0
        with contextlib.suppress(np.linalg.LinAlgError):
            out[i] = -np.linalg.solve(system, gradient[i] + l2[i] * b[i])
    return out


def descent(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, l1: np.ndarray, l2: np.ndarray, flat: float) -> np.ndarray:
    """The same minimisers by coordinate descent, one coordinate of all fits at a time."""
    new, p = b.copy(), b.shape[1]
    slope = gradient.copy()  # of the quadratic model at ``new``
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(p):
            curve = hessian[:, j, j] + l2[:, j]
            curve = np.where(curve > 0, curve, 1.0)
            raw = new[:, j] * hessian[:, j, j] - slope[:, j]
            to = np.sign(raw) * np.maximum(np.abs(raw) - l1[:, j], 0) / curve
            step = to - new[:, j]
            slope += hessian[:, :, j] * step[:, None]
            new[:, j] = to
            moved = max(moved, float(np.abs(step).max()))
        if moved < flat / 10:
            break
    return new


def elastic_logits(df: DataFrame, label: str, fits: dict[str, list[Fit]], by: str | None = None, fold: str | None = None, vector: str = "features",
                   flat: float = FLAT, steps: int = STEPS, solve: bool = True) -> dict[str, Fitted]:
    """The ``fits`` of each group of ``by`` over the rows of ``df``, to steps of ``flat`` of the scaled coefficients, or ``steps`` of them.

    ``solve``: steps without absolute penalties are solved as linear systems; otherwise all are descended.
    """
    group = F.col(by).cast("string") if by else F.lit(ONE)
    folds = F.col(fold).cast("int") if fold else F.lit(NO_FOLD - 1)
    rows = df.select(group.alias("grp"), vector_to_array(vector).alias("x"), F.col(label).cast("double").alias("y"), folds.alias("fold")).where(F.col("grp").isin(list(fits)))
    # every step reads what is dealt here: as many even tasks as there are cores, at least
    rows = cut(rows.repartition(max(df.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())), "rows")
    width = (rows.agg(F.max(F.size("x"))).first()[0]) or 0
    stats = rows.groupBy("grp").agg(*[f(F.get("x", F.lit(i))).alias(f"{t}{i}") for i in range(width) for t, f in (("m", F.avg), ("s", F.stddev_pop))])
    centre = {r["grp"]: (np.array([r[f"m{i}"] for i in range(width)], float), np.array([r[f"s{i}"] or 0.0 for i in range(width)], float)) for r in stats.collect()}
    counts: dict[str, dict[int, np.ndarray]] = {}
    for r in rows.groupBy("grp", "fold").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")).collect():
        counts.setdefault(r["grp"], {})[r["fold"]] = np.array([r["n0"], r["n1"]], float)

    sc, state = df.sparkSession.sparkContext, {}
    for g in sorted(set(fits) & set(centre)):
        mine, (mu, sd) = fits[g], centre[g]
        weights, seen = {}, {}
        for f in {one.fold for one in mine}:
            n = sum((v for k, v in counts[g].items() if k != f), np.zeros(2))
            seen[f] = n.sum()
            weights[f] = tuple(n.sum() / (2 * n)) if n.all() else (1.0, 1.0)  # balanced
        scale = np.where(sd > 0, 1 / np.where(sd > 0, sd, 1), 0.0)
        share = np.array([1 / one.c for one in mine])[:, None]
        ratio = np.array([one.l1_ratio for one in mine])[:, None]
        pad = lambda v: np.hstack((v, np.zeros((len(mine), 1))))
        state[g] = {"b": np.zeros((len(mine), width + 1)), "last": None, "loss": np.full(len(mine), np.inf), "open": np.ones(len(mine), bool), "weights": weights, "mu": mu,
                    "scale": scale, "l1": pad(share * ratio * scale), "l2": pad(share * (1 - ratio) * scale**2), "fits": mine,
                    "rows": np.array([seen[one.fold] for one in mine], int)}
        state[g]["last"] = state[g]["b"].copy()
    per_fit = 1 + (width + 1) + (width + 1) ** 2
    each = max(1, NUMBERS // per_fit)

    taken = {g: np.zeros(len(s["fits"]), int) for g, s in state.items()}
    while True:
        turn = {g: np.flatnonzero(s["open"] & (taken[g] < steps))[:each] for g, s in state.items()}
        turn = {g: at for g, at in turn.items() if len(at)}
        if not turn:
            break
        for g, at in turn.items():
            taken[g][at] += 1
        shared = sc.broadcast({g: {**{k: state[g][k] for k in ("weights", "mu", "scale")}, "b": state[g]["b"][at].T, "fits": [state[g]["fits"][i] for i in at]} for g, at in turn.items()})

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held: dict[str, np.ndarray] = {}
            for batch in batches:
                coded = batch.column("grp").dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                for i, g in enumerate(coded.dictionary.to_pylist()):
                    if g not in shared.value:
                        continue
                    plan, at = shared.value[g], np.flatnonzero(codes == i)
                    some = batch.column("x").take(pa.array(at))
                    x = (some.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), -1) - plan["mu"]) * plan["scale"]
                    y, fold_ = batch.column("y").to_numpy()[at], batch.column("fold").to_numpy()[at]
                    for j in range(0, len(at), 2048):
                        mine = block_sums(x[j : j + 2048], y[j : j + 2048], fold_[j : j + 2048], plan["b"], plan["fits"], plan["weights"])
                        held[g] = held[g] + mine if g in held else mine
            for g, total in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([total.tobytes()], pa.binary())], ["grp", "sums"])

        def total(t: pa.Table) -> pa.Table:
            parts = [np.frombuffer(v, np.float64) for v in t.column("sums").to_pylist()]
            return pa.table({"grp": t.column("grp")[:1], "sums": pa.array([np.sum(parts, 0).tobytes()], pa.binary())})

        chosen = rows.where(F.col("grp").isin(list(turn)))
        for r in chosen.mapInArrow(add, "grp string, sums binary").groupBy("grp").applyInArrow(total, "grp string, sums binary").collect():
            s, at = state[r["grp"]], turn[r["grp"]]
            sums = np.frombuffer(r["sums"], np.float64).reshape(len(at), per_fit)
            b, l1, l2 = s["b"][at], s["l1"][at], s["l2"][at]
            loss = sums[:, 0] + (l1 * np.abs(b)).sum(1) + (l2 * b * b).sum(1) / 2
            worse = loss > s["loss"][at] + 1e-10 * np.abs(loss)
            new = newton(b, sums[:, 1 : width + 2], sums[:, width + 2 :].reshape(len(at), width + 1, width + 1), l1, l2, flat, solve)
            new[worse] = (b[worse] + s["last"][at][worse]) / 2  # too far: half the way
            ended = ~worse & (np.abs(new - b).max(1) < flat * (1 + np.abs(b).max(1)))
            s["last"][at[~worse]], s["loss"][at[~worse]] = b[~worse], loss[~worse]
            s["b"][at] = new
            s["open"][at[ended]] = False
        shared.unpersist()
    out = {}
    for g, s in state.items():
        slope = s["b"][:, :-1] * s["scale"]
        out[g] = Fitted(s["fits"], np.vstack((slope.T, s["b"][:, -1] - slope @ s["mu"])), ~s["open"], s["rows"])
    return out


def right_answers(df: DataFrame, label: str, fitted: dict[str, Fitted], by: str | None, fold: str, vector: str = "features") -> DataFrame:
    """(grp, place of the fit, right, n): how many rows of the fold that a fit leaves out it puts into their class."""
    shared = df.sparkSession.sparkContext.broadcast(fitted)
    group = F.col(by).cast("string") if by else F.lit(ONE)
    rows = df.select(group.alias("grp"), vector_to_array(vector).alias("x"), F.col(label).cast("int").alias("y"), F.col(fold).cast("int").alias("fold"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column("grp").dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            for i, g in enumerate(coded.dictionary.to_pylist()):
                if g not in shared.value:
                    continue
                model, at = shared.value[g], np.flatnonzero(codes == i)
                x = batch.column("x").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), -1)
                y, of = batch.column("y").to_numpy()[at], batch.column("fold").to_numpy()[at]
                mine = held.setdefault(g, np.zeros((2, len(model.fits)), np.int64))
                for f in np.unique(of).tolist():
                    some = [k for k, one in enumerate(model.fits) if one.fold == f]
                    rows_ = of == f
                    said = (x[rows_] @ model.beta[:-1, some] + model.beta[-1, some]) > 0
                    mine[0, some] += (said == (y[rows_] == 1)[:, None]).sum(0)
                    mine[1, some] += int(rows_.sum())
        for g, total in held.items():
            n = total.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array([g] * n), pa.array(np.arange(n)), pa.array(total[0]), pa.array(total[1])], ["grp", "place", "right", "n"])

    return rows.mapInArrow(count, "grp string, place long, right long, n long").groupBy("grp", "place").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))


def logit_search(df: DataFrame, label: str, key: str, fold: str, folds: int, candidates: list[dict], by: str | None = None, factor: int = 3,
                 min_resources: int | None = None, vector: str = "features", flat: float = 1e-4, steps: int = 12) -> tuple[dict[str, dict], list[tuple]]:
    """(best candidate of each group, log): halving over ``candidates`` (c, l1_ratio), rows as the resource.

    A rung fits every candidate left of every group on the folds' other rows, all in the same passes, and keeps the best
    by mean accuracy on the folds, ties to the earlier one. The log has (grp, rung, candidate, rows, mean accuracy).
    The rows of a rung are those of the smallest hashes of ``key``, and part of the next rung's. A fit of the search takes
    ``steps`` Newton steps at most: candidates are only ranked, and strong ones on few rows may never settle. All of them are
    descended by coordinates, so that none is nearer to its minimum than its rivals by the way it was reached.
    """
    group = F.col(by).cast("string") if by else F.lit(ONE)
    place = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30))
    rows = cut(df.select(group.alias("_grp"), place.alias("_place"), F.col(fold).alias("_fold"), label, vector), "search")
    sizes = {r["_grp"]: r["n"] for r in rows.groupBy("_grp").agg(F.count("*").alias("n")).collect()}
    alive = {g: list(range(len(candidates))) for g in sizes}
    least = {g: min_resources or min(n, exhausting_minimum(len(candidates), n, factor, folds)) for g, n in sizes.items()}
    plan = {g: rungs(len(candidates), least[g], n, factor, aggressive=False) for g, n in sizes.items()}
    log: list[tuple] = []
    for rung in range(max((len(p) for p in plan.values()), default=0)):
        now = {g: p[rung][1] for g, p in plan.items() if rung < len(p)}
        limit = F.lit(0)
        for g, resources in now.items():
            limit = F.when(F.col("_grp") == g, int((1 << 30) * min(1.0, resources / sizes[g]))).otherwise(limit)
        part = rows.where(F.col("_place") < limit)
        fits = {g: [Fit(c, k, candidates[c]["c"], candidates[c]["l1_ratio"]) for c in alive[g] for k in range(folds)] for g in now}
        fitted = elastic_logits(part, label, fits, "_grp", "_fold", vector, flat, steps, solve=False)
        scores: dict[str, dict[int, list[float]]] = {g: {} for g in now}
        for r in right_answers(part, label, fitted, "_grp", "_fold", vector).collect():
            if r["n"]:
                scores[r["grp"]].setdefault(fitted[r["grp"]].fits[r["place"]].candidate, []).append(r["right"] / r["n"])
        for g in now:
            mean = {c: math.fsum(scores[g].get(c, [])) / max(1, len(scores[g].get(c, []))) for c in alive[g]}
            log += [(g, rung, c, now[g], mean[c]) for c in alive[g]]
            alive[g] = sorted(alive[g], key=lambda c: (-mean[c], c))[: math.ceil(len(alive[g]) / factor)]
    return {g: candidates[some[0]] for g, some in alive.items()}, log
