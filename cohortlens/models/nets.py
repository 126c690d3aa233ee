"""A ReLU network with L2, fitted by distributed back-propagation for many groups at once.

An epoch is one job. Every task starts from the epoch's weights, takes steps of gradient descent with Nesterov momentum
over minibatches of its own rows, and hands on weights and momentum, which Spark averages over the tasks by their rows.
With one task this is plain minibatch descent. Columns are centred and scaled first. Fitting ends when ``patience``
epochs lower the loss by no more than ``tol``; the weights of the epoch with the lowest loss stay.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ONE = "_one"
HIDDEN = (75, 50, 25)


def shapes(width: int, hidden: tuple[int, ...]) -> list[tuple[int, int]]:
    sizes = [width, *hidden, 1]
    return [(a + 1, b) for a, b in zip(sizes, sizes[1:])]  # the last row is the level


def layers(flat: np.ndarray, sizes: list[tuple[int, int]]) -> list[np.ndarray]:
    ends = np.cumsum([0] + [a * b for a, b in sizes])
    return [flat[i:j].reshape(s) for i, j, s in zip(ends, ends[1:], sizes)]


def start(sizes: list[tuple[int, int]], seed: int) -> np.ndarray:
    """Uniform weights by the number of a layer's inputs and outputs."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.uniform(-1, 1, a * b) * np.sqrt(6 / (a - 1 + b)) for a, b in sizes])


def forward(x: np.ndarray, net: list[np.ndarray]) -> list[np.ndarray]:
    """The values of every layer, the margin last."""
    values = [x]
    for i, w in enumerate(net):
        z = values[-1] @ w[:-1] + w[-1]
        values.append(np.maximum(z, 0) if i + 1 < len(net) else z)
    return values


def loss_and_gradient(flat: np.ndarray, sizes: list[tuple[int, int]], x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Mean weighted log loss plus l2 |W|^2 / 2n (levels apart), and its gradient."""
    net = layers(flat, sizes)
    values, n = forward(x, net), len(x)
    margin = values[-1][:, 0]
    loss = float((w * np.logaddexp(0, np.where(y == 1, -margin, margin))).sum() / n + l2 / (2 * n) * sum((v[:-1] ** 2).sum() for v in net))
    delta = (w * (1 / (1 + np.exp(-margin)) - y))[:, None] / n
    out = []
    for i in range(len(net) - 1, -1, -1):
        slope = values[i].T @ delta + l2 / n * net[i][:-1]
        out.append(np.concatenate((slope.ravel(), delta.sum(0))))
        if i:
            delta = (delta @ net[i][:-1].T) * (values[i] > 0)
    return loss, np.concatenate(out[::-1])


@dataclass
class Net:
    """Weights for columns that are centred and scaled, and the loss of every epoch."""

    flat: np.ndarray
    sizes: list[tuple[int, int]]
    mu: np.ndarray
    scale: np.ndarray
    losses: list[float]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return forward((x - self.mu) * self.scale, layers(self.flat, self.sizes))[-1][:, 0]


def fit_nets(df: DataFrame, label: str, by: str | None = None, hidden: tuple[int, ...] = HIDDEN, l2: float = 2.5, rate: float = 0.001, momentum: float = 0.9, batch: int = 200,
             epochs: int = 5000, patience: int = 25, tol: float = 1e-4, balanced: bool = False, seed: int = 7, vector: str = "features") -> dict[str, Net]:
    """A network for each group of ``by``; ``balanced`` weighs the classes alike."""
    group = F.col(by).cast("string") if by else F.lit(ONE)
    rows = df.select(group.alias("grp"), vector_to_array(vector).alias("x"), F.col(label).cast("double").alias("y")).where("grp IS NOT NULL")
    # every epoch reads these rows in this order; each task must see rows of all kinds
    rows = cut(rows.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism // 2), F.xxhash64("x", "y")), "net")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    facts = rows.groupBy("grp").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"),
                                    *[f(F.get("x", F.lit(i))).alias(f"{t}{i}") for i in range(width) for t, f in (("m", F.avg), ("s", F.stddev_pop))]).collect()
    sizes, state, sc = shapes(width, hidden), {}, df.sparkSession.sparkContext
    for r in facts:
        sd = np.array([r[f"s{i}"] or 0.0 for i in range(width)], float)
        n = np.array([r["n0"], r["n1"]], float)
        flat = start(sizes, seed)
        state[r["grp"]] = {"flat": flat, "push": np.zeros_like(flat), "mu": np.array([r[f"m{i}"] for i in range(width)], float), "scale": np.where(sd > 0, 1 / np.where(sd > 0, sd, 1), 0.0),
                           "weights": tuple(n.sum() / (2 * n)) if balanced and n.all() else (1.0, 1.0), "best": flat, "losses": [], "stale": 0}
    open_ = set(state)
    for epoch in range(epochs):
        if not open_:
            break
        shared = sc.broadcast({g: {k: state[g][k] for k in ("flat", "push", "mu", "scale", "weights")} for g in open_})

        def descend(batches: Iterator[pa.RecordBatch], shared=shared, epoch=epoch) -> Iterator[pa.RecordBatch]:
            held: dict[str, list] = {}
            rng = np.random.default_rng([seed, epoch, TaskContext.get().partitionId()])
            for b in batches:
                coded = b.column("grp").dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                for i, g in enumerate(coded.dictionary.to_pylist()):
                    if g not in shared.value:
                        continue
                    plan, at = shared.value[g], np.flatnonzero(codes == i)
                    x = (b.column("x").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), -1) - plan["mu"]) * plan["scale"]
                    y = b.column("y").to_numpy()[at]
                    w = np.where(y == 1, plan["weights"][1], plan["weights"][0])
                    flat, push, total, n = held.get(g) or [plan["flat"].copy(), plan["push"].copy(), 0.0, 0]
                    order = rng.permutation(len(at))
                    for j in range(0, len(at), batch):
                        some = order[j : j + batch]
                        loss, gradient = loss_and_gradient(flat, sizes, x[some], y[some], w[some], l2)
                        push = momentum * push - rate * gradient
                        flat = flat + momentum * push - rate * gradient
                        total, n = total + loss * len(some), n + len(some)
                    held[g] = [flat, push, total, n]
            for g, (flat, push, total, n) in held.items():
                sums = np.concatenate((flat * n, push * n, [total, n]))
                yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([sums.tobytes()], pa.binary())], ["grp", "sums"])

        def mean(t: pa.Table) -> pa.Table:
            total = np.sum([np.frombuffer(v, np.float64) for v in t.column("sums").to_pylist()], 0)
            return pa.table({"grp": t.column("grp")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

        done = rows.where(F.col("grp").isin(sorted(open_))).mapInArrow(descend, "grp string, sums binary").groupBy("grp").applyInArrow(mean, "grp string, sums binary").collect()
        shared.unpersist()
        for r in done:
            s, sums = state[r["grp"]], np.frombuffer(r["sums"], np.float64)
            half = len(s["flat"])
            loss = float(sums[-2] / sums[-1])
            s["stale"] = 0 if not s["losses"] or loss < min(s["losses"]) - tol else s["stale"] + 1
            if not s["losses"] or loss < min(s["losses"]):
                s["best"] = sums[:half] / sums[-1]
            s["losses"].append(loss)
            s["flat"], s["push"] = sums[:half] / sums[-1], sums[half : 2 * half] / sums[-1]
            if s["stale"] >= patience:
                open_.discard(r["grp"])
    return {g: Net(s["best"], sizes, s["mu"], s["scale"], s["losses"]) for g, s in state.items()}


def net_scores(nets: dict[str, Net], df: DataFrame, by: str | None = None, vector: str = "features", out: str = "prob") -> DataFrame:
    """``df`` with the probability by the network of each row's group, null without one."""
    shared = df.sparkSession.sparkContext.broadcast(nets)

    @F.arrow_udf("double")
    def prob(group: pa.Array, x: pa.Array) -> pa.Array:
        p, known = np.zeros(len(x)), np.zeros(len(x), bool)
        names = group.to_pylist()
        for name in set(names) & set(shared.value):
            at = np.array([i for i, n in enumerate(names) if n == name])
            wide = x.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), -1)
            p[at], known[at] = 1 / (1 + np.exp(-shared.value[name].margin(wide))), True
        return pa.array(p, mask=~known)

    return df.withColumn(out, prob(F.col(by).cast("string") if by else F.lit(ONE), vector_to_array(vector)))
