"""Feature contributions: exact additive ones for linear scores, interventional ones for tree ensembles.

A leaf gives its weight to a row and a background row together if each of its conditions is met by one of them at
least. So of a background row a leaf only needs the pattern of conditions that it meets, and what a row earns from a leaf
is a sum over the patterns that occur, each with its share of the background. Spark counts the patterns of all leaves
over the whole background and deals them, in order of leaves, to parts of bounded size, however many patterns a leaf or
a model has; blocks of rows meet every part, and the partial contributions of a row are added up by its id. One way for
trees of every depth; the driver holds the model and two means.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..models.boosting import BoostedForest
from ..operators.relational import row_ordinal
from ..session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART = 200_000  # background patterns to a part
ROWS = 1024  # explained rows to a block
LEAVES, SEEN = 2048, 512  # leaves and background rows whose patterns are taken at once
HELD = 1_000_000  # patterns that a task holds before it passes them on


def linear_contributions(columns: list[str], coefficients: dict[str, float], means: dict[str, float], flip: bool = False) -> Column:
    """coefficient x (value - mean) for each column as an array of (feature, value).

    ``flip`` states them for class 0, where positive pushes towards leaving.
    """
    sign = -1.0 if flip else 1.0
    return F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 (F.lit(sign * float(coefficients[c])) * (F.col(c).cast("double") - F.lit(float(means[c])))).alias("value"))
        for c in columns
    ])


@dataclass
class Leaves:
    """Every leaf of an ensemble as a box: per path column an open-closed interval, padded to one width."""

    value: np.ndarray    # weight on the log-odds scale
    feature: np.ndarray  # leaves x slots, 0 where padded
    low: np.ndarray
    high: np.ndarray
    slots: np.ndarray    # path columns per leaf

    @classmethod
    def of(cls, model: BoostedForest) -> "Leaves":
        rows = []
        for r in model.rounds:
            share = model.step / len(r.value)
            for t in range(len(r.value)):
                stack: list[tuple[int, dict]] = [(0, {})]
                while stack:
                    at, box = stack.pop()
                    f = int(r.feature[t][at])
                    if f < 0:
                        rows.append((share * r.value[t][at], box))
                        continue
                    cutoff = float(r.split[t][at])
                    lo, hi = box.get(f, (-math.inf, math.inf))
                    stack.append((int(r.left[t][at]), {**box, f: (lo, min(hi, cutoff))}))
                    stack.append((int(r.right[t][at]), {**box, f: (max(lo, cutoff), hi)}))
        width = max([len(b) for _, b in rows] + [1])
        if width > 62:
            raise ValueError("a path has more than 62 columns")
        out = cls(np.array([v for v, _ in rows]), np.zeros((len(rows), width), int), np.full((len(rows), width), -np.inf),
                  np.full((len(rows), width), np.inf), np.array([len(b) for _, b in rows], int))
        for i, (_, box) in enumerate(rows):
            for s, (f, (lo, hi)) in enumerate(sorted(box.items())):
                out.feature[i, s], out.low[i, s], out.high[i, s] = f, lo, hi
        return out

    def patterns(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """rows x chosen leaves: a bit per slot that the row satisfies."""
        out = np.zeros((len(x), len(which)), dtype=np.int64)
        for s in range(self.feature.shape[1]):
            v = x[:, self.feature[which, s]]
            met = (v > self.low[which, s]) & (v <= self.high[which, s]) & (self.slots[which] > s)
            out |= met.astype(np.int64) << s
        return out


def matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def background_patterns(seen: DataFrame, leaves) -> DataFrame:
    """(leaf, code, n): how many rows of ``seen`` (x) have the pattern ``code`` at a leaf."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = leaves.value
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["leaf", "code", "n"])

        for b in batches:
            x = matrix(b.column(0))
            for i in range(0, len(x), SEEN):
                for j in range(0, len(box.value), LEAVES):
                    which = np.arange(j, min(j + LEAVES, len(box.value)))
                    codes = box.patterns(x[i : i + SEEN], which).T
                    codes = np.sort(codes, 1)
                    new = np.ones(codes.shape, bool)
                    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
                    at = np.flatnonzero(new)
                    held.append((which[at // codes.shape[1]], codes.ravel()[at], np.diff(np.append(at, codes.size))))
                    if sum(len(h[0]) for h in held) > HELD:
                        yield emit()
                        held = []
        if held:
            yield emit()

    return seen.mapInArrow(count, "leaf long, code long, n long").groupBy("leaf", "code").agg(F.sum("n").alias("n"))


def shares(slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of a leaf's weight by (u, v): earned by each of u slots only the row satisfies, lost by each
    of v slots only the background satisfies: (u-1)! v! / (u+v)! and u! (v-1)! / (u+v)!."""
    f = [math.factorial(i) for i in range(2 * slots + 1)]
    gain, loss = np.zeros((slots + 1, slots + 1)), np.zeros((slots + 1, slots + 1))
    for u in range(slots + 1):
        for v in range(slots + 1):
            if u:
                gain[u, v] = f[u - 1] * f[v] / f[u + v]
            if v:
                loss[u, v] = f[u] * f[v - 1] / f[u + v]
    return gain, loss


def leaf_effects(rows: np.ndarray, back: np.ndarray, weight: np.ndarray, slots: int) -> np.ndarray:
    """rows x slots: what each slot earns a row against background patterns of these weights."""
    gain, loss = shares(slots)
    full = (1 << slots) - 1
    codes, inverse = np.unique(rows, return_inverse=True)
    out = np.zeros((len(codes), slots))
    bits = np.arange(slots)
    step = max(1, 2_000_000 // (len(back) * max(1, slots)))
    for i in range(0, len(codes), step):
        some = codes[i : i + step, None]
        mine, theirs = some & ~back, back & ~some
        u, v = np.bitwise_count(mine), np.bitwise_count(theirs)
        both = np.where((some | back) == full, weight, 0.0)
        up, down = both * gain[u, v], both * loss[u, v]
        out[i : i + step] = (up[..., None] * (mine[..., None] >> bits & 1) - down[..., None] * (theirs[..., None] >> bits & 1)).sum(1)
    return out[inverse]


def tree_contributions(rows: DataFrame, key: list[str], background: DataFrame, model: BoostedForest, names: list[str],
                       flip: bool = True, vector: str = "features") -> DataFrame:
    """(key, contributions, prob, base): interventional contributions to the probability, against the whole background.

    Log-odds contributions are brought to the probability scale by the row's own ratio, so contributions plus ``base``
    equal the probability. ``flip`` states everything for class 0, where positive pushes towards leaving.
    """
    spark, width = rows.sparkSession, len(names)
    box = Leaves.of(model)
    leaves, shared = spark.sparkContext.broadcast(box), spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def margin(x: pa.Array) -> pa.Array:
        return pa.array(shared.value.margin(matrix(x)))

    logistic = lambda m: 1.0 / (1.0 + F.exp(-m))
    seen = background.select(vector_to_array(vector).alias("x"))
    mean = seen.select(margin("x").alias("m")).agg(F.avg("m").alias("m"), F.avg(logistic(F.col("m"))).alias("p"), F.count("*").alias("n")).first()
    if not mean["n"]:
        raise ValueError("the background has no rows")
    placed = row_ordinal(background_patterns(seen, leaves), ["leaf", "code"])
    parts = cut(placed.select(F.floor(F.col("ordinal") / PART).cast("long").alias("part"), "leaf", "code", "n"), "patterns")
    count = (parts.agg(F.max("part")).first()[0] or 0) + 1

    asked = cut(rows.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], vector_to_array(vector).alias("x"), F.monotonically_increasing_id().alias("row")), "asked")
    block = F.expr(f"shiftright(row, 33) * 8388608 + (row & 8589934591) div {ROWS}")  # places in one part of the rows lie together
    blocks = asked.select(block.alias("block"), "row", "x")
    none = F.lit(None).cast
    cells = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>"))).select(
        "part", "block", "row", "x", none("long").alias("leaf"), none("long").alias("code"), none("long").alias("n"))
    pairs = blocks.select("block").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>")))
    every = parts.join(pairs, "part")
    cells = cells.unionByName(every.select("part", "block", none("long").alias("row"), none("array<double>").alias("x"), "leaf", "code", "n"))
    total = float(mean["n"])

    def explain(t: pa.Table) -> pa.Table:
        t, box = t.combine_chunks(), leaves.value
        is_row = t.column("row").is_valid()
        asked, back = t.filter(is_row).combine_chunks(), t.filter(pc.invert(is_row)).combine_chunks()
        out = np.zeros((len(asked), width))
        if len(asked) and len(back):
            x = matrix(asked.column("x").chunk(0))
            leaf, code, n = (back.column(c).to_numpy() for c in ("leaf", "code", "n"))
            order = np.argsort(leaf, kind="stable")
            leaf, code, n = leaf[order], code[order], n[order]
            begin = np.flatnonzero(np.concatenate(([True], leaf[1:] != leaf[:-1])))
            for a, z in zip(begin.tolist(), [*begin[1:].tolist(), len(leaf)]):
                one = int(leaf[a])
                slots = int(box.slots[one])
                if slots:
                    mine = box.patterns(x, np.array([one]))[:, 0]
                    effect = leaf_effects(mine, code[a:z], box.value[one] * n[a:z] / total, slots)
                    out[:, box.feature[one, :slots]] += effect
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, width, dtype=np.int32)), pa.array(out.ravel()))
        return pa.table([asked.column("row"), lists], ["row", "phi"])

    phis = cells.groupBy("part", "block").applyInArrow(explain, "row long, phi array<double>")
    summed = phis.groupBy("row").agg(*[F.sum(F.get("phi", F.lit(i))).alias(f"p{i}") for i in range(width)])
    told = asked.join(summed, "row").withColumn("m", margin("x")).withColumn("prob", logistic(F.col("m")))
    gap = F.col("m") - mean["m"]
    scale = F.when(F.abs(gap) > 1e-12, (F.col("prob") - mean["p"]) / gap).otherwise(0.0) * (-1.0 if flip else 1.0)
    values = F.array(*[F.struct(F.lit(n).alias("feature"), (F.col(f"p{i}") * scale).alias("value")) for i, n in enumerate(names)])
    return told.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(key)], values.alias("contributions"), "prob",
                       F.lit(float(1.0 - mean["p"] if flip else mean["p"])).alias("base"))
