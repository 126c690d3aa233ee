"""Isotonic calibration: maps from a score to a probability, pooled slice by slice inside Spark.

Rows are first added up to a point for each distinct score. Points are dealt to slices along the score; each slice pools
neighbours that fall, and slices are then merged with their neighbours, two by two, where what they have pooled may
pool further. The result is the least-squares fit that never falls, whatever the slices.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.relational import running_index
from ..session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = 50_000  # points of a slice


def pooled(w: np.ndarray, wy: np.ndarray) -> list[tuple[int, float, float]]:
    """(points, weight, weighted sum) of the pools of points in order, no mean below the one before."""
    out: list[tuple[int, float, float]] = []
    for a, b in zip(w.tolist(), wy.tolist()):
        n = 1
        while out and out[-1][2] * a >= b * out[-1][1]:
            m, c, d = out.pop()
            n, a, b = n + m, a + c, b + d
        out.append((n, a, b))
    return out


def isotonic(points: DataFrame, by: list[str], score: str, y: str, w: str) -> DataFrame:
    """(by, lo, hi, value): the pools of each group's points (one per score, mean ``y`` and weight ``w``), in order."""
    tag = F.to_json(F.array(*[F.col(c).cast("string") for c in by])) if by else F.lit("[]")
    placed = running_index(points.select(tag.alias("tag"), F.col(score).cast("double").alias("lo"), F.col(w).cast("double").alias("w"), F.col(y).cast("double").alias("y")), ["tag"], ["lo"], "_i")
    now = placed.select("tag", F.floor((F.col("_i") - 1) / SLICE).cast("long").alias("slice"), "lo", F.col("lo").alias("hi"), "w", (F.col("w") * F.col("y")).alias("wy"))

    def pool(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("lo").to_numpy(), kind="stable")
        lo, hi, w, wy = (t.column(c).to_numpy()[order] for c in ("lo", "hi", "w", "wy"))
        pools = pooled(w, wy)
        ends = np.cumsum([p[0] for p in pools])
        same = lambda c: t.column(c).take(pa.array(np.zeros(len(pools), np.int64)))
        return pa.table({"tag": same("tag"), "slice": same("slice"), "lo": lo[ends - [p[0] for p in pools]], "hi": hi[ends - 1], "w": [p[1] for p in pools], "wy": [p[2] for p in pools]})

    while True:
        now = cut(now.groupBy("tag", "slice").applyInArrow(pool, "tag string, slice long, lo double, hi double, w double, wy double"), "pools")
        if not (now.agg(F.max("slice")).first()[0] or 0):
            break
        now = now.withColumn("slice", F.floor(F.col("slice") / 2).cast("long"))
    names = points.select(*by, tag.alias("tag")).distinct() if by else None
    out = now.select("tag", "lo", "hi", (F.col("wy") / F.col("w")).alias("value"))
    return out.drop("tag") if names is None else names.join(out, "tag").drop("tag")


def maps_of(pools: DataFrame, by: list[str]) -> DataFrame:
    """Knots (by, at, value) of the maps: both ends of each pool."""
    return pools.select(*by, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("at"), "value")


def calibrated(scores: DataFrame, score: str, pools: DataFrame, fold: str) -> DataFrame:
    """Each distinct score of ``scores`` with the mean of the folds' maps, straight between pools and flat beyond them."""
    asked = scores.select(F.col(score).cast("double").alias("s")).distinct()
    folds = pools.select(F.col(fold).alias("fold")).distinct()
    every = asked.join(F.broadcast(folds))  # as many folds as the calibration has
    return mapped(every, pools, fold).groupBy(F.col("s").alias(score)).agg(F.avg("value").alias("calibrated"))


def mapped(asked: DataFrame, pools: DataFrame, fold: str) -> DataFrame:
    """(fold, s, value): the distinct (fold, s) of ``asked`` with the values of their folds' maps, null where a fold has none."""
    knots = maps_of(pools, [fold]).withColumnRenamed(fold, "fold")
    line = knots.select("fold", F.col("at").alias("s"), "value").unionByName(asked.select("fold", "s", F.lit(None).cast("double").alias("value")))
    # the knots before and after each score: running values, in slices along the score
    placed = running_index(line.withColumn("_known", F.col("value").isNull().cast("int")), ["fold"], ["s", "_known", "value"], "_i")
    return _filled(placed.withColumn("slice", F.floor((F.col("_i") - 1) / SLICE).cast("long")))


def _filled(part: DataFrame) -> DataFrame:
    knot = F.when(F.col("value").isNotNull(), F.struct("s", "value"))
    ends = cut(part.groupBy("fold", "slice").agg(F.max_by(knot, F.when(F.col("value").isNotNull(), F.col("_i"))).alias("last"),
                                                 F.min_by(knot, F.when(F.col("value").isNotNull(), F.col("_i"))).alias("first")), "ends")
    before = Window.partitionBy("fold").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # what follows is what comes before in the other order: a frame that ends with its partition is run through anew for every row
    after = Window.partitionBy("fold").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("fold", "slice", F.last("last", True).over(before).alias("left"), F.last("first", True).over(after).alias("right"))
    up, down = (Window.partitionBy("fold", "slice").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("_i"), F.desc("_i")))
    near = part.withColumns({"l": F.last(knot, True).over(up), "r": F.last(knot, True).over(down)})
    near = near.where("value IS NULL").join(ends, ["fold", "slice"], "left").withColumns({"l": F.coalesce("l", "left"), "r": F.coalesce("r", "right")})
    gap = F.col("r.s") - F.col("l.s")
    value = (F.when(F.col("l").isNull(), F.col("r.value")).when(F.col("r").isNull() | (gap == 0) | (F.col("s") == F.col("l.s")), F.col("l.value"))
             .otherwise(F.col("l.value") + (F.col("r.value") - F.col("l.value")) * (F.col("s") - F.col("l.s")) / gap))
    return near.select("fold", "s", value.alias("value"))


def isotonic_calibration(df: DataFrame, y: str, score: str, fold: str, out: str = "calibrated") -> DataFrame:
    """``df`` with the mean of one isotonic map per fold, each fitted on that fold's rows, whose scores the fold's model gave."""
    data = df.withColumn(score, F.col(score).cast("double"))
    points = data.groupBy(fold, score).agg(F.avg(F.col(y).cast("double")).alias("_y"), F.count("*").cast("double").alias("_w"))
    pools = isotonic(points, [fold], score, "_y", "_w")
    told = calibrated(data, score, pools, fold).withColumnRenamed("calibrated", out)
    return data.join(told, score)


def refitted(df: DataFrame, fold: str, folds: int, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], together: bool = False) -> list[tuple[Callable, DataFrame]]:
    """(scorer, the fold's rows scored) of a base model fitted anew for each fold on the other folds' rows.

    ``fit`` gets the rows of a model and gives its scorer. With ``together`` it gets all rows once, with their folds, and gives the
    scorers of all folds in order, so that their models may share passes.
    """
    scorers = fit(df.where(F.col(fold).isNotNull())) if together else [fit(df.where(F.col(fold) != k)) for k in range(folds)]
    return [(scorer, scorer(df.where(F.col(fold) == k))) for k, scorer in enumerate(scorers)]


def refitted_calibration(df: DataFrame, new: DataFrame, y: str, key: str, fold: str, folds: int, fit: Callable, out: str = "calibrated", together: bool = False) -> DataFrame:
    """(key, calibrated) of ``new``: the mean over folds of a base model fitted without the fold, mapped by the isotonic fit on the fold's rows.

    The folds' scores are one table, and so are their points and pools: the number of jobs does not grow with folds.
    """
    held, asked = [], []
    for k, (scorer, mine) in enumerate(refitted(df, fold, folds, fit, together)):
        held.append(mine.select(F.lit(k).alias("fold"), F.col("prob").cast("double").alias("s"), F.col(y).cast("double").alias("y")))
        asked.append(scorer(new).select(F.lit(k).alias("fold"), key, F.col("prob").cast("double").alias("s")))
    scored, asked = cut(reduce(DataFrame.unionByName, held), "held"), cut(reduce(DataFrame.unionByName, asked), "asked")
    points = cut(scored.groupBy("fold", "s").agg(F.avg("y").alias("_y"), F.count("*").cast("double").alias("_w")), "points")
    pools = cut(isotonic(points, ["fold"], "s", "_y", "_w"), "maps")
    told = mapped(asked.join(pools, "fold", "left_semi").select("fold", "s").distinct(), pools, "fold").withColumnRenamed("value", out)
    return asked.join(told, ["fold", "s"]).groupBy(key).agg(F.avg(out).alias(out))
