"""The bagged forest, class weights and early stopping; ``boosting`` has the boosted models."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positive_weight(train: DataFrame, label: str) -> float:
    """Negatives per positive; 1 when a class is missing."""
    row = train.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return row["n0"] / row["n1"] if row["n0"] and row["n1"] else 1.0


def weight_column(label: str, positive: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(positive))).otherwise(F.lit(1.0))


def random_forest(train: DataFrame, label: str, trees: int, depth: int, bins: int = 48, seed: int = 7):
    weighted = train.withColumn("_w", weight_column(label, positive_weight(train, label)))
    return RandomForestClassifier(labelCol=label, weightCol="_w", numTrees=trees, maxDepth=depth, maxBins=bins, seed=seed).fit(weighted)


def early_stop(losses: DataFrame, by: list[str], order: str, loss: str, patience: int) -> DataFrame:
    """Per group the round training would keep: the best one before ``patience`` rounds bring no gain.

    A loss table has one row per round.
    """
    w = Window.partitionBy(*by).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    placed = losses.withColumn("_pos", F.row_number().over(w)).withColumn(
        "_best", F.min(F.struct(F.col(loss).alias("loss"), F.col("_pos").alias("pos"), F.col(order).alias("at"))).over(upto)
    )
    stops = F.col("_pos") - F.col("_best.pos") >= patience
    ended = placed.groupBy(*by).agg(
        F.min(F.when(stops, F.struct("_pos", "_best"))).alias("_stop"),
        F.max(F.struct("_pos", "_best")).alias("_end"),
    ).withColumn("_pick", F.coalesce("_stop", "_end"))
    return ended.select(
        *by, F.col("_pick._best.at").alias("best_round"), F.col("_pick._best.loss").alias("best_loss"),
        F.col("_pick._pos").alias("rounds_run"),
    )
