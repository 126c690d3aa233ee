"""Model quality: rates, exact ROC and AUC, calibration, and metrics by sensitive group."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, join_groups

SLICE_ROWS = 1_000_000


def confusion_aggs(y: str, pred: str) -> list[Column]:
    yc, pc = F.col(y), F.col(pred)
    return [
        F.count_if((yc == 0) & (pc == 0)).alias("tn"),
        F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"),
        F.count_if((yc == 1) & (pc == 1)).alias("tp"),
    ]


def confusion_matrix(df: DataFrame, y: str, pred: str, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*confusion_aggs(y, pred))


def with_rates(counts: DataFrame) -> DataFrame:
    """accuracy, tpr, tnr, balanced from the four counts; an undefined rate is 0.

    Balanced accuracy averages the recall of the classes that occur.
    """
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    tpr = F.when(tp + fn > 0, tp / (tp + fn))
    tnr = F.when(tn + fp > 0, tn / (tn + fp))
    return counts.withColumns({
        "accuracy": F.when(n > 0, (tp + tn) / n),
        "tpr": F.coalesce(tpr, F.lit(0.0)),
        "tnr": F.coalesce(tnr, F.lit(0.0)),
        "balanced": F.when(tpr.isNull(), tnr).when(tnr.isNull(), tpr).otherwise((tpr + tnr) / 2),
    })


def accuracy(df: DataFrame, y: str, pred: str, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def group_metrics(df: DataFrame, y: str, pred: str, sensitive: list[str], by: list[str] = ()) -> DataFrame:
    """All metrics for every observed cross of the sensitive columns, in one aggregate."""
    counts = df.groupBy(*by, *sensitive).agg(*confusion_aggs(y, pred), F.count("*").alias("headcount"))
    return with_rates(counts)


def score_counts(df: DataFrame, y: str, score: str, by: list[str]) -> DataFrame:
    """Positives and negatives at each distinct score; partial aggregation absorbs hot scores."""
    return df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )


def _sliced(counts: DataFrame) -> DataFrame:
    """Slices of about ``SLICE_ROWS`` rows along the score; the driver sees their edges only."""
    slices = math.ceil(counts.count() / SLICE_ROWS)
    if slices <= 1:
        return counts.withColumn("_slice", F.lit(0))
    inner = sorted(set(counts.approxQuantile("score", [i / slices for i in range(1, slices)], 0.1 / slices)))
    cutter = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="score", outputCol="_slice")
    return cutter.transform(counts).withColumn("_slice", F.col("_slice").cast("int"))


def descending_totals(counts: DataFrame, by: list[str]) -> DataFrame:
    """Running positives and negatives from the highest score down, as ``tp`` and ``fp``.

    No window holds a whole group: scores are sliced at approximate quantiles, the running sum
    inside a slice starts from the total of the slices above, and the totals table has one row per
    group and slice. The counts are written once, so the scored rows are read a single time.
    """
    sliced = _sliced(cut(counts, "scores"))
    above = Window.partitionBy(*by).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(*by, "_slice").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    offsets = totals.select(
        *by, "_slice",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("_p0"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_n0"),
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    running = sliced.withColumns({"tp": F.sum("pos").over(inside), "fp": F.sum("neg").over(inside)})
    return (
        join_groups(running, offsets, [*by, "_slice"])
        .withColumns({"tp": F.col("tp") + F.col("_p0"), "fp": F.col("fp") + F.col("_n0")})
        .drop("_slice", "_p0", "_n0")
    )


def roc_auc(df: DataFrame, y: str, score: str, by: list[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties at half; NULL when a class is missing."""
    by = list(by)
    keys = by or ["_all"]
    counts = score_counts(df if by else df.withColumn("_all", F.lit(1)), y, score, keys)
    run = descending_totals(counts, keys)
    # A negative ranks below every positive with a higher score and ties with those at its own.
    wins = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    area = run.groupBy(*keys).agg(
        F.sum(wins).alias("_area"), F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg")
    )
    auc = F.when((F.col("_pos") > 0) & (F.col("_neg") > 0), F.col("_area") / (F.col("_pos").cast("double") * F.col("_neg")))
    return area.select(*by, auc.alias("auc"))


def roc_curve(df: DataFrame, y: str, score: str, by: list[str]) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score and the (0, 0) start, whose threshold is infinite."""
    run = descending_totals(score_counts(df, y, score, by), by)
    ends = run.groupBy(*by).agg(F.max("tp").alias("_pos"), F.max("fp").alias("_neg"))
    points = join_groups(run, ends, by).select(
        *by, F.col("score").alias("threshold"),
        (F.col("fp").cast("double") / F.nullif(F.col("_neg"), F.lit(0))).alias("fpr"),
        (F.col("tp").cast("double") / F.nullif(F.col("_pos"), F.lit(0))).alias("tpr"),
    )
    start = ends.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def calibration_curve(df: DataFrame, y: str, score: str, bins: int = 10, by: list[str] = ()) -> DataFrame:
    """Mean predicted and fraction positive in uniform bins; the last bin holds 1.0, empty bins are absent."""
    bucket = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, bucket.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("fraction_positive"),
        F.count("*").alias("n"),
    )


def log_loss(y: str, prob: str, weight: Column | None = None) -> Column:
    """Mean log loss as an aggregate, probabilities kept off 0 and 1."""
    p = F.least(F.greatest(F.col(prob), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -F.when(F.col(y) == 1, F.log(p)).otherwise(F.log(1 - p))
    return F.avg(loss) if weight is None else F.sum(loss * weight) / F.sum(weight)


def fairness_frame(df: DataFrame, y: str, pred: str, sensitive: list[str], by: list[str], meta: dict) -> DataFrame:
    """Group metrics for all splits and units at once, with the run's metadata and the matrix as text."""
    out = group_metrics(df, y, pred, sensitive, by)
    cells = {c: F.col(c).cast("string") for c in ("tn", "fp", "fn", "tp")}
    width = F.greatest(*[F.length(t) for t in cells.values()])
    tn, fp, fn, tp = (F.lpad(t, width, " ") for t in cells.values())
    text = F.concat(F.lit("[["), tn, F.lit(" "), fp, F.lit("]\n ["), fn, F.lit(" "), tp, F.lit("]]"))
    return out.withColumn("matrix", text).withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in meta.items()})
