"""Successive halving over a parameter grid."""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import roc_auc
from ..operators.relational import row_ordinal
from ..session import cut


def rungs(candidates: int, min_resources: int, max_resources: int, factor: int = 3, aggressive: bool = True) -> list[tuple[int, int]]:
    """(candidates, resources) of each rung. Aggressive elimination repeats the smallest resource first."""
    required = 1 + _whole_log(candidates, factor)
    possible = 1 + _whole_log(max_resources // min_resources, factor)
    count = required if aggressive else min(required, possible)
    out = []
    for i in range(count):
        power = max(0, i - required + possible) if aggressive else i
        out.append((candidates, min(min_resources * factor**power, max_resources)))
        candidates = math.ceil(candidates / factor)
    return out


def _whole_log(n: int, base: int) -> int:
    power = 0
    while base ** (power + 1) <= n:
        power += 1
    return power


def exhausting_minimum(candidates: int, max_resources: int, factor: int, folds: int, classes: int = 2) -> int:
    """The smallest resource with which the last rung uses as much as it can."""
    last = _whole_log(candidates, factor)
    return max(2 * folds * classes, max_resources // factor**last)


def sample_rows(df: DataFrame, key: str, resources: int, total: int) -> DataFrame:
    """About ``resources`` of ``total`` rows, the same ones every time: rows as a resource of the search."""
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int((1 << 30) * min(1.0, resources / total)))


def survivors(scores: DataFrame, candidate: str, score: str, factor: int = 3) -> DataFrame:
    """The best ceil(n / factor) candidates by mean score, ties by candidate: (candidate, mean_score).

    ``scores`` has one row per candidate and fold.
    """
    means = cut(scores.groupBy(candidate).agg(F.avg(score).alias("mean_score")), "means")
    keep = math.ceil(means.count() / factor)
    ordered = row_ordinal(means.withColumn("_worst", -F.col("mean_score")), ["_worst", candidate], "_place")
    return ordered.where(F.col("_place") < keep).drop("_worst", "_place")


def grid(**choices) -> list[dict]:
    """All combinations of the listed values."""
    return [dict(zip(choices, combo)) for combo in itertools.product(*choices.values())]


def halving_search(train: DataFrame, label: str, fold: str, folds: int, candidates: list[dict], fit, min_resources: int,
                   max_resources: int, factor: int = 3, aggressive: bool = True, parallel: int = 4):
    """(best candidate, scores) where ``scores`` rows are (rung, candidate, resources, fold, auc).

    ``fit(rows, candidate, resources)`` returns a frame-to-frame scorer adding ``prob``; resources are
    trees, or rows taken by ``sample_rows``. Fits of a rung run from a small thread pool, each of
    them a Spark job over its fold's rows. ``train`` should be a stored table.
    """
    alive = list(range(len(candidates)))
    log = []

    def run(job):
        rung, c, resources, k = job
        scorer = fit(train.where(F.col(fold) != k), candidates[c], resources)
        auc = roc_auc(scorer(train.where(F.col(fold) == k)), label, "prob").first()["auc"]
        return (rung, c, resources, k, auc)

    plan = rungs(len(candidates), min_resources, max_resources, factor, aggressive)
    for rung, (_, resources) in enumerate(plan):
        jobs = [(rung, c, resources, k) for c in alive for k in range(folds)]
        with ThreadPoolExecutor(parallel) as pool:
            done = list(pool.map(inheritable_thread_target(train.sparkSession)(run), jobs))
        log += done
        # a fold without both classes has no AUC and no say
        told = {c: [r[4] for r in done if r[1] == c and r[4] is not None] for c in alive}
        mean = {c: sum(v) / len(v) if v else 0.0 for c, v in told.items()}
        ranked = sorted(alive, key=lambda c: (-mean[c], c))
        alive = ranked[: math.ceil(len(alive) / factor)]
    return candidates[alive[0]], log
