"""The rows of logit steps are dealt to all cores, however few tasks gave them; one fit's Hessian as that of many."""

import numpy as np
from pyspark.ml.feature import VectorAssembler

from cohortlens.models import batched as E


def test_rows_of_one_task_are_dealt(spark, monkeypatch):
    rows = [(float(i % 7), float(i * 31 % 11), i * 17 % 5 % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, y int").coalesce(1)
    tasks, cut = {}, E.cut
    monkeypatch.setattr(E, "cut", lambda df, tag: tasks.update({tag: df.rdd.getNumPartitions()}) or cut(df, tag))
    E.elastic_logits(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df), "y", {E.ONE: [E.Fit(0, E.NO_FOLD, 1.0, 0.0)]})
    assert tasks["rows"] >= spark.sparkContext.defaultParallelism > 1


def test_one_fit_as_many():
    rng = np.random.default_rng(1)
    x, y, fold = rng.normal(size=(300, 4)), rng.integers(0, 2, 300), rng.integers(0, 3, 300)
    fits = [E.Fit(i, i % 3, 1.0, 0.0) for i in range(9)]
    b, weights = rng.normal(size=(5, 9)), {f: (0.8, 1.3) for f in range(3)}
    many = E.block_sums(x, y, fold, b, fits, weights)
    for i, f in enumerate(fits):
        assert np.allclose(E.block_sums(x, y, fold, b[:, i : i + 1], [f], weights), many[i])
