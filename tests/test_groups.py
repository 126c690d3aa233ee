"""Rows whose group is NULL are rows of a group, and none is lost."""

import pytest
from pyspark.sql import functions as F

from cohortlens.models import grouped as Q
from cohortlens.models.search import halving_search
from cohortlens.operators.features import OneHot, standard_scale
from cohortlens.operators.metrics import roc_auc, roc_curve
from cohortlens.operators.neighbors import gower_scale
from cohortlens.operators.relational import running_index


@pytest.fixture(scope="module")
def df(spark):
    rows = [(i, g, float(i % 5), (i * 7 % 3) / 2 + i % 2, i % 2) for i, g in enumerate(["a"] * 8 + [None] * 8)]
    return spark.createDataFrame(rows, "id int, g string, x double, z double, y int")


def test_index_and_scale(df):
    for out in (running_index(df, ["g"], ["id"]), standard_scale(df, ["x"], ["g"]), gower_scale(df, ["x"], ["g"])):
        assert sorted(r["id"] for r in out.collect()) == list(range(16))
    got = {r["id"]: r["idx"] for r in running_index(df, ["g"], ["id"]).collect()}
    assert [got[i] for i in range(16)] == [*range(1, 9), *range(1, 9)]


def test_curves(df):
    assert {r["g"] for r in roc_auc(df, "y", "z", ["g"]).collect()} == {"a", None}
    assert {r["g"] for r in roc_curve(df, "y", "z", ["g"]).collect()} == {"a", None}


def test_fits(df):
    assert {r["g"] for r in Q.least_squares(df, "z", ["x"], ["g"]).collect()} == {"a", None}
    assert {r["r"] is None for r in Q.residual(df, "z", ["x"], "r", ["g"]).collect()} == {False}


def test_groups_that_were_not_fitted_stay(df):
    cats = df.withColumn("c", F.when(F.col("id") % 2 == 0, "p").otherwise("q"))
    coder = OneHot.fit(cats.where("g = 'a'"), ["c"], ["g"], unseen="zero")
    assert coder.transform(cats).count() == 16
    with pytest.raises(Exception, match="unseen category"):
        OneHot.fit(cats.where("g = 'a'"), ["c"], ["g"]).transform(cats).collect()


def test_many_categories(spark):
    df = spark.range(1500).select(F.concat(F.lit("v"), "id").alias("c"))
    assert len(OneHot.fit(df, ["c"]).names()) == 1499


def test_a_fold_without_a_class_has_no_say(spark):
    rows = [(k, float(i), i % 2) for k in range(2) for i in range(8)] + [(2, float(i), 0) for i in range(8)]
    df = spark.createDataFrame(rows, "fold int, x double, y int")

    def fit(train, choice, rounds):
        return lambda part: part.withColumn("prob", F.lit(0.5) if choice["flat"] else F.col("y") * 0.5)

    best, log = halving_search(df, "y", "fold", 3, [{"flat": True}, {"flat": False}], fit, 1, 1)
    assert best == {"flat": False} and any(r[4] is None for r in log)
