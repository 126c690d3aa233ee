import numpy as np
import pandas as pd
import pytest

from cohortlens.operators import metrics as M


def frame(spark, rows):
    return spark.createDataFrame([(y, float(p)) for y, p in rows], "y int, p double")


@pytest.mark.parametrize("rows, auc", [
    ([(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)], 0.5), ([(0, 0.1), (1, 0.9)], 1.0), ([(0, 0.9), (1, 0.1)], 0.0),
    ([(1, 0.1), (1, 0.9)], None), ([(0, 0.2), (1, 0.2), (1, 0.7)], 0.75),
])
def test_auc_edges(spark, rows, auc):
    assert M.roc_auc(frame(spark, rows), "y", "p").first()["auc"] == auc


def test_sliced_totals_equal_plain_ones(spark, monkeypatch):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"u": rng.integers(0, 2, 5000), "y": rng.integers(0, 2, 5000).astype("int32"), "p": np.round(rng.random(5000), 3)})
    df = spark.createDataFrame(pdf)
    plain = {(r["u"], r["threshold"]): (r["fpr"], r["tpr"]) for r in M.roc_curve(df, "y", "p", ["u"]).collect()}
    auc = sorted(M.roc_auc(df, "y", "p", ["u"]).collect())
    monkeypatch.setattr(M, "SLICE_ROWS", 90)
    assert {(r["u"], r["threshold"]): (r["fpr"], r["tpr"]) for r in M.roc_curve(df, "y", "p", ["u"]).collect()} == plain
    assert sorted(M.roc_auc(df, "y", "p", ["u"]).collect()) == auc
    for u, value in auc:
        part = pdf[pdf["u"] == u]
        pos, neg = part[part["y"] == 1]["p"].to_numpy(), part[part["y"] == 0]["p"].to_numpy()
        wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
        assert value == pytest.approx(wins / (len(pos) * len(neg)))


def test_calibration_edges(spark):
    rows = M.calibration_curve(frame(spark, [(0, 0.0), (1, 0.1), (1, 1.0), (1, 0.95)]), "y", "p").collect()
    assert {r["bin"]: (r["n"], r["fraction_positive"]) for r in rows} == {0: (1, 0.0), 1: (1, 1.0), 9: (2, 1.0)}


def test_group_without_positives_and_group_of_one(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (1, 1, 1)], "y int, pred int, male int")
    rows = {r["male"]: r for r in M.group_metrics(df, "y", "pred", ["male"]).collect()}
    assert rows[0]["tpr"] == 0.0 and rows[0]["tnr"] == 0.5 and rows[0]["balanced"] == 0.5
    assert rows[1]["headcount"] == 1 and rows[1]["accuracy"] == 1.0 and rows[1]["tnr"] == 0.0


def test_matrix_text(spark):
    df = spark.createDataFrame([(0, 0, 1)] * 12 + [(1, 0, 1), (1, 1, 1)], "y int, pred int, male int")
    text = M.fairness_frame(df, "y", "pred", ["male"], [], {"model_id": 2}).first()["matrix"]
    assert text == "[[12  0]\n [ 1  1]]"


def test_empty_scores(spark):
    df = spark.createDataFrame([], "u string, y int, p double")
    assert M.roc_auc(df, "y", "p", ["u"]).count() == 0 and M.roc_curve(df, "y", "p", ["u"]).count() == 0
