"""Folds of a calibration share their passes, steps without absolute values are solved, no frame is run through anew for every row."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortlens.models import batched as E
from cohortlens.models import calibration as C


def pools(w, y):
    out = []
    for a, b in zip(w, y):
        out.append([1, a, b])
        while len(out) > 1 and out[-2][2] >= out[-1][2]:
            n, v, z = out.pop()
            m, c, d = out.pop()
            out.append([m + n, c + v, (c * d + v * z) / (c + v)])
    return np.repeat([o[2] for o in out], [o[0] for o in out])


def collinear(spark, n):
    """``b`` says what ``a`` says, and ``c`` never varies."""
    df = spark.range(n).select("id", (F.col("id") * 7919 % 13).cast("double").alias("a"), F.lit(4.0).alias("c"), (F.col("id") * 104729 % 17 / 4.0).alias("d"),
                               (F.pmod(F.xxhash64("id"), F.lit(29)) < F.col("id") * 7919 % 13 + 6).cast("int").alias("y"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).cast("int").alias("fold"))
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df.withColumn("b", 3 * F.col("a") + 1))


def test_a_step_reaches_the_minimum_where_columns_are_collinear():
    x = np.random.default_rng(3).normal(size=(400, 2))
    x = np.hstack((x, x[:, :1], np.zeros((400, 1))))
    h, g, l2 = 1e4 * x.T @ x, x.T @ np.arange(400.0), np.array([1.0, 2.0, 3.0, 0.0])
    b = np.array([0.5, -1.0, 0.0, 0.25])
    new = E.newton(b[None], g[None], h[None], np.zeros((1, 4)), l2[None], 1e-9)[0]
    assert np.abs(g + h @ (new - b) + l2 * new).max() < 1e-6 * np.abs(g).max() and new[3] == 0.25  # nothing moves a column that does not vary


def test_mixed_penalties_keep_their_minima():
    """A fit with absolute values beside one without: both end where no direction falls."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3))
    h, g = np.stack([x.T @ x] * 2), rng.normal(size=(2, 3)) * 50
    l1, l2, b = np.array([[20.0] * 3, [0.0] * 3]), np.array([[0.5] * 3, [2.0] * 3]), np.zeros((2, 3))
    new = E.newton(b, g, h, l1, l2, 1e-9)
    slope = g + np.einsum("fij,fj->fi", h, new) + l2 * new
    assert np.allclose(slope[1], 0, atol=1e-8)
    assert np.allclose(np.where(new[0] != 0, slope[0] + 20 * np.sign(new[0]), np.maximum(np.abs(slope[0]) - 20, 0)), 0, atol=1e-5)


def test_collinear_fits_settle_in_few_passes(spark, monkeypatch):
    passes, newton = [], E.newton
    monkeypatch.setattr(E, "newton", lambda *a: passes.append(1) or newton(*a))
    df = collinear(spark, 20_000)
    one = E.elastic_logits(df, "y", {E.ONE: [E.Fit(0, k, 1.0, 0.0) for k in range(4)]}, fold="fold")[E.ONE]
    assert one.converged.all() and len(passes) < 15
    assert one.rows.tolist() == [df.where(f"fold <> {k}").count() for k in range(4)]
    local = df.select("a", "b", "c", "d", "y", "fold").toPandas().astype(float)
    for k in range(4):  # at the optimum of the penalised loss in the columns as they are
        part = local[local["fold"] != k]
        x, y, b = part[["a", "b", "c", "d"]].to_numpy(), part["y"].to_numpy(), one.beta[:, k]
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
        off = w * (1 / (1 + np.exp(-(x @ b[:-1] + b[-1]))) - y)
        assert np.abs(x[:, [0, 1, 3]].T @ off + b[[0, 1, 3]]).max() < 1e-3 and abs(off.sum()) < 1e-3


def test_the_search_descends(spark, monkeypatch):
    """Its candidates are ranked after few steps, all reached in the same way."""
    monkeypatch.setattr(E, "ridge_steps", lambda *a: pytest.fail("solved"))
    _, log = E.logit_search(collinear(spark, 300), "y", "id", "fold", 4, [{"c": 1.0, "l1_ratio": 0.0}], min_resources=300, steps=2)
    assert len(log) == 1 and 0 < log[0][4] <= 1


def fits(alone):
    """The fold's logits: each from its own rows, or all from all rows."""
    scorer = lambda beta: lambda rows: rows.withColumn("prob", 1 / (1 + F.exp(-sum((F.col(c) * float(v) for c, v in zip("abcd", beta)), F.lit(float(beta[-1]))))))
    if alone:
        return lambda part: scorer(E.elastic_logits(part, "y", {E.ONE: [E.Fit(0, E.NO_FOLD, 1.0, 0.0)]})[E.ONE].beta[:, 0])
    return lambda rows: [scorer(b) for b in E.elastic_logits(rows, "y", {E.ONE: [E.Fit(0, k, 1.0, 0.0) for k in range(4)]}, fold="fold")[E.ONE].beta.T]


def test_folds_fitted_together_as_alone(spark):
    df = collinear(spark, 1_200)
    train, new = df.where("id % 5 > 0"), df.where("id % 5 = 0").drop("fold")
    alone, both = ({r["id"]: r["calibrated"] for r in C.refitted_calibration(train, new, "y", "id", "fold", 4, fits(not t), together=t).collect()} for t in (False, True))
    assert alone.keys() == both.keys() and len(both) == 240
    assert [both[k] for k in both] == pytest.approx([alone[k] for k in both], abs=1e-6)


@pytest.mark.parametrize("size", [50_000, 7])
def test_mean_over_folds_by_hand(spark, monkeypatch, size):
    """Keys that repeat or are null, a fold without rows, a row without a fold; one table of scores and of points for all folds."""
    monkeypatch.setattr(C, "SLICE", size)
    tags, cut = [], C.cut
    monkeypatch.setattr(C, "cut", lambda df, tag, *a: tags.append(tag) or cut(df, tag, *a))
    rng = np.random.default_rng(6)
    rows = [(int(i), float(round(rng.random(), 2)), int(rng.random() < 0.4 + i % 3 / 10), None if i == 5 else int(i % 3)) for i in range(150)]
    asked = [(None if i % 10 == 0 else i // 2, float(round(rng.random() * 1.4 - 0.2, 2))) for i in range(60)]
    seen = []

    def fit(part):
        seen.append({r[0] for r in part.select("fold").distinct().collect()})
        k = len(seen) - 1
        return lambda df: df.withColumn("prob", F.col("s") + k / 10)

    out = C.refitted_calibration(spark.createDataFrame(rows, "id long, s double, y int, fold int"), spark.createDataFrame(asked, "id long, s double"), "y", "id", "fold", 4, fit)
    got = {r["id"]: r["calibrated"] for r in out.collect()}
    assert seen == [{1, 2}, {0, 2}, {0, 1}, {0, 1, 2}] and tags.count("held") == tags.count("asked") == 1
    maps = []
    for k in range(3):
        at = {}
        for _, s, y, f in rows:
            if f == k:
                at.setdefault(s + k / 10, []).append(y)
        s = sorted(at)
        maps.append((s, pools([len(at[v]) for v in s], [np.mean(at[v]) for v in s])))
    want = {}
    for key, s in asked:
        want.setdefault(key, []).extend(np.interp(s + k / 10, *maps[k]) for k in range(3))
    assert got.keys() == want.keys()
    assert [got[k] for k in want] == pytest.approx([np.mean(v) for v in want.values()], abs=1e-9)


def test_no_frame_ends_with_its_partition(spark):
    """Spark runs through such a frame anew for every row, 50,000 times 50,000 steps a slice of distinct scores."""
    knots = spark.createDataFrame([(0, 0.1, 0.2, 0.3), (0, 0.4, 0.5, 0.6)], "fold int, lo double, hi double, value double")
    out = C.calibrated(spark.createDataFrame([(0.0,), (0.3,), (0.9,)], "s double"), "s", knots, "fold")
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    assert {r["s"]: r["calibrated"] for r in out.collect()} == pytest.approx({0.0: 0.3, 0.3: 0.45, 0.9: 0.6})
