import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortlens.explain import contributions
from cohortlens.explain.contributions import tree_contributions
from cohortlens.models import batched as E
from cohortlens.models import boosting as G
from cohortlens.models import calibration as C
from cohortlens.models import grouped as Q
from cohortlens.models import linear as L
from cohortlens.models import nets as N
from cohortlens.models import search as H
from cohortlens.models import trees as T


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 600
    x = np.column_stack([rng.normal(size=n), rng.normal(size=n) * 3 + 1, rng.integers(0, 2, n)])
    y = (x[:, 0] - 0.5 * x[:, 1] + x[:, 2] + rng.logistic(size=n) > 0).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, id=range(n), u=np.where(np.arange(n) % 2, "p", "q"), f=list(x))
    df = spark.createDataFrame(pdf).withColumn("features", array_to_vector("f")).cache()
    return pdf, df


def test_least_squares_per_group(spark, data):
    pdf, df = data
    fits = {r["u"]: r for r in Q.least_squares(df, "b", ["a", "c"], ["u"]).collect()}
    for u, part in pdf.groupby("u"):
        x = np.column_stack([np.ones(len(part)), part["a"], part["c"]])
        assert fits[u]["beta"] == pytest.approx(np.linalg.lstsq(x, part["b"], rcond=None)[0].tolist()) and fits[u]["n"] == len(part)
    long = Q.coefficients(Q.least_squares(df, "b", ["a", "c"]), ["a", "c"]).collect()
    assert [r["term"] for r in long] == ["intercept", "a", "c"]


def test_residual_of_incomplete_rows_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 4.0), (3, 3.0, 6.0), (4, None, 1.0), (5, 4.0, None)], "id int, x double, y double")
    got = {r["id"]: r["r"] for r in Q.residual(df, "y", ["x"], "r").collect()}
    assert got[4] is None and got[5] is None and got[1] == pytest.approx(0, abs=1e-9)
    none = df.where("x IS NULL")
    assert [r["r"] for r in Q.residual(none, "y", ["x"], "r").collect()] == [None]


def test_a_hundred_thousand_groups(spark, monkeypatch):
    """Every group has its own line; nothing but counts comes to the driver, and the plan has no branch per group."""
    monkeypatch.setattr(Q, "BUCKET", 100_000)
    df = spark.range(400_000).select((F.col("id") % 100_000).alias("g"), (F.col("id") % 7 + F.col("id") / 100_000).alias("x"))
    df = df.withColumn("y", F.col("g") % 11 + (F.col("g") % 5) * F.col("x"))
    fits = Q.least_squares(df, "y", ["x"], ["g"])
    off = fits.where((F.abs(F.get("beta", F.lit(0)) - F.col("g") % 11) > 1e-6) | (F.abs(F.get("beta", F.lit(1)) - F.col("g") % 5) > 1e-6))
    assert fits.count() == 100_000 and off.count() == 0
    assert Q.residual(df, "y", ["x"], "r", ["g"]).where("abs(r) > 1e-6 OR r IS NULL").count() == 0


def test_vif_of_combinations_and_constants(spark, data):
    pdf, df = data
    told = lambda d, xs: {r["feature"]: r["vif"] for r in Q.vif(d, xs).collect()}
    wide = df.withColumns({"d": F.col("a") + F.col("b"), "zero": F.lit(0.0), "e": F.col("c") + F.sin("id")})
    got = told(wide, ["a", "b", "d", "zero", "c", "e"])
    assert math.isinf(got["a"]) and math.isinf(got["b"]) and math.isinf(got["d"]) and got["zero"] is None
    r = np.corrcoef(pdf["c"], pdf["c"] + np.sin(pdf["id"]))[0, 1]
    assert got["c"] == pytest.approx(1 / (1 - r * r), rel=0.05)
    plain = told(df, ["a", "b"])
    x = np.column_stack([np.ones(len(pdf)), pdf["a"], pdf["b"]])
    inv = np.linalg.inv(x.T @ x)
    assert plain["intercept"] == pytest.approx(len(pdf) * inv[0, 0])
    assert plain["a"] == pytest.approx(((pdf["a"] - pdf["a"].mean()) ** 2).sum() * inv[1, 1])
    assert math.isinf(told(df.withColumn("two", F.lit(2.0)), ["a", "two"])["intercept"])


def test_logit_solves_its_score_equations(data):
    pdf, df = data
    found = {r["term"]: r for r in Q.logit_inference(df.drop("features").withColumn("b", F.col("b") * 1000 + 5), "y", ["a", "b", "c"]).collect()}
    x = np.column_stack([pdf["a"], pdf["b"] * 1000 + 5, pdf["c"], np.ones(len(pdf))])
    p = 1 / (1 + np.exp(-x @ np.array([found[t]["coef"] for t in ("a", "b", "c", "intercept")])))
    assert np.abs(x.T @ (pdf["y"] - p)).max() < 1e-3
    errors = np.sqrt(np.diag(np.linalg.inv(x.T @ (x * (p * (1 - p))[:, None]))))
    assert [found[t]["std_err"] for t in ("a", "b", "c", "intercept")] == pytest.approx(errors.tolist(), rel=1e-4)
    for r in found.values():
        assert r["status"] == "converged" and r["z"] == pytest.approx(r["coef"] / r["std_err"])
        assert r["p"] == pytest.approx(math.erfc(abs(r["z"]) / math.sqrt(2)))


def test_each_groups_logit_ends_in_its_own_way(spark, data):
    """Groups that converge, that are separated, that have one class, a singular design, a fixed column, and no name."""
    pdf, _ = data
    rows = [("fine", int(r.y), float(r.a), float(r.b)) for r in pdf.itertuples()]
    rows += [(None, int(r.y), float(r.a), 4.0) for r in pdf.itertuples()]
    rows += [("apart", int(a > 0), float(a), float(b)) for a, b in zip(pdf["a"], pdf["b"])]
    rows += [("once", 1, float(a), float(b)) for a, b in zip(pdf["a"], pdf["b"])]
    rows += [("twice", int(r.y), float(r.a), 2 * float(r.a) + 1) for r in pdf.itertuples()]
    df = spark.createDataFrame(rows, "g string, y int, a double, b double")
    out = {}
    for r in Q.logit_inference(df, "y", ["a", "b"], ["g"]).collect():
        out.setdefault(r["g"], []).append(r)
    assert {g: {r["status"] for r in rs} for g, rs in out.items()} == {
        "fine": {"converged"}, None: {"converged"}, "apart": {"failed: separation"}, "once": {"failed: one class"}, "twice": {"failed: singular design"}}
    assert {r["term"] for r in out[None]} == {"a", "intercept"} and len(out["fine"]) == 3 and len(out["apart"]) == 1
    alone = {r["term"]: r["coef"] for r in Q.logit_inference(df.where("g = 'fine'"), "y", ["a", "b"]).collect()}
    assert {r["term"]: r["coef"] for r in out["fine"]} == pytest.approx(alone, rel=1e-9)


def test_no_complete_rows_no_fit(spark):
    df = spark.createDataFrame([(0, None)], "y int, a double")
    assert Q.logit_inference(df, "y", ["a"]).count() == 0 and Q.least_squares(df, "y", ["a"]).count() == 0


def slopes_of(pdf, fit, f):
    """(gradient of the weighted log loss in the columns as they are, coefficients, intercept) of one fit."""
    part = pdf[pdf["id"] % 3 != fit.fold] if fit.fold >= 0 else pdf
    x, y, beta = np.stack(part["f"].to_numpy()), part["y"].to_numpy(), f.beta[:, f.fits.index(fit)]
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    p = 1 / (1 + np.exp(-(x @ beta[:-1] + beta[-1])))
    return fit.c * (w * (p - y)) @ x, beta[:-1], fit.c * (w * (p - y)).sum()


def test_elastic_logits_meet_their_conditions(data, monkeypatch):
    """Every fit is at the minimum of its penalised loss: ridge, lasso, both, with folds left out, in few or many passes."""
    pdf, df = data
    fits = [E.Fit(i, k, c, r) for i, (c, r) in enumerate([(1.0, 0.0), (0.05, 1.0), (0.3, 0.5), (1e4, 0.0)]) for k in (E.NO_FOLD, 0, 2)]
    scaled = df.withColumn("id3", F.col("id") % 3)
    out = E.elastic_logits(scaled, "y", {E.ONE: fits}, None, "id3")[E.ONE]
    assert out.converged.all()
    for fit in fits:
        gradient, beta, level = slopes_of(pdf, fit, out)
        assert abs(level) < 1e-5
        for g, b in zip(gradient + (1 - fit.l1_ratio) * beta, beta):
            assert abs(g + fit.l1_ratio * np.sign(b)) < 1e-5 if b else abs(g) <= fit.l1_ratio + 1e-9
    assert (out.beta[:-1, [f.l1_ratio == 1.0 for f in fits]] == 0).any()
    monkeypatch.setattr(E, "NUMBERS", 50)
    few = E.elastic_logits(scaled, "y", {E.ONE: fits[:4]}, None, "id3")[E.ONE]
    assert few.beta == pytest.approx(out.beta[:, :4], abs=1e-8)


def test_logits_of_groups_are_their_own(spark, data):
    pdf, df = data
    one = [E.Fit(0, E.NO_FOLD, 1.0, 0.2)]
    both = E.elastic_logits(df, "y", {"p": one, "q": one, "none": one}, "u")
    assert set(both) == {"p", "q"}
    alone = E.elastic_logits(df.where("u = 'q'"), "y", {E.ONE: one})[E.ONE]
    assert both["q"].beta == pytest.approx(alone.beta, abs=1e-8)
    fixed = spark.createDataFrame([(i, 1, [1.0, float(i)]) for i in range(9)], "id int, y int, f array<double>").withColumn("features", array_to_vector("f"))
    told = E.elastic_logits(fixed, "y", {E.ONE: one})[E.ONE]  # one class, a column that does not vary
    assert np.isfinite(told.beta).all() and told.beta[0, 0] == 0


def test_logit_search_halves_over_rows(data):
    pdf, df = data
    choices = [{"c": c, "l1_ratio": r} for c in (1e-4, 1.0, 100.0) for r in (0.0, 0.5, 1.0)]
    best, log = E.logit_search(df.withColumn("fold", F.floor(F.col("id") / 2) % 2), "y", "id", "fold", 2, choices, "u", min_resources=40)
    assert set(best) == {"p", "q"} and all(b in choices for b in best.values())
    for g in "pq":
        sizes = [(n, sum(1 for row in log if row[0] == g and row[3] == n)) for n in sorted({row[3] for row in log if row[0] == g})]
        assert sizes == [(40, 9), (120, 3), (300, 1)] or sizes == [(40, 9), (120, 3)]
        last = [row for row in log if row[0] == g and row[3] == 40]
        kept = {row[2] for row in log if row[0] == g and row[3] == 120}
        assert kept == {c for _, _, c, _, _ in sorted(last, key=lambda r: (-r[4], r[2]))[:3]}
    # one candidate on all rows: the accuracy by hand
    one = [{"c": 1.0, "l1_ratio": 0.0}]
    _, log = E.logit_search(df.withColumn("fold", F.col("id") % 3), "y", "id", "fold", 3, one, min_resources=600)
    out = E.elastic_logits(df.withColumn("fold", F.col("id") % 3), "y", {E.ONE: [E.Fit(0, k, 1.0, 0.0) for k in range(3)]}, None, "fold")[E.ONE]
    x, y, fold = np.stack(pdf["f"].to_numpy()), pdf["y"].to_numpy(), pdf["id"].to_numpy() % 3
    right = [((x[fold == k] @ out.beta[:-1, k] + out.beta[-1, k] > 0) == (y[fold == k] == 1)).mean() for k in range(3)]
    assert log == [(E.ONE, 0, 0, 600, pytest.approx(np.mean(right)))] and np.mean(right) > 0.6


def test_huber_loss_falls_and_separates(data):
    _, df = data
    model = L.huber_linear(df, ["a", "b", "c"], "y", steps=12)
    assert min(model.losses) < 0.7 * model.losses[0]
    row = df.withColumn("p", model.probability()).groupBy("y").agg(F.avg("p").alias("p"), F.min("p").alias("lo"), F.max("p").alias("hi")).collect()
    means = {r["y"]: r["p"] for r in row}
    assert means[1] > means[0] + 0.2 and all(0 <= r["lo"] and r["hi"] <= 1 for r in row)


def pools_by_hand(w, y):
    out = [[a, b] for a, b in zip(w, y)]
    n = [1] * len(out)
    i = 0
    while i + 1 < len(out):
        if out[i][1] >= out[i + 1][1]:
            a, b = out[i], out[i + 1]
            out[i: i + 2] = [[a[0] + b[0], (a[0] * a[1] + b[0] * b[1]) / (a[0] + b[0])]]
            n[i: i + 2] = [n[i] + n[i + 1]]
            i = max(0, i - 1)
        else:
            i += 1
    return np.repeat([v for _, v in out], n)


@pytest.mark.parametrize("size", [50_000, 7])
def test_isotonic_fit_by_hand(spark, monkeypatch, size):
    """In one slice and in many, with and without folds, rising, falling and noisy."""
    monkeypatch.setattr(C, "SLICE", size)
    rng = np.random.default_rng(2)
    frames = []
    for name, y in (("up", np.arange(60.0)), ("down", -np.arange(60.0)), (None, np.arange(60) / 20 + rng.normal(size=60)), ("one", np.array([2.0]))):
        frames.append(pd.DataFrame({"g": name, "s": rng.permutation(len(y)) if name == "x" else np.arange(len(y)) * 1.5, "y": y, "w": rng.integers(1, 5, len(y)).astype(float)}))
    pdf = pd.concat(frames)
    pools = C.isotonic(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "g string, s double, y double, w double"), ["g"], "s", "y", "w").collect()
    for part in frames:
        mine = sorted((r["lo"], r["hi"], r["value"]) for r in pools if r["g"] == part["g"].iloc[0])
        want = pools_by_hand(part["w"].tolist(), part["y"].tolist())
        got = [next(v for lo, hi, v in mine if lo <= s <= hi) for s in part["s"]]
        assert got == pytest.approx(want.tolist(), abs=1e-9)


@pytest.mark.parametrize("size", [50_000, 11])
def test_calibration_is_the_mean_of_the_maps(spark, data, monkeypatch, size):
    monkeypatch.setattr(C, "SLICE", size)
    pdf, df = data
    scored = df.select("y", F.round(1 / (1 + F.exp(F.col("b") - F.col("a"))), 2).alias("s"), (F.col("id") % 5).cast("int").alias("fold"))
    out = C.isotonic_calibration(scored, "y", "s", "fold")
    assert out.count() == 600
    got = {r["s"]: r["c"] for r in out.groupBy("s").agg(F.max("calibrated").alias("c")).collect()}
    local = scored.toPandas()
    maps = []
    for _, part in local.groupby("fold"):
        points = part.groupby("s")["y"].agg(["mean", "size"])
        maps.append((points.index.to_numpy(), pools_by_hand(points["size"].tolist(), points["mean"].tolist())))
    asked = np.array(sorted(got))
    want = np.mean([np.interp(asked, s, v) for s, v in maps], 0)
    assert [got[s] for s in asked] == pytest.approx(want.tolist(), abs=1e-9)
    assert (np.diff([got[s] for s in asked]) >= -1e-12).all()


def test_the_base_model_is_fitted_without_its_fold(spark, data):
    """Each fold's map stands on a model that has not seen the fold."""
    _, df = data
    seen = []

    def fit(part):
        seen.append({r[0] for r in part.select("fold").distinct().collect()})
        k = ({0, 1, 2} - seen[-1]).pop()
        return lambda rows: rows.withColumn("prob", 1 / (1 + F.exp(F.col("b") - F.col("a") - k)))

    folded = df.withColumn("fold", F.col("id") % 3)
    out = C.refitted_calibration(folded.where("id < 500"), folded.where("id >= 500"), "y", "id", "fold", 3, fit).toPandas()
    assert seen == [{1, 2}, {0, 2}, {0, 1}] and len(out) == 100 and out["calibrated"].between(0, 1).all()


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(5)
    sizes = N.shapes(4, (6, 5))
    flat, x, y, w = N.start(sizes, 1), rng.normal(size=(30, 4)), rng.integers(0, 2, 30), rng.random(30) + 0.5
    loss, gradient = N.loss_and_gradient(flat, sizes, x, y, w, 2.5)
    for i in rng.choice(len(flat), 40, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        around = [N.loss_and_gradient(flat + s * step, sizes, x, y, w, 2.5)[0] for s in (1, -1)]
        assert gradient[i] == pytest.approx((around[0] - around[1]) / 2e-6, abs=1e-6)
    assert loss > 0


def test_nets_learn_group_by_group(spark, data):
    """What no line can tell: a ring; each group has its own; the weights of the best epoch stay."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 2)) * [1, 50]
    ring = (x[:, 0] ** 2 + (x[:, 1] / 50) ** 2 > 1.4).astype(int)
    pdf = pd.DataFrame({"id": range(900), "u": np.where(np.arange(900) % 2, "in", "out"), "y": np.where(np.arange(900) % 2, ring, 1 - ring)}).assign(f=list(x))
    df = spark.createDataFrame(pdf).withColumn("features", array_to_vector("f"))
    nets = N.fit_nets(df, "y", "u", hidden=(16, 8), l2=0.001, rate=0.05, batch=32, epochs=25, balanced=True)
    assert all(n.losses[-1] < 0.6 * n.losses[0] for n in nets.values())
    told = N.net_scores(nets, df, "u").select("u", "y", "prob").toPandas()
    assert (((told["prob"] > 0.5) == (told["y"] == 1)).groupby(told["u"]).mean() > 0.9).all()
    assert N.net_scores(nets, df.limit(3).withColumn("u", F.lit("none")), "u").where("prob IS NOT NULL").count() == 0
    again = N.fit_nets(df, "y", "u", hidden=(16, 8), l2=0.001, rate=0.05, batch=32, epochs=3, balanced=True)
    same = N.fit_nets(df, "y", "u", hidden=(16, 8), l2=0.001, rate=0.05, batch=32, epochs=3, balanced=True)
    assert again["in"].losses == pytest.approx(same["in"].losses, rel=1e-9)
    stuck = N.fit_nets(df, "y", hidden=(4,), rate=0.0, epochs=50, patience=3)
    assert len(stuck[N.ONE].losses) == 4


def test_boosted_forest_lowers_its_loss_and_stops_early(data):
    _, df = data
    train, valid = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    model = G.boosted_forest(train, valid, "y", rounds=6, trees=8, depth=3, min_child_weight=2.0, cut_every=2)
    assert model.train_loss[-1] < model.train_loss[0] < math.log(2) * 1.01
    again = model.transform(valid).select("y", "prob").toPandas()
    loss = -np.where(again["y"] == 1, np.log(again["prob"]), np.log(1 - again["prob"])).mean()
    assert loss == pytest.approx(min(model.valid_loss), rel=1e-6)
    stuck = G.boosted_forest(train, valid, "y", rounds=6, trees=2, depth=1, step=60.0, min_child_weight=1.0, patience=1)
    assert len(stuck.valid_loss) < 6 and len(stuck.rounds) == stuck.valid_loss.index(min(stuck.valid_loss)) + 1


def boosted_by_hand(x, y, rounds, depth, step, gamma, least, l2=1.0):
    """Boosting of one tree a round on all rows and values, row by row."""
    w = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    m = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-m))
        g, h = w * (p - y), w * p * (1 - p)
        todo, add = [(np.arange(len(y)), 0)], np.zeros(len(y))
        while todo:
            rows, level = todo.pop()
            best = (-np.inf, None)
            for f in range(x.shape[1]) if level < depth else ():
                for v in np.unique(x[rows, f]):
                    left = x[rows, f] <= v
                    hl, hr = h[rows][left].sum(), h[rows][~left].sum()
                    if hl < least or hr < least:
                        continue
                    part = lambda some: g[rows][some].sum() ** 2 / (h[rows][some].sum() + l2)
                    gain = round(part(left) + part(~left) - part(left | True), 6)
                    if gain > best[0]:
                        best = (gain, left)
            if best[1] is not None and best[0] > 1e-6 and best[0] >= gamma:
                todo += [(rows[best[1]], level + 1), (rows[~best[1]], level + 1)]
            else:
                add[rows] = -g[rows].sum() / (h[rows].sum() + l2)
        m += step * add
    return m


def test_boosting_of_groups_by_hand(spark, data):
    """Groups with settings of their own, deep trees, and margins written in between."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 9, 500), rng.integers(0, 4, 500) - 2.5, rng.integers(0, 2, 500) * 7]).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + rng.normal(size=500) * 2 > 2).astype(int)
    u = np.where(rng.random(500) < 0.7, "p", "q")
    pdf = pd.DataFrame({"id": range(500), "u": u, "y": y}).assign(f=list(x))
    df = spark.createDataFrame(pdf).withColumn("features", array_to_vector("f")).repartition(4)
    own = {"p": {"depth": 5, "gamma": 0.0}, "q": {"rounds": 2, "step": 1.0}}
    models = G.boosted_forests(df, None, "y", "u", settings=own, cut_every=2, rounds=5, trees=3, depth=2, gamma=0.3, step=0.4, min_child_weight=1.5,
                               subsample=1.0, columns=1.0, columns_node=1.0)
    got = {r["id"]: r["prob"] for r in G.score(models, df, "u").select("id", "prob").collect()}
    for name, rounds, depth, step, gamma in (("p", 5, 5, 0.4, 0.0), ("q", 2, 2, 1.0, 0.3)):
        at = np.flatnonzero(u == name)
        want = 1 / (1 + np.exp(-boosted_by_hand(x[at], y[at], rounds, depth, step, gamma, 1.5)))
        assert [got[i] for i in at] == pytest.approx(want.tolist(), abs=1e-9)
    again = {n: G.BoostedForest.of_rows([tuple(r) for r in m.table(spark).collect()], m.step) for n, m in models.items()}
    assert all((again[n].margin(x) == models[n].margin(x)).all() for n in models)
    stranger = df.limit(1).withColumn("u", F.lit("z"))
    assert G.score(models, stranger, "u").first()["prob"] is None


def test_draws_are_the_same_however_the_rows_lie(spark, data):
    """Trees differ by their draws, the model does not by the number of tasks, as blocks hold the same rows."""
    _, df = data
    rows = df.orderBy("id").coalesce(1)
    one, two = (G.boosted_forest(rows, rows, "y", rounds=2, trees=6, depth=2, columns=0.67, min_child_weight=1.0, seed=s) for s in (1, 1))
    assert [r[:7] for r in one.rows()] == [r[:7] for r in two.rows()] and [r[7] for r in one.rows()] == pytest.approx([r[7] for r in two.rows()])
    assert len({tuple(v) for v in one.rounds[0].value.round(9).tolist()}) > 3
    other = G.boosted_forest(rows, rows, "y", rounds=2, trees=6, depth=2, columns=0.67, min_child_weight=1.0, seed=2)
    assert [r[:7] for r in other.rows()] != [r[:7] for r in one.rows()]


def test_bins_of_many_values(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=4000), rng.integers(0, 5, 4000), np.zeros(4000)])
    df = spark.createDataFrame(pd.DataFrame({"grp": "a"}, index=range(4000)).assign(x=list(x)))
    (edges,) = G.edges_of(df, 3, 16).values()
    assert edges[1].tolist() == [0, 1, 2, 3] and len(edges[2]) == 0
    assert edges[0] == pytest.approx(np.quantile(x[:, 0], [k / 16 for k in range(1, 16)]), abs=0.02)


def test_early_stop_keeps_the_best_round_within_patience(spark):
    losses = [("a", i, v) for i, v in enumerate([5.0, 4.0, 4.5, 4.4, 3.0])] + [("b", i, float(10 - i)) for i in range(4)]
    df = spark.createDataFrame(losses, "u string, r int, loss double")
    got = {r["u"]: (r["best_round"], r["best_loss"], r["rounds_run"]) for r in T.early_stop(df, ["u"], "r", "loss", 2).collect()}
    assert got == {"a": (1, 4.0, 4), "b": (3, 7.0, 4)}


def test_halving_schedule():
    assert H.rungs(768, 2, 500) == [(768, 2), (256, 2), (86, 6), (29, 18), (10, 54), (4, 162), (2, 486)]
    assert len(H.grid(depth=range(1, 17), gamma=range(1, 17), rate=[0.01, 0.5, 1.0])) == 768


def shapley(value, players):
    """Shapley values by definition."""
    out, n = {}, len(players)
    for p in players:
        rest = [q for q in players if q != p]
        out[p] = sum(
            math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (value({*s, p}) - value(set(s)))
            for r in range(n) for s in itertools.combinations(rest, r)
        )
    return out


@pytest.mark.parametrize("part, rows, held", [(200_000, 1024, 1_000_000), (7, 2, 20)])
def test_contributions_equal_shapley_values_of_the_margin(spark, data, monkeypatch, part, rows, held):
    """Whether patterns, rows and partial counts lie in one piece or in many."""
    for name, value in (("PART", part), ("ROWS", rows), ("HELD", held), ("SEEN", 30), ("LEAVES", 5)):
        monkeypatch.setattr(contributions, name, value)
    pdf, df = data
    train = df.where("id < 200")
    model = G.boosted_forest(train, df.where("id >= 500"), "y", rounds=2, trees=3, depth=3, min_child_weight=2.0)
    told = tree_contributions(df.where("id IN (300, 301, 302, 303, 304)"), ["id"], train, model, ["a", "b", "c"], flip=False)
    back = np.stack(pdf["f"][:200].to_numpy())
    base = model.margin(back).mean()
    mean_prob = (1 / (1 + np.exp(-model.margin(back)))).mean()
    found = told.collect()
    assert len(found) == 5
    for row in found:
        x = pdf["f"][row["id"]]

        def value(known):
            mixed = back.copy()
            mixed[:, list(known)] = x[list(known)]
            return model.margin(mixed).mean()

        want = shapley(value, [0, 1, 2])
        got = [c["value"] for c in row["contributions"]]
        f = model.margin(x[None, :])[0]
        p = 1 / (1 + math.exp(-f))
        scale = (p - mean_prob) / (f - base)
        assert got == pytest.approx([want[i] * scale for i in range(3)], abs=1e-9)
        assert sum(got) + row["base"] == pytest.approx(p) == row["prob"]


def test_explained_probability_is_the_models(data):
    _, df = data
    model = G.boosted_forest(df, df, "y", rounds=2, trees=4, depth=3, min_child_weight=2.0)
    told = tree_contributions(df, ["id"], df, model, ["a", "b", "c"]).select("id", F.col("prob").alias("told"))
    gap = told.join(model.transform(df), "id").agg(F.max(F.abs(F.col("told") - F.col("prob"))), F.count("*")).first()
    assert gap[0] < 1e-9 and gap[1] == 600


def test_leaf_effects_on_long_paths():
    """Twelve conditions on a path, against Shapley values by definition."""
    rng = np.random.default_rng(6)
    slots, full = 12, (1 << 12) - 1
    back = full ^ (1 << rng.integers(0, 12, 6)) ^ (1 << rng.integers(0, 12, 6))
    row = full ^ 0b100100000001
    for b in back.tolist():
        got = contributions.leaf_effects(np.array([row]), np.array([b]), np.array([2.0]), slots)[0]
        value = lambda known: 2.0 * all((row if s in known else b) >> s & 1 for s in range(slots))
        want = shapley(value, list(range(slots)))
        assert got.tolist() == pytest.approx([want[s] for s in range(slots)], abs=1e-12)
