"""Neighbour operators against brute force, with copies, hot vectors, many blocks and two-level routing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import neighbors as N


def brute(keys, x, k, metric):
    """{key: [(nbr, dist), ...]} by full distance matrices."""
    order = np.argsort(keys, kind="stable")
    keys, x = np.asarray(keys)[order], x[order]
    gaps = x[:, None, :] - x[None, :, :]
    d = np.zeros(gaps.shape[:2])
    for j in range(x.shape[1]):
        d += np.abs(gaps[:, :, j]) if metric == "mean_abs" else gaps[:, :, j] ** 2
    d = d / x.shape[1] if metric == "mean_abs" else np.sqrt(d)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, : min(k, len(keys) - 1)]
    return {keys[i]: [(keys[j], d[i, j]) for j in near[i]] for i in range(len(keys))}


def brute_lof(keys, x, k, metric):
    near = brute(keys, x, k, metric)
    kdist = {a: max(d for _, d in e) for a, e in near.items()}
    lrd = {a: 1 / (np.mean([max(kdist[b], d) for b, d in e]) + N.LOF_EPSILON) for a, e in near.items()}
    return {a: np.mean([lrd[b] for b, _ in e]) / lrd[a] for a, e in near.items()}


def table(n, copies, seed=0, names=False):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, 3)), 2)
    x[:copies] = x[0]
    keys = rng.permutation(n)
    return pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, "a", "b"),
                         "key": [f"k{i:05d}" for i in keys] if names else keys, "v": list(x)})


def found(df):
    pdf = df.toPandas().sort_values(["key", "rank"])
    return {k: list(zip(p["nbr"], p["dist"])) for k, p in pdf.groupby("key")}


@pytest.mark.parametrize("metric", ["euclidean", "mean_abs"])
@pytest.mark.parametrize("block, fan", [(1024, 256), (32, 256), (32, 6), (24, 3)])
@pytest.mark.parametrize("copies", [0, 300])
def test_knn_is_exact(spark, monkeypatch, metric, block, fan, copies):
    """In one block, under one node, and with directories of two, three and more levels."""
    monkeypatch.setattr(N, "BLOCK_ROWS", block)
    monkeypatch.setattr(N, "FAN", fan)
    pdf = table(900, copies, names=metric == "mean_abs")
    if not copies:
        pdf["v"] = [np.append(v, i / 7.0) for i, v in enumerate(pdf["v"])]
    got = found(N.knn(spark.createDataFrame(pdf), "key", "v", 4, metric, ["g"]))
    for _, part in pdf.groupby("g"):
        want = brute(part["key"].to_numpy(), np.stack(part["v"].to_numpy()), 4, metric)
        assert all(got[k] == [(b, pytest.approx(d)) for b, d in want[k]] for k in want)


def clusters(n, width, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(16, width))
    return centres[rng.integers(0, 16, n)] + 0.05 * rng.normal(size=(n, width))


@pytest.mark.parametrize("metric", ["euclidean", "mean_abs"])
def test_many_dimensions_ship_few_rows(spark, monkeypatch, metric):
    """Vectors of 64 columns in clusters: exact, and most blocks are never asked."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 32)
    monkeypatch.setattr(N, "FAN", 4)
    shipped = []
    kept = N._probes
    monkeypatch.setattr(N, "_probes", lambda *a: shipped.append(kept(*a)) or shipped[-1])
    x = clusters(1500, 64)
    df = spark.createDataFrame(pd.DataFrame({"key": range(1500), "v": list(x)}))
    got = found(N.knn(df, "key", "v", 5, metric))
    want = brute(np.arange(1500), x, 5, metric)
    assert all([b for b, _ in got[k]] == [b for b, _ in want[k]] for k in want)
    rows = sum(len(r["keys"]) for r in shipped[0].select("keys").collect())
    assert rows < 0.15 * 1500 * 1500 / 32  # of all rows to all blocks


def test_a_null_group_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    monkeypatch.setattr(N, "FAN", 4)
    x = np.random.default_rng(3).random((300, 2))
    df = spark.createDataFrame(pd.DataFrame({"g": [None if i % 2 else "a" for i in range(300)], "key": range(300), "v": list(x)}), "g string, key long, v array<double>")
    edges = N._probes  # the group's probes reach their own blocks only
    sites = df.select("g", "key", F.col("v").alias("vec"))
    blocks = N._blocks(sites, ["g"], 2, "euclidean", 3, False, N._grid_order(sites, "vec", 2), x[:5])
    probes = edges(blocks, blocks, ["g"], 2, "euclidean", 3, True, df.schema["key"].dataType, x[:5])
    of = {r["block"]: r["g"] for r in blocks.select("g", "block").collect()}
    reached = probes.select("g", "block", "target").collect()
    assert reached and all(of[r["block"]] == of[r["target"]] == r["g"] for r in reached) and {r["g"] for r in reached} == {None, "a"}


def test_bounds_by_pivots_hold():
    rng = np.random.default_rng(7)
    for metric in ("euclidean", "mean_abs"):
        x, y, pivots = rng.normal(size=(40, 9)), rng.normal(size=(60, 9)) * 2, rng.normal(size=(5, 9))
        far = N._distances(y, pivots, metric)
        low = N._apart(N._distances(x, pivots, metric), far.min(axis=0)[None], far.max(axis=0)[None])
        assert (low[:, 0] <= N._distances(x, y, metric).min(axis=1)).all()


def test_small_groups(spark):
    pdf = pd.DataFrame({"g": ["a", "b", "b"], "key": [1, 2, 3], "v": [[0.0], [0.0], [2.0]]})
    got = found(N.knn(spark.createDataFrame(pdf), "key", "v", 5, "euclidean", ["g"]))
    assert got == {2: [(3, 2.0)], 3: [(2, 2.0)]}
    masks = {r["key"]: r["mask"] for r in N.lof(spark.createDataFrame(pdf), "key", "v", 20, "mean_abs", ["g"]).collect()}
    assert masks == {1: 1, 2: 1, 3: 1}


def test_constant_columns_and_equal_rows_are_at_distance_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 1.0), (3, 5.0, 3.0)], "key int, a double, b double")
    got = found(N.gower_neighbours(df, "key", ["a", "b"], 2))
    assert got[1] == [(2, 0.0), (3, 0.5)] and got[3] == [(1, 0.5), (2, 0.5)]


@pytest.mark.parametrize("copies, hot_share", [(0, 1024), (200, 1024), (200, 10**9)])
def test_lof_matches_brute_force(spark, monkeypatch, copies, hot_share):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    monkeypatch.setattr(N, "HOT_SHARE", hot_share)  # a huge share treats every site and every edge end as hot
    pdf = table(600, copies, seed=3)
    pdf.at[599, "v"] = np.array([9.0, 9.0, 9.0])
    got = {r["key"]: r for r in N.lof(spark.createDataFrame(pdf), "key", "v", 20, "mean_abs", ["g"]).collect()}
    for _, part in pdf.groupby("g"):
        for key, factor in brute_lof(part["key"].to_numpy(), np.stack(part["v"].to_numpy()), 20, "mean_abs").items():
            assert got[key]["lof"] == pytest.approx(factor, rel=1e-9)
            assert got[key]["mask"] == (-1 if factor > N.LOF_CUT else 1)
    assert got[pdf["key"][599]]["mask"] == -1


def test_outliers_are_split_without_loss(spark):
    pdf = table(300, 0, seed=5)
    pdf.at[0, "v"] = np.array([50.0, 50.0, 50.0])
    wide = pd.DataFrame(np.stack(pdf["v"].to_numpy()), columns=["a", "b", "c"]).assign(key=pdf["key"], g=pdf["g"])
    kept, removed = N.remove_outliers(spark.createDataFrame(wide), "key", ["a", "b", "c"], 20, ["g"])
    gone = {r["key"] for r in removed.collect()}
    assert pdf["key"][0] in gone and kept.count() + len(gone) == 300


def links(spark, rows):
    df = spark.createDataFrame([(k, y, [x]) for k, y, x in rows], "key int, y int, v array<double>")
    return df, {(r["a"], r["b"]) for r in N.tomek_links(df, "key", "v", "y").collect()}


def test_tomek_needs_mutual_neighbours_of_opposite_label(spark):
    assert links(spark, [(1, 0, 0.0), (2, 1, 1.0), (3, 0, 9.0), (4, 0, 9.5)])[1] == {(1, 2)}
    assert links(spark, [(1, 0, 0.0), (2, 0, 1.0), (3, 1, 9.0), (4, 1, 9.5)])[1] == set()
    # 1 is nearest to 2, but 2 is nearer to 3 of the same label
    assert links(spark, [(1, 0, 0.0), (2, 1, 1.0), (3, 1, 1.5)])[1] == set()
    # a tie goes to the lower key
    assert links(spark, [(1, 1, 0.0), (2, 0, 1.0), (3, 1, 2.0)])[1] == {(1, 2)}


def test_tomek_strategies(spark):
    df, _ = links(spark, [(1, 0, 0.0), (2, 1, 1.0), (3, 0, 9.0), (4, 0, 9.5)])
    kept, removed = N.tomek_undersample(df, "key", "v", "y", "all")
    assert {r["key"] for r in kept.collect()} == {3, 4} and {r["key"] for r in removed.collect()} == {1, 2}
    kept, _ = N.tomek_undersample(df, "key", "v", "y", "auto")
    assert {r["key"] for r in kept.collect()} == {2, 3, 4}


def test_nearest_between_two_tables(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    a, b = np.round(rng.random((150, 2)), 2), np.round(rng.random((200, 2)), 2)
    b[:60] = b[0]
    qa = spark.createDataFrame(pd.DataFrame({"key": range(150), "v": list(a)}))
    tb = spark.createDataFrame(pd.DataFrame({"key": range(1000, 1200), "v": list(b)}))
    pdf = N.knn_between(N.Sites(qa, "key", "v", [], 3), N.Sites(tb, "key", "v", [], 3)).toPandas().sort_values(["key", "dist", "nbr"])
    got = {k: list(p["nbr"]) for k, p in pdf.groupby("key")}
    for i in range(150):
        d = np.sqrt((a[i, 0] - b[:, 0]) ** 2 + (a[i, 1] - b[:, 1]) ** 2)
        assert got[i] == [1000 + j for j in np.argsort(d, kind="stable")[:3]]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "g string, key long, v array<double>, y int")
    assert N.knn(df, "key", "v", 3, "euclidean", ["g"]).count() == 0
    assert N.lof(df, "key", "v", 3, "mean_abs", ["g"]).count() == 0
    assert N.tomek_undersample(df, "key", "v", "y", "auto", ["g"])[0].count() == 0
