"""Vectors that hardly cluster reach most blocks, but travel only once to a bundle of them."""

import numpy as np

from cohortlens.operators import neighbors as N


def test_sites_travel_to_few_bundles(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 8)
    x = np.random.default_rng(5).normal(size=(480, 20))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    shipped, kept = [], N._probes
    monkeypatch.setattr(N, "_probes", lambda *a: shipped.append(kept(*a)) or shipped[-1])
    got = {(r["id"], r["rank"]): (r["nbr"], r["dist"]) for r in N.knn(df, "id", "x", 3).collect()}
    assert sum(len(r["keys"]) for r in shipped[0].select("keys").collect()) <= 16 * len(x)
    dist = N._distances(x, x, "euclidean")
    np.fill_diagonal(dist, np.inf)
    order = np.argsort(dist, axis=1, kind="stable")[:, :3]
    assert got == {(i, r + 1): (int(j), float(dist[i, j])) for i in range(len(x)) for r, j in enumerate(order[i])}


def test_products_of_matrices_lose_no_pair():
    x = np.random.default_rng(6).normal(size=(300, 24)) + 1000.0
    x[200:] = x[:100]  # copies, at distance zero
    real = N._distances(x, x, "euclidean")
    theta = np.sort(real, axis=1)[:, 4]
    assert np.array_equal(N._close(x, x, theta, "euclidean"), np.where(real <= theta[:, None], real, np.inf))
