"""Sites of another table are sent with a bound from a near block, not with the far corners of boxes."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortlens.operators import neighbors as N


def test_few_sites_travel_in_many_columns(spark, monkeypatch):
    """Clusters in ten columns, copies among them, more neighbours asked for than small groups have."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 32)
    monkeypatch.setattr(N, "FAN", 6)
    rng = np.random.default_rng(5)
    x = rng.random((30, 10))[rng.integers(0, 30, 1230)] + rng.normal(0, 0.02, (1230, 10))
    x[900:940] = x[900]
    pdf = pd.DataFrame({"g": ["a"] * 1220 + [None] * 10, "key": rng.permutation(1230), "v": list(x)})
    asked, given = pdf.iloc[list(range(200)) + [1220, 1221]], pdf.iloc[list(range(200, 1220)) + list(range(1222, 1230))]
    sent = []
    probes = N._probes

    def counted(*args, **kwargs):
        out = probes(*args, **kwargs)
        sent.append(out.agg(F.sum(F.size("keys"))).first()[0])
        return out

    monkeypatch.setattr(N, "_probes", counted)
    sites = [N.Sites(spark.createDataFrame(p, "g string, key long, v array<double>"), "key", "v", ["g"], 9) for p in (asked, given)]
    got = N.knn_between(*sites).toPandas()
    assert len(got) == 200 * 9 + 2 * 8
    for _, row in asked.iterrows():
        pool = given[given["g"].isna() if row["g"] is None else given["g"] == row["g"]].sort_values("key")
        d = np.sqrt(((np.stack(pool["v"]) - row["v"]) ** 2).sum(1))
        order = np.argsort(d, kind="stable")[:9]
        mine = got[got["key"] == row["key"]]
        assert set(mine["nbr"]) == set(pool["key"].to_numpy()[order])
        assert np.allclose(np.sort(mine["dist"]), d[order])
    print("sites sent", sent)
    assert sum(sent) < 200 * 40 / 2  # there are about 40 blocks
