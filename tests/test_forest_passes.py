"""Passes of boosted forests over large tables: few trees are evaluated again, and whole columns at a time."""

import numpy as np

from cohortlens.models import boosting as B
from cohortlens.operators.features import assemble


def test_margins_of_large_tables_are_written_every_other_round(spark, monkeypatch):
    rows = spark.range(400).selectExpr("id % 7 AS a", "id % 11 AS b", "CAST(id % 3 = 0 OR id % 7 > 4 AS INT) AS y")
    df = assemble(["a", "b"]).transform(rows)
    settings = {"rounds": 4, "trees": 2, "depth": 2, "min_child_weight": 1.0, "subsample": 1.0, "gamma": 0.0}
    seldom = B.boosted_forest(df, None, "y", **settings)
    written, kept = [], B.rewritten
    monkeypatch.setattr(B, "LARGE", 100)
    monkeypatch.setattr(B, "rewritten", lambda table, groups: written.append([len(g.done) for g in groups.values()]) or kept(table, groups))
    often = B.boosted_forest(df, None, "y", **settings)
    assert written[:2] == [[2], [4]]
    assert [n[:7] for n in often.rows()] == [n[:7] for n in seldom.rows()] and len(often.rows()) > 8
    assert np.allclose([n[7] for n in often.rows()], [n[7] for n in seldom.rows()])


def test_folded_and_walked_trees_end_in_the_same_leaves(monkeypatch):
    rng = np.random.default_rng(3)
    tree = B.Growing(np.arange(3))
    for node in range(12):  # lopsided: a child of the last node, its sibling a leaf
        at = len(tree.value) - 1 - node % 2
        tree.feature[at], tree.split[at] = node % 3, float(rng.integers(-5, 5)) + 0.5
        tree.left[at], tree.right[at] = tree.child(1.0), tree.child(2.0)
    forest = B.Round.of([tree, B.Growing(np.arange(3))])
    x = rng.integers(-9, 9, (3, 500)).astype(float)
    x[1, 7] = np.nan
    folded = [forest.leaves(x, t).tolist() for t in (0, 1)]
    monkeypatch.setattr(B, "FOLDED", -1)
    assert folded == [forest.leaves(x, t).tolist() for t in (0, 1)]
    assert len(set(folded[0])) > 3 and set(folded[1]) == {0}
