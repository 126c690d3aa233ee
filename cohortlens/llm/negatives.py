"""Hard negatives by a multiway hyperplane tree with distance ranges between siblings.

A tree of split points is fitted on a bounded sample (``SAMPLE`` rows): each node has up to ``FAN`` points, far from one
another, and a vector goes to the child of the nearest. Every row is then put into its leaf, and for each split point and
each sibling subtree the least and the greatest distance to all rows below it are kept (Spark aggregates them; their
number is that of the sample's nodes, whatever the table). A query is a window of scores. With the norms in a subtree,
its scores give an annulus of distances; a subtree goes where, for some split point, the distances that the triangle
inequality allows miss the annuli of all windows. What is left are leaves, whose scores are exact integers.

An anchor's positives come from the window above the fifth best score in its own leaf; the window of a positive's
negatives reaches from a share of its score to the score. Both are first asked in the own leaf, which raises the lower
end. Leaves are packed into cells of about ``CELL`` rows; larger leaves are dealt to several cells, anchors that visit a
cell to chunks of ``CHUNK``, so that no task holds a leaf of copies or all anchors.

Defined cases: rows with a null id, label or vector, or null, NaN or infinite components take no part; vectors of
different length are not compared; repeated rows are rows of their own, and an anchor's copy may be its positive; equal
scores go to the smaller id; scores beyond 64 bits are shown as the limit; an anchor without positives, or whose
positives score below zero, has no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .topk import LONG, products

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE, FAN, LEAF = 8_192, 8, 96  # rows the tree is fitted on, children of a node, sample rows of a leaf
CELL, CHUNK, TILE = 16_384, 1_024, 64
EXACT = 2.0**53
LOW = -LONG


def matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


class Tree:
    """Nodes as (points, children); a child is a node's number, or a leaf's as -1 - leaf. No node: one leaf."""

    def __init__(self, sample: np.ndarray):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.leaves = 0
        self.root = self.grow(sample)

    def grow(self, x: np.ndarray) -> int:
        picked = self.spread(x) if len(x) > LEAF else []
        if len(picked) < 2:
            self.leaves += 1
            return -self.leaves
        number, points = len(self.nodes), x[picked]
        self.nodes.append((points, []))
        home = distances(x, points).argmin(1)
        self.nodes[number][1].extend(self.grow(x[home == c]) for c in range(len(points)))
        return number

    @staticmethod
    def spread(x: np.ndarray) -> list[int]:
        """Up to ``FAN`` rows, each the farthest from those before."""
        picked = [0]
        near = distances(x, x[:1])[:, 0]
        while len(picked) < FAN and near.max(initial=0) > 0 and int(near.argmax()) not in picked:
            picked.append(int(near.argmax()))
            near = np.minimum(near, distances(x, x[picked[-1:]])[:, 0])
        return picked

    def descend(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, its rows of x, their distances to its points, the child each goes to) from the root down."""
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            if number < 0 or not len(rows):
                continue
            points, children = self.nodes[number]
            d = distances(x[rows], points)
            home = d.argmin(1)
            yield number, rows, d, home
            todo += [(child, rows[home == c]) for c, child in enumerate(children)]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), np.int64)
        for number, rows, _, home in self.descend(x):
            child = np.array(self.nodes[number][1])[home]
            leaf[rows[child < 0]] = -1 - child[child < 0]
        return leaf

    def alive(self, x: np.ndarray, low: list[np.ndarray], high: list[np.ndarray], ranges: dict, norms: dict) -> np.ndarray:
        """(queries, leaves): whether a leaf may hold a score in a window. ``norms`` has the squared norms' ends by child."""
        out = np.zeros((len(x), self.leaves), bool)
        own = (x * x).sum(1)
        each = np.array([len(w) for w in low])
        owner = np.repeat(np.arange(len(x)), each)
        lo, hi = (np.concatenate(w).astype(np.float64) if len(owner) else np.zeros(0) for w in (low, high))
        lo[lo <= LOW], hi[hi >= LONG] = -np.inf, np.inf
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            if not len(rows):
                continue
            if number < 0:
                out[rows, -1 - number] = True
                continue
            points, children = self.nodes[number]
            d = distances(x[rows], points)
            place = np.full(len(x), -1)
            place[rows] = np.arange(len(rows))
            mine = place[owner] >= 0
            window, of = np.flatnonzero(mine), place[owner[mine]]
            for c, child in enumerate(children):
                if (number, c) not in norms:
                    continue  # no row went there
                least, most = norms[number, c]
                near, far = ranges[number, c]  # by split point
                slack = 1e-6 * (1 + np.sqrt(own[rows]) + np.sqrt(most))
                from_ = np.maximum(d - far, near - d).max(1) - slack
                to = (d + far).min(1) + slack
                inner = own[owner[window]] + least - 2 * hi[window]
                outer = own[owner[window]] + most - 2 * lo[window]
                inner, outer = np.sqrt(np.maximum(inner, 0)), np.where(outer < 0, -np.inf, np.sqrt(np.maximum(outer, 0)))
                miss = (from_[of] > outer + slack[of]) | (to[of] < inner - slack[of])
                stay = np.zeros(len(rows), bool)
                stay[of[~miss]] = True
                todo.append((child, rows[stay]))
        return out


def fitted(rows: DataFrame) -> dict[int, Tree]:
    """A tree for each length of vector in the sample."""
    picked = rows.select("dim", "v", F.xxhash64("id", "row").alias("h"), "row").orderBy("h", "row").limit(SAMPLE).collect()
    of: dict[int, list] = {}
    for r in picked:
        of.setdefault(r["dim"], []).append(r["v"])
    return {dim: Tree(np.array(held, np.float64).reshape(len(held), dim)) for dim, held in of.items()}


def placed(rows: DataFrame, trees) -> DataFrame:
    """``rows`` with the leaf of each."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, leaf = b.column("dim").to_numpy(), np.zeros(b.num_rows, np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim in trees.value:
                    leaf[at] = trees.value[dim].leaf_of(matrix(b.column("v").take(pa.array(at))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], [*b.schema.names, "leaf"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(assign, f"{kinds}, leaf long")


def range_table(rows: DataFrame, trees) -> DataFrame:
    """By length of vector, node, child and split point: the ends of the distances, and of the child's squared norms."""
    names = ["dim", "node", "child", "point", "near", "far", "least", "most"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in trees.value:
                    continue
                x = matrix(b.column("v").take(pa.array(np.flatnonzero(dims == dim))))
                square = (x * x).sum(1)
                for node, at, d, home in trees.value[dim].descend(x):
                    for c in np.unique(home).tolist():
                        mine = home == c
                        new = d[mine].min(0), d[mine].max(0), square[at[mine]].min(), square[at[mine]].max()
                        old = held.get((dim, node, c))
                        held[dim, node, c] = new if old is None else [f(u, v) for f, u, v in zip((np.minimum, np.maximum, min, max), old, new)]
        out = [(*k, i, float(near[i]), float(far[i]), float(least), float(most)) for k, (near, far, least, most) in held.items() for i in range(len(near))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    parts = rows.select("dim", "v").mapInArrow(measure, "dim long, node long, child long, point long, near double, far double, least double, most double")
    return parts.groupBy("dim", "node", "child", "point").agg(
        F.min("near").alias("near"), F.max("far").alias("far"), F.min("least").alias("least"), F.max("most").alias("most"))


def packed(counts: list) -> dict[tuple[int, int], tuple[int, int]]:
    """(dim, leaf) to its first cell and number of cells: small leaves share one, large ones have several."""
    cells, cell, size, last = {}, 0, 0, None
    for dim, leaf, n in sorted(map(tuple, counts)):
        if size + n > CELL or dim != last:
            cell, size = cell + 1, 0
        parts = -(-n // CELL)
        cells[dim, leaf] = cell, parts
        cell, size, last = cell + parts - 1, size + n if parts == 1 else CELL, dim
    return cells


class Index:
    """Rows in leaves, in the shared folder, with what the driver knows of them: the tree and its ranges."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        self.trees = self.spark.sparkContext.broadcast(fitted(rows))
        self.rows = settle(placed(rows, self.trees), "leaves")
        ranges: dict = {}
        norms: dict = {}
        for r in range_table(self.rows, self.trees).orderBy("point").collect():
            at = r["node"], r["child"]
            near, far = ranges.setdefault(r["dim"], {}).setdefault(at, ([], []))
            near.append(r["near"])
            far.append(r["far"])
            norms.setdefault(r["dim"], {})[at] = r["least"], r["most"]
        ranges = {dim: {at: (np.array(a), np.array(z)) for at, (a, z) in of.items()} for dim, of in ranges.items()}
        self.ranges = self.spark.sparkContext.broadcast((ranges, norms))
        self.cells = packed(self.rows.groupBy("dim", "leaf").count().collect())
        table = self.spark.createDataFrame([(*k, *v) for k, v in self.cells.items()], "dim int, leaf long, cell long, parts long")
        # a row for each leaf of a tree of fixed size
        cell = F.col("cell") + F.pmod(F.xxhash64("row"), F.col("parts"))
        self.points = settle(self.rows.join(F.broadcast(table), ["dim", "leaf"]).withColumn("cell", cell).drop("parts"), "cells")

    def visits(self, asked: DataFrame, own: bool) -> DataFrame:
        """``asked`` (row, dim, v, leaf, low, high, ...) once for each cell to visit, with the leaves there."""
        cells, trees, shared = self.cells, self.trees, self.ranges

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ranges, norms = shared.value
            for b in batches:
                dims, home = b.column("dim").to_numpy(), b.column("leaf").to_numpy()
                for dim in np.unique(dims).tolist():
                    part = b.take(pa.array(np.flatnonzero(dims == dim)))
                    low, high = part.column("low").to_pylist(), part.column("high").to_pylist()
                    if own or dim not in trees.value:
                        lists = [[leaf] for leaf in home[dims == dim].tolist()]
                    else:
                        with np.errstate(all="ignore"):
                            alive = trees.value[dim].alive(matrix(part.column("v")), low, high, ranges.get(dim, {}), norms.get(dim, {}))
                        lists = [np.flatnonzero(a).tolist() for a in alive]
                    at, cell, leaves = [], [], []
                    for i, some in enumerate(lists):
                        to: dict[int, list[int]] = {}
                        for leaf in some:
                            first, parts = cells.get((dim, leaf), (0, 0))
                            for c in range(first, first + parts):
                                to.setdefault(c, []).append(leaf)
                        at += [i] * len(to)
                        cell += to
                        leaves += to.values()
                    picked = part.take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(cell, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], [*b.schema.names, "cell", "leaves"])

        kinds = ", ".join(f"{n} {t}" for n, t in asked.dtypes)
        return asked.mapInArrow(route, f"{kinds}, cell long, leaves array<bigint>")

    def search(self, asked: DataFrame, same: bool, k: int, own: bool = False) -> DataFrame:
        """row, window, rank, other, other_id, score: the ``k`` best rows in each window of ``asked``, of the row's label or of others."""
        visits = settle(self.visits(asked, own), "visits")
        chunks = visits.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
        every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
        shown = ["cell", "chunk", "row", "id", "label", "v", "leaf", "low", "high", "leaves"]
        points = self.points.join(chunks, "cell").select("*", every)
        points = points.withColumn("low", F.lit(None).cast("array<bigint>")).withColumn("high", F.lit(None).cast("array<bigint>")).withColumn(
            "leaves", F.lit(None).cast("array<bigint>"))
        callers = visits.join(chunks, "cell").withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))

        def answer(t: pa.Table) -> pa.Table:
            t = t.combine_chunks()
            asks = t.column("leaves").is_valid().to_numpy()
            points, callers = t.filter(pa.array(~asks)), t.filter(pa.array(asks))
            out = score_cell(points, callers, same, k) if len(points) and len(callers) else [[]] * 5
            return pa.table([pa.array(c, pa.int64()) for c in out], ["row", "window", "other", "other_id", "score"])

        cells = points.select(*shown).unionByName(callers.select(*shown))
        hits = cells.groupBy("cell", "chunk").applyInArrow(answer, "row long, window long, other long, other_id long, score long")
        order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "other_id", "other")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def score_cell(points: pa.Table, callers: pa.Table, same: bool, k: int) -> list[list[int]]:
    """The ``k`` best rows of a cell in each window of each caller."""
    x, q = (matrix(t.column("v").chunk(0)) for t in (points, callers))
    ids, rows, labels, leaf = (points.column(c).to_numpy() for c in ("id", "row", "label", "leaf"))
    own, mine = callers.column("row").to_numpy(), callers.column("label").to_numpy()
    low, high, leaves = (callers.column(c).to_pylist() for c in ("low", "high", "leaves"))
    wide = x.shape[1] and float(np.abs(q).max()) * float(np.abs(x).max()) * x.shape[1] >= EXACT
    out: list[list[int]] = [[] for _ in range(5)]
    for i in range(0, len(q), TILE):
        some = range(i, min(i + TILE, len(q)))
        if wide:
            a, b = np.repeat(np.array(some), len(x)), np.tile(np.arange(len(x)), len(some))
            scores = products(q, x, a, b).reshape(len(some), -1)
        else:
            scores = (q[i : i + TILE] @ x.T).astype(np.int64)
        for j, s in zip(some, scores):
            if not low[j]:
                continue
            fits = (labels == mine[j] if same else labels != mine[j]) & (rows != own[j]) & (s >= min(low[j])) & (s <= max(high[j])) & np.isin(leaf, leaves[j])
            at = np.flatnonzero(fits)
            at = at[np.lexsort((rows[at], ids[at], -s[at]))]
            falling = -s[at]
            for w, (lo, hi) in enumerate(zip(low[j], high[j])):
                begin = int(np.searchsorted(falling, -hi, "left"))
                top = at[begin : min(begin + k, int(np.searchsorted(falling, -lo, "right")))]
                for c, values in zip(out, ([own[j]] * len(top), [w] * len(top), rows[top], ids[top], s[top])):
                    c.extend(int(v) for v in values)
    return out


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row that ``is_anchor`` selects and each of its best other rows of its label, the best rows of other
    labels that score at least ``percent`` of the positive and not above it.
    """
    whole = F.forall(F.col(f"`{vector}`"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull() & F.col(f"`{vector}`").isNotNull()).where(whole)
    v = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    if dict(vectors.dtypes)[vector] not in ("array<float>", "array<double>"):
        raise TypeError(f"{vector} must hold floats")
    named = usable.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                          is_anchor.alias("asks"), F.size(vector).alias("dim"), v.alias("v"))
    index = Index(settle(named, "vectors"))
    anchors = index.rows.where("asks").select("row", "id", "label", "dim", "v", "leaf")

    def windows(asked: DataFrame, low: Column, high: Column) -> DataFrame:
        return asked.withColumn("low", low).withColumn("high", high).select("row", "id", "label", "dim", "v", "leaf", "low", "high")

    def raised(asked: DataFrame, same: bool, k: int) -> DataFrame:
        """``asked`` with each window's low end at the k-th best score in the row's own leaf."""
        first = index.search(asked, same, k, own=True).where(F.col("rank") == k)
        floors = first.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floor"))
        at = F.transform("low", lambda lo, w: F.greatest(lo, F.try_element_at("floor", w.cast("long"))))
        joined = asked.join(floors, "row", "left")
        return settle(joined.withColumn("low", F.when(F.col("floor").isNull(), F.col("low")).otherwise(at)).drop("floor"), "windows")

    everything = windows(anchors, F.array(F.lit(LOW)), F.array(F.lit(LONG)))
    best = settle(index.search(raised(everything, True, positives), True, positives).select(
        "row", F.col("rank").alias("nth"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    floor = F.ceil(F.col("positive_score").cast("decimal(20,0)") * percent / 100).cast("long")
    some = best.where("positive_score >= 0").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("nth", floor.alias("low"), F.col("positive_score").alias("high")))).alias("w"))
    pairs = windows(anchors.join(some, "row"), F.col("w.low"), F.col("w.high"))
    found = index.search(raised(pairs, False, negatives), False, negatives)
    # windows are numbered in the order of their positives
    order = Window.partitionBy("row").orderBy("nth")
    numbered = best.where("positive_score >= 0").withColumn("window", (F.row_number().over(order) - 1).cast("long"))
    out = found.join(numbered, ["row", "window"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))
