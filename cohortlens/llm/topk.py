"""Exact top-k inner products by multi-resolution segment statistics.

Vectors are cut into equal segments, coarse then fine. With a segment's mean m and deviation s over its length L,
|q - x|^2 is at least the sum of L ((mq - mx)^2 + (sq - sx)^2), and since |x|^2 is the sum of L (m^2 + s^2) that bound on
the distance is an upper bound on the inner product, the sum of L (mq mx + sq sx). Per cell the best candidates of the
coarse bound give each query a first k-th score; candidates whose coarse, then fine bound lies below it are left out
and the survivors' products are exact integers.

Points lie in cells by the nearest of some sample rows in the coarse statistics; a cell of very many points, or of
copies, has several parts. Of each cell the ends of all statistics are kept, so that a query's bound for the whole cell
is known before any of its points is read. A query is first asked in its most promising cells, which gives it a k-th
score, and then only where the cell's bound reaches that score. Queries travel to points, in chunks; points stay in their
cells. The number of cells is limited by the sample, so their table is of fixed size but for a row per length of vector.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part, nor do null ids; rows that
share an id are rows of their own, as queries too, and one may be found by the other; vectors of different length are not compared; empty vectors score
0 with one another; products beyond 64 bits are shown as the limit, and
components beyond a double's as the largest double; an empty table gives an empty result.
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

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE, VALUES, CHUNK = 8_192, 1 << 19, 8_192  # rows that cells are fitted on, components in a part of a cell, queries at once
TILE, PAIRS, ROUTES = 128, 200_000, 20_000
DENSE = 32  # a product of its own costs about as much as so many in one multiplication of matrices
SEGMENTS = (4, 16)
LONG = 2**63 - 1


def features(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(L) times mean and deviation of each segment; the product of two rows bounds their inner product."""
    cuts = np.array_split(np.arange(x.shape[1]), max(1, min(segments, x.shape[1])))
    cols = [(np.sqrt(len(c)) * x[:, c].mean(1), np.sqrt(len(c)) * x[:, c].std(1)) for c in cuts if len(c)]
    return np.stack([v for pair in cols for v in pair], 1) if cols else np.zeros((len(x), 1))


def quantise(lists: pa.Array) -> np.ndarray:
    """floor(1024 x) of all components, as whole numbers in doubles."""
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(1024 * x))


def best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: higher score, then smaller id."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    begin = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
    rank = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q))))
    return order[rank < k]


def is_wide(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether an inner product may be beyond what doubles hold exactly."""
    return bool(len(q) and len(x) and q.shape[1] and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] >= 2**53)


def products(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    wide = is_wide(q, x)
    for i in range(0, len(a), PAIRS):
        u, v = q[a[i : i + PAIRS]], x[b[i : i + PAIRS]]
        if wide:  # too large for doubles: whole numbers of any size, cut to 64 bits at the end
            out[i : i + PAIRS] = [max(-LONG, min(LONG, sum(int(s) * int(t) for s, t in zip(p, r)))) for p, r in zip(u, v)]
        else:
            out[i : i + PAIRS] = np.einsum("ij,ij->i", u, v).astype(np.int64)
    return out


def slack_of(q: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What rounding may take from a bound, by query and vector (or cell) of that norm."""
    return 1e-9 * (1 + np.sqrt((q * q).sum(1)))[:, None] * (1 + norm)[None, :]


def search_cell(q_rows, q, floor, x_rows, x_ids, x, k: int):
    """(query's row, point's place, score) of the k best points of each query in one cell that reach its ``floor``."""
    levels = [(features(q, s), features(x, s)) for s in SEGMENTS]
    slack = slack_of(q, np.sqrt((x * x).sum(1)).max(initial=0.0, keepdims=True))
    found = []
    for i in range(0, len(q), TILE):
        rows = slice(i, i + TILE)
        coarse = np.nan_to_num(levels[0][0][rows] @ levels[0][1].T + slack[rows], nan=np.inf, posinf=np.inf)
        coarse[q_rows[rows][:, None] == x_rows[None, :]] = -np.inf
        n = len(coarse)
        least = floor[rows].copy()
        if len(x) > k:
            first = np.argpartition(coarse, len(x) - k, axis=1)[:, len(x) - k :]
            a = np.repeat(np.arange(n), k)
            scores = products(q[rows], x, a, first.ravel()).reshape(n, k).astype(np.float64)
            scores[np.take_along_axis(coarse, first, 1) == -np.inf] = -np.inf
            least = np.maximum(least, scores.min(1))
        least[least <= -LONG] = -np.inf
        alive = (coarse >= least[:, None]) & (coarse > -np.inf)
        for fq, fx in levels[1:]:
            some = np.flatnonzero(alive.any(0))
            alive[:, some] &= ~(fq[rows] @ fx[some].T + slack[rows] < least[:, None])
        some = np.flatnonzero(alive.any(0))
        alive = alive[:, some]
        if np.count_nonzero(alive) * DENSE < alive.size or is_wide(q, x):
            a, b = np.nonzero(alive)
            score = products(q[rows], x, a, some[b])
        else:  # most survive: one multiplication, exact as all sums are whole numbers
            dense = np.where(alive, q[rows] @ x[some].T, -np.inf)
            if len(some) > k:
                alive = alive & (dense >= np.partition(dense, len(some) - k, axis=1)[:, len(some) - k, None])
            a, b = np.nonzero(alive)
            score = dense[a, b].astype(np.int64)
        b = some[b]
        top = best(a, score, x_ids[b], k)
        found.append((q_rows[rows][a[top]], b[top], score[top]))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, whole-numbered vectors) of the rows of each length."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, quantise(batch.column("v").take(pa.array(at)))


def fitted(rows: DataFrame) -> dict[int, np.ndarray]:
    """The coarse statistics of the rows that cells are named after, for each length of vector in the sample."""
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    picked = rows.select("dim", "v", F.xxhash64("id", "row").alias("h"), "row").orderBy("h", "row").limit(SAMPLE).collect()
    of: dict[int, list] = {}
    for r in picked:
        held = of.setdefault(r["dim"], [])
        if len(held) < -(-2 * sizes[r["dim"]] // room(r["dim"])):  # cells half full
            held.append(r["v"])
    return {dim: features(quantise(pa.array(held, pa.list_(pa.float64()))), SEGMENTS[0]) for dim, held in of.items()}


def room(dim: int) -> int:
    """Points in a part of a cell."""
    return max(1, VALUES // max(1, dim))


def placed(rows: DataFrame, homes) -> DataFrame:
    """``rows`` with the cell of each."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.zeros(b.num_rows, np.int32)
            for dim, at, x in by_length(b):
                points = homes.value.get(dim, np.zeros((0, 0)))
                for i in range(0, len(at) if len(points) > 1 else 0, TILE):
                    f = features(x[i : i + TILE], SEGMENTS[0])
                    with np.errstate(all="ignore"):
                        cell[at[i : i + TILE]] = ((points * points).sum(1)[None, :] - 2 * (f @ points.T)).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], [*b.schema.names, "cell"])

    return rows.mapInArrow(assign, ", ".join([f"{n} {t}" for n, t in rows.dtypes] + ["cell int"]))


def cell_table(rows: DataFrame) -> dict[int, tuple]:
    """By length of vector: (cells, points in each, greatest norm, [(low, high) of the statistics of each resolution])."""
    names = ["dim", "cell", "n", "norm", "at", "low", "high"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for b in batches:
            cells = b.column("cell").to_numpy()
            for dim, at, x in by_length(b):
                both = np.concatenate([features(x, s) for s in SEGMENTS], 1)
                norm = np.sqrt((x * x).sum(1))
                for c in np.unique(cells[at]).tolist():
                    mine = cells[at] == c
                    new = mine.sum(), norm[mine].max(), both[mine].min(0), both[mine].max(0)
                    old = held.get((dim, c))
                    held[dim, c] = new if old is None else [f(u, v) for f, u, v in zip((np.add, np.maximum, np.minimum, np.maximum), old, new)]
        out = [(*k, int(n) if not i else 0, float(m), i, float(a), float(z)) for k, (n, m, low, high) in held.items() for i, (a, z) in enumerate(zip(low, high))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    parts = rows.select("dim", "cell", "v").mapInArrow(measure, "dim long, cell long, n long, norm double, at long, low double, high double")
    ends = parts.groupBy("dim", "cell", "at").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.min("low").alias("low"), F.max("high").alias("high"))
    of: dict[int, dict] = {}
    for r in ends.orderBy("dim", "cell", "at").collect():
        n, norm, low, high = of.setdefault(r["dim"], {}).setdefault(r["cell"], ([], [], [], []))
        for to, value in zip((n, norm, low, high), (r["n"], r["norm"], r["low"], r["high"])):
            to.append(value)
    table = {}
    for dim, cells in of.items():
        low, high = (np.array([c[i] for c in cells.values()]) for i in (2, 3))
        wide = features(np.zeros((1, dim)), SEGMENTS[0]).shape[1]
        levels = [(low[:, part], high[:, part]) for part in (slice(0, wide), slice(wide, None))]
        table[dim] = np.array(list(cells)), np.array([sum(c[0]) for c in cells.values()]), np.array([c[1][0] for c in cells.values()]), levels
    return table


def cell_bounds(q: np.ndarray, norm: np.ndarray, levels: list) -> np.ndarray:
    """(queries, cells): no point of the cell scores more."""
    out = np.full((len(q), len(norm)), np.inf)
    with np.errstate(all="ignore"):
        for s, (low, high) in zip(SEGMENTS, levels):
            f = features(q, s)
            out = np.minimum(out, np.nan_to_num(np.maximum(f, 0) @ high.T + np.minimum(f, 0) @ low.T, nan=np.inf, posinf=np.inf))
        return out + np.nan_to_num(slack_of(q, norm), nan=np.inf, posinf=np.inf)


def route(asked: DataFrame, table, k: int, first: bool) -> DataFrame:
    """``asked`` (row, id, dim, v, floor) once for each part of a cell to visit: at first the cells of the highest bounds
    that hold k other points, one part of each; then whatever else has a bound that reaches the floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, floors = b.column("row").to_numpy(), b.column("floor").to_numpy()
            for dim, at, x in by_length(b):
                cells, n, norm, levels = table.value[dim]
                parts = -(-n // room(dim))
                step = max(1, 2_000_000 // int(parts.sum()))
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    bound = cell_bounds(x[i : i + step], norm, levels)
                    order = np.argsort(-bound, axis=1, kind="stable")
                    held = np.cumsum(np.minimum(n, room(dim) // 2)[order], axis=1)
                    begin = np.zeros(bound.shape, bool)
                    np.put_along_axis(begin, order, np.concatenate((np.zeros((len(some), 1)), held[:, :-1]), 1) <= k, 1)
                    reach = bound >= np.where(floors[some] <= -LONG, -np.inf, floors[some])[:, None]
                    who, cell = np.nonzero(begin if first else reach)
                    part = rows[some][who] % parts[cell]
                    if not first:  # all parts but those visited at first
                        times = parts[cell]
                        every = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        new = every != np.repeat(np.where(begin[who, cell], part, -1), times)
                        who, cell, part = np.repeat(who, times)[new], np.repeat(cell, times)[new], every[new]
                    for j in range(0, len(who), ROUTES):
                        picked = b.take(pa.array(some[who[j : j + ROUTES]]))
                        yield pa.RecordBatch.from_arrays(
                            [*picked.columns, pa.array(cells[cell[j : j + ROUTES]].astype(np.int32)), pa.array(part[j : j + ROUTES].astype(np.int64))],
                            [*b.schema.names, "cell", "part"])

    return asked.mapInArrow(run, ", ".join([f"{n} {t}" for n, t in asked.dtypes] + ["cell int", "part long"]))


def search(points: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """row, query_id, other, vec_id, score: the k best points of each visit."""
    at = ["dim", "cell", "part"]
    chunks = visits.groupBy(*at).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    shown = [*at, "chunk", "row", "id", "v", "floor"]
    held = points.join(chunks, at).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("floor", F.lit(None).cast("double"))
    callers = visits.join(chunks, at).withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int"))

    def answer(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        asks = t.column("floor").is_valid().to_numpy()
        ids, own = t.column("id").to_numpy(), t.column("row").to_numpy()
        x = quantise(t.column("v").chunk(0)) if len(t) else np.zeros((0, 0))
        floor = t.column("floor").filter(pa.array(asks)).to_numpy().astype(np.float64)
        with np.errstate(all="ignore"):
            q, place, s = search_cell(own[asks], x[asks], floor, own[~asks], ids[~asks], x[~asks], k)
        names = dict(zip(own[asks].tolist(), ids[asks].tolist()))
        return pa.table({"row": pa.array(q, pa.int64()), "query_id": pa.array([names[r] for r in q.tolist()], pa.int64()), "other": pa.array(own[~asks][place], pa.int64()),
                         "vec_id": pa.array(ids[~asks][place], pa.int64()), "score": pa.array(s, pa.int64())})

    both = held.select(*shown).unionByName(callers.select(*shown))
    return both.groupBy(*at, "chunk").applyInArrow(answer, "row long, query_id long, other long, vec_id long, score long")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "other")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` selects, its k best other rows."""
    whole = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(whole)
    named = usable.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"), F.size(vector).alias("dim"))
    one = settle(named, "vectors")
    context = one.sparkSession.sparkContext
    rows = settle(placed(one, context.broadcast(fitted(one))), "cells")
    cells = cell_table(rows)
    table = context.broadcast(cells)
    # as many parts as the cell table says: a row for each cell
    sizes = [(dim, int(c), -(-int(n) // room(dim))) for dim, (names, counts, _, _) in cells.items() for c, n in zip(names, counts)]
    parts = F.broadcast(one.sparkSession.createDataFrame(sizes, "dim int, cell int, parts long"))
    points = rows.join(parts, ["dim", "cell"]).select("dim", "cell", F.pmod(F.xxhash64("row"), "parts").alias("part"), "row", "id", "v")
    asked = rows.where("asks").select("row", "id", "dim", "v")
    lowest = F.lit(float("-inf"))
    begun = settle(ranked(search(points, settle(route(asked.withColumn("floor", lowest), table, k, True), "first"), k), k), "begun")
    floors = begun.where(F.col("rank") == k).select("row", F.col("score").cast("double").alias("floor"))
    raised = asked.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", lowest))
    rest = search(points, settle(route(raised, table, k, False), "visits"), k)
    return ranked(begun.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
