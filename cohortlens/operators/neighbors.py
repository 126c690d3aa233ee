"""Exact nearest neighbours, local outlier factors, Tomek links and near-miss sampling.

Neighbours are found without forming all pairs:

1. Copies of one vector become a single *site*; only the k+1 lowest keys of a site can ever be
   neighbours, so a site carries at most that many, however many copies there are.
2. Sites are range partitioned by the nearest of a few pivots, then along a grid order that halves
   the widest dimension first, and each sorted partition is packed into blocks of at most
   ``BLOCK_ROWS`` sites with a bounding box and, for each pivot, the range of the sites' distances.
3. Inside its block a site finds k close sites. The distance to the k-th is a bound: a block whose
   box is farther away, or whose distances to some pivot differ more from the site's, cannot hold a
   nearer one. Boxes tell in few dimensions, pivots in many.
4. Blocks that follow each other make bundles, the leaves of a directory tree of fixed fan-out and any
   depth, joined level by level: a block goes to a node with only those of its sites that may gain from
   it, and in the end once to each bundle its sites' bounds reach. There they meet the blocks that they
   reach, nearest first, and what is found tightens their bounds. The k nearest of all finds are kept.

All steps are equi-joins on block, node or site keys. A level with few nodes has copies of each, dealt by
salt, so that the root is no single task either; targets that very many probes reach are salted by
their count. Every unit of work is one pair of bounded blocks, and nothing is broadcast but the pivots. Distances add up the features in the given order, so a
box bound never exceeds a real distance through rounding. Ties are broken by key.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from ..session import cut, join_groups
from .relational import hot_join, removed_rows, running_index

# Kernels travel inside the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1024
STRIP = 64
GRID_BITS = 60
FAN = 256  # children of a node of the directory
PIVOTS, CELLS, SAMPLE = 12, 48, 2048  # pivots that bound distances, pivots that sort sites, sites they are taken from
PROBES_PER_TASK = 64
BUNDLES, BUNDLE_BYTES = 16, 32 << 20  # bundles of blocks that a group's sites are sent to, and their largest size
PRODUCT_COLUMNS = 16  # from which on distances are bounded by a product of matrices first
HOT_SHARE = 1024
LOF_EPSILON = 1e-10
LOF_CUT = 1.5
EDGES = ("lo", "hi", "plo", "phi")  # ends of a block's columns, and of its distances to the pivots


# --- kernels on bounded blocks -----------------------------------------------------------------

def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of ``a`` to every row of ``b``, features added in order."""
    total = np.zeros((len(a), len(b)))
    right = np.ascontiguousarray(b.T)
    gap = np.empty((min(STRIP, len(a)), len(b)))
    for at in range(0, len(a), STRIP):
        part, strip = total[at: at + STRIP], a[at: at + STRIP]
        work = gap[: len(strip)]
        for j in range(a.shape[1]):
            np.subtract(strip[:, j, None], right[j], out=work)
            part += np.abs(work, out=work) if metric == "mean_abs" else np.multiply(work, work, out=work)
    return _finish(total, a.shape[1], metric)


def _finish(total: np.ndarray, p: int, metric: str) -> np.ndarray:
    return total / p if metric == "mean_abs" else np.sqrt(total)


def _gaps(lo: np.ndarray, hi: np.ndarray, box_lo: np.ndarray, box_hi: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance between the points of each left box and of each right box.

    A point is a box whose edges coincide. Terms are added in the order of ``_distances``, so rounding
    cannot lift a lower bound above, or push an upper bound below, a real distance.
    """
    low = np.zeros((len(lo), len(box_lo)))
    high = np.zeros((len(lo), len(box_lo)))
    for j in range(lo.shape[1]):
        below = box_lo[None, :, j] - hi[:, j, None]
        above = lo[:, j, None] - box_hi[None, :, j]
        near = np.maximum(np.maximum(below, above), 0.0)
        far = np.maximum(box_hi[None, :, j] - lo[:, j, None], hi[:, j, None] - box_lo[None, :, j])
        low += near if metric == "mean_abs" else near * near
        high += far if metric == "mean_abs" else far * far
    return _finish(low, lo.shape[1], metric), _finish(high, lo.shape[1], metric)


def _smallest(dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column indices of the k smallest finite entries per row; ties take the first columns."""
    n, m = dist.shape
    k = min(k, m)
    if k == 0:
        return np.empty(0, int), np.empty(0, int)
    kth = np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
    chosen = dist <= kth
    chosen &= np.isfinite(dist)
    over = np.nonzero(chosen.sum(axis=1) > k)[0]
    if len(over):
        less, tied = dist[over] < kth[over], dist[over] == kth[over]
        room = k - less.sum(axis=1, keepdims=True)
        chosen[over] = less | (tied & (np.cumsum(tied, axis=1) <= room))
    return np.nonzero(chosen)


def _within(dist: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_smallest``, among the entries within each row's bound, of which there are few."""
    rows, cols = np.nonzero(dist <= bound[:, None])
    finite = np.isfinite(dist[rows, cols])
    rows, cols = rows[finite], cols[finite]
    found = np.bincount(rows, minlength=len(dist))
    if found.max(initial=0) <= k:
        return rows, cols
    order = np.lexsort((cols, dist[rows, cols], rows))
    place = np.arange(len(rows)) - np.repeat(np.cumsum(found) - found, found)
    keep = order[place < k]
    return rows[keep], cols[keep]


def _matrix(column: pa.Array, i: int, width: int) -> np.ndarray:
    return np.asarray(column[i].values, dtype=float).reshape(-1, width)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    """Rows whose list fields hold arrays, as one record batch."""
    columns = []
    for field in schema:
        values = [r[field.name] for r in rows]
        if pa.types.is_list(field.type):
            kind = field.type.value_type
            parts = [(v if isinstance(v, pa.Array) else pa.array(v)).cast(kind) for v in values]
            ends = np.cumsum([0] + [len(v) for v in parts]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts)).cast(field.type))
        else:
            columns.append(pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


# --- pivots ------------------------------------------------------------------------------------

def _pivots(sites: DataFrame, width: int, metric: str) -> np.ndarray:
    """Sites of a sample, each the farthest from those before."""
    sample = sites.select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(SAMPLE).collect()
    x = np.array([r["vec"] for r in sample], dtype=float).reshape(len(sample), width)
    if not len(x):
        return np.zeros((0, width))
    picked = [0]
    near = _distances(x, x[:1], metric)[:, 0]
    while len(picked) < CELLS and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, _distances(x, x[picked[-1:]], metric)[:, 0])
    return x[picked]


def _apart(own: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance of sites (rows of their distances to the pivots) to blocks (ranges of such), by the triangle inequality.

    Less what rounding may add, so that no bound exceeds a real distance.
    """
    out = np.zeros((len(own), len(low)))
    for p in range(own.shape[1]):
        gap = np.maximum(own[:, p, None] - high[None, :, p], low[None, :, p] - own[:, p, None])
        np.maximum(out, gap - 1e-9 * (1.0 + own[:, p, None] + high[None, :, p]), out=out)
    return out


def _with_cell(sites: DataFrame, groups: list[str], width: int, metric: str, pivots: np.ndarray) -> DataFrame:
    """``sites`` with the number of the nearest pivot. A hint for locality."""

    def cell(batches):
        for batch in batches:
            x = np.asarray(batch.column("vec").flatten(), dtype=float).reshape(-1, width)
            near = np.zeros(len(x), np.int32)
            for at in range(0, len(x), BLOCK_ROWS):
                near[at: at + BLOCK_ROWS] = _distances(x[at: at + BLOCK_ROWS], pivots, metric).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=[*batch.schema.names, "_cell"])

    if not len(pivots):
        return sites.withColumn("_cell", F.lit(0))
    schema = T.StructType([*sites.schema.fields, T.StructField("_cell", T.IntegerType())])
    return sites.mapInArrow(cell, schema)


# --- packing -----------------------------------------------------------------------------------

def _grid_order(df: DataFrame, vec: str, width: int) -> Column:
    """An order-preserving grid code: bits go to the dimension whose cells are widest.

    Only a hint for locality; results do not depend on it.
    """
    if not width:
        return F.lit(0).cast("long")
    edges = df.agg(*[f(F.get(F.col(vec), i)) for i in range(width) for f in (F.min, F.max)]).first()
    lows = [edges[2 * i] for i in range(width)]
    spans = [edges[2 * i + 1] - edges[2 * i] if edges[2 * i] is not None else 0.0 for i in range(width)]
    bits = [0] * width
    order = []
    for _ in range(GRID_BITS):
        widths = [s / (1 << b) for s, b in zip(spans, bits)]
        i = max(range(width), key=widths.__getitem__)
        if widths[i] <= 0:
            break
        bits[i] += 1
        order.append((i, bits[i]))
    code = F.lit(0).cast("long")
    for place, (i, depth) in enumerate(order):
        share = (F.get(F.col(vec), i) - F.lit(lows[i])) / F.lit(spans[i])
        cell = F.least(F.floor(share * float(1 << depth)), F.lit((1 << depth) - 1))
        code = code.bitwiseOR(F.shiftleft(cell.bitwiseAND(F.lit(1)).cast("long"), len(order) - 1 - place))
    return code


def _pack(width: int, metric: str, k: int, key_type: pa.DataType, groups: list[str], alone: bool, schema: pa.Schema, pivots: np.ndarray):
    """Turn a sorted partition into block rows. ``alone`` skips the search inside the block."""

    def emit(seq: int, group: tuple, keys: pa.Array, x: np.ndarray) -> dict:
        order = pc.sort_indices(keys)
        keys = keys.take(order)
        x = x[order.to_numpy()]
        n = len(x)
        far = _distances(x, pivots[:PIVOTS], metric)
        row = {"block": (TaskContext.get().partitionId() << 32) + seq, "n": n, "lo": x.min(axis=0), "hi": x.max(axis=0),
               "plo": far.min(axis=0), "phi": far.max(axis=0), "keys": keys, "mat": x.ravel()}
        row.update(zip(groups, group))
        if not alone:
            theta = np.full(n, np.inf)
            dist = _distances(x, x, metric)
            np.fill_diagonal(dist, np.inf)
            rows, cols = _smallest(dist, min(k, n - 1))
            found = dist[rows, cols]
            if n > k:
                theta = np.maximum.reduceat(found, np.arange(0, n * k, k))
            row.update(theta=theta, src=keys.take(pa.array(rows)), nbr=keys.take(pa.array(cols)), dist=found)
        return row

    def pack(batches):
        held_group, held_keys, held_x, held, seq = None, [], [], 0, 0

        def flush():
            nonlocal held_keys, held_x, held, seq
            row = emit(seq, held_group, pa.concat_arrays(held_keys), np.concatenate(held_x))
            held_keys, held_x, held, seq = [], [], 0, seq + 1
            return _batch([row], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            tags = list(zip(*[batch.column(g).to_pylist() for g in groups])) if groups else [()] * batch.num_rows
            keys = batch.column("key").cast(key_type)
            x = np.asarray(batch.column("vec").flatten(), dtype=float).reshape(-1, width)
            start = 0
            while start < batch.num_rows:
                if held and (tags[start] != held_group or held >= BLOCK_ROWS):
                    yield flush()
                held_group = tags[start]
                stop = start
                while stop < batch.num_rows and tags[stop] == held_group and held + stop - start < BLOCK_ROWS:
                    stop += 1
                held_keys.append(keys.slice(start, stop - start))
                held_x.append(x[start:stop])
                held += stop - start
                start = stop
        if held:
            yield flush()

    return pack


def _blocks(sites: DataFrame, groups: list[str], width: int, metric: str, k: int, alone: bool, code: Column, pivots: np.ndarray) -> DataFrame:
    key = sites.schema["key"].dataType
    fields = [sites.schema[g] for g in groups] + [
        T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()),
        *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in EDGES],
        T.StructField("keys", T.ArrayType(key)), T.StructField("mat", T.ArrayType(T.DoubleType())),
    ]
    if not alone:
        fields += [
            T.StructField("theta", T.ArrayType(T.DoubleType())), T.StructField("src", T.ArrayType(key)),
            T.StructField("nbr", T.ArrayType(key)), T.StructField("dist", T.ArrayType(T.DoubleType())),
        ]
    schema = T.StructType(fields)
    pack = _pack(width, metric, k, to_arrow_type(key), groups, alone, to_arrow_schema(schema), pivots)
    placed = _with_cell(sites, groups, width, metric, pivots).withColumn("_grid", code)
    ordered = placed.repartitionByRange(*groups, "_cell", "_grid", "key").sortWithinPartitions(*groups, "_cell", "_grid", "key").select(*groups, "key", "vec")
    return cut(ordered.mapInArrow(pack, schema), "blocks")


# --- routing and matching ----------------------------------------------------------------------

def _route(width: int, metric: str, need: int, theta_given: bool, own_block: bool, schema: pa.Schema, groups: list[str], pivots: np.ndarray, one: bool = False):
    """Send the sites of a block (or probe) to the children of a node that their bounds reach. ``own_block``: but not to their own block.

    ``one``: each to the nearest child alone, of those with ``need`` sites if there are any.
    """
    pivots = pivots[:PIVOTS]

    def route(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                x = _matrix(batch.column("mat"), i, width)
                theta = np.asarray(batch.column("theta")[i].values, dtype=float) if theta_given else np.full(len(x), np.inf)
                lo, hi = _matrix(batch.column("box_lo"), i, width), _matrix(batch.column("box_hi"), i, width)
                plo, phi = (_matrix(batch.column(c), i, len(pivots)) if len(pivots) else np.zeros((len(lo), 0)) for c in ("box_plo", "box_phi"))
                ids = np.asarray(batch.column("box_id")[i].values)
                full = np.asarray(batch.column("box_n")[i].values) >= need
                # Boxes out of reach for the block as a whole are dropped before rows are looked at.
                low, high = _gaps(x.min(axis=0)[None], x.max(axis=0)[None], lo, hi, metric)
                reach = np.inf if one else min(theta.max(), high[0, full].min() if full.any() else np.inf)
                near = np.nonzero(full)[0] if one and full.any() else np.nonzero(low[0] <= reach)[0]
                lo, hi, plo, phi, ids, full = lo[near], hi[near], plo[near], phi[near], ids[near], full[near]
                low, high = _gaps(x, x, lo, hi, metric)
                low = np.maximum(low, _apart(_distances(x, pivots, metric), plo, phi))
                if one:
                    least = np.where(low == low.min(axis=1, keepdims=True), high, np.inf).argmin(axis=1)
                    reached = least[:, None] == np.arange(len(ids))
                else:
                    if full.any():
                        theta = np.minimum(theta, high[:, full].min(axis=1))
                    reached = low <= theta[:, None]
                own = batch.column("block")[i].as_py()
                keys = batch.column("keys")[i].values
                for b in np.nonzero(reached.any(axis=0))[0]:
                    if own_block and ids[b] == own:
                        continue
                    hit = np.nonzero(reached[:, b])[0]
                    row = {"target": int(ids[b]), "block": own, "keys": keys.take(pa.array(hit)), "mat": x[hit].ravel(),
                           "theta": theta[hit]}
                    row.update((g, batch.column(g)[i].as_py()) for g in groups)
                    out.append(row)
                    if len(out) >= 64:
                        yield _batch(out, schema)
                        out = []
            if out:
                yield _batch(out, schema)

    return route


def _close(x: np.ndarray, y: np.ndarray, theta: np.ndarray, metric: str) -> np.ndarray:
    """Distances of the rows of ``x`` to those of ``y``, exact where they are within ``theta`` and infinite where they are not.

    In many columns one product of matrices, with room for its rounding, tells the few pairs to look at.
    """
    if metric == "euclidean" and x.shape[1] >= PRODUCT_COLUMNS:
        a, b = (x * x).sum(axis=1), (y * y).sum(axis=1)
        size = a[:, None] + b
        near = size - 2.0 * (x @ y.T)
        if np.isfinite(near).all():
            rows, cols = np.nonzero(near <= (theta * theta)[:, None] + 1e-11 * size)
            if len(rows) < near.size / 8:
                total = np.zeros(len(rows))
                for j in range(x.shape[1]):  # added in the order of _distances
                    gap = x[rows, j] - y[cols, j]
                    total += gap * gap
                out = np.full(near.shape, np.inf)
                out[rows, cols] = _finish(total, x.shape[1], metric)
                return np.where(out <= theta[:, None], out, np.inf)
    dist = _distances(x, y, metric)
    return np.where(dist <= theta[:, None], dist, np.inf)


def _match(width: int, metric: str, k: int, own_block: bool, schema: pa.Schema, groups: list[str], pivots: np.ndarray):
    """The k nearest sites of a bundle's blocks for each probing site, within its bound, which its finds tighten.

    ``own_block``: but not those of its own block.
    """
    pivots = pivots[:PIVOTS]

    def match(probes: pa.Table, contents: pa.Table) -> pa.Table:
        probes, contents = probes.combine_chunks(), contents.combine_chunks()
        mats = [_matrix(contents.column("t_mat"), i, width) for i in range(contents.num_rows)]
        ids, nbrs = contents.column("t_block").to_pylist(), [contents.column("t_keys")[i].values for i in range(len(mats))]
        box = {c: np.array([contents.column(f"t_{c}")[i].values.to_numpy(zero_copy_only=False) for i in range(len(mats))], float).reshape(len(mats), -1) for c in EDGES}
        out = []
        for i in range(probes.num_rows if mats else 0):
            x, keys = _matrix(probes.column("mat"), i, width), probes.column("keys")[i].values
            theta = np.array(probes.column("theta")[i].values, dtype=float)
            own = probes.column("block")[i].as_py() if own_block else None
            best = np.full((len(x), k), np.inf)
            low = _gaps(x, x, box["lo"], box["hi"], metric)[0]
            low = np.maximum(low, _apart(_distances(x, pivots, metric), box["plo"], box["phi"]))
            finds = []
            for b in np.argsort(low.min(axis=0), kind="stable"):
                hit = np.nonzero(low[:, b] <= theta)[0]
                if not len(hit) or ids[b] == own:
                    continue
                dist = _close(x[hit], mats[b], theta[hit], metric)
                rows, cols = _within(dist, theta[hit], k)
                if not len(rows):
                    continue
                found, some = dist[rows, cols], np.unique(rows)
                finds.append((hit[rows], nbrs[b].take(pa.array(cols)), found))
                merged = np.concatenate((best[hit[some]], dist[some]), axis=1)
                best[hit[some]] = np.partition(merged, k - 1, axis=1)[:, :k]
                theta[hit[some]] = np.minimum(theta[hit[some]], best[hit[some]].max(axis=1))
            for rows, ends, found in finds:
                kept = np.nonzero(found <= theta[rows])[0]
                arrays = [pa.array([probes.column(g)[i].as_py()] * len(kept), type=schema.field(g).type) for g in groups]
                out.append(pa.RecordBatch.from_arrays([*arrays, keys.take(pa.array(rows[kept])), ends.take(pa.array(kept)), pa.array(found[kept])], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return match


def _kth(width: int, metric: str, k: int):
    """The distance of each probing site to the k-th nearest site of the target block, infinite if there are fewer."""

    def kth(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = _matrix(batch.column("mat"), i, width), _matrix(batch.column("t_mat"), i, width)
                far = np.partition(_distances(x, y, metric), k - 1, axis=1)[:, k - 1] if len(y) >= k else np.full(len(x), np.inf)
                own = batch.column("block").slice(i, 1).take(pa.array(np.zeros(len(x), np.int64)))
                yield pa.RecordBatch.from_arrays([own, batch.column("keys")[i].values, pa.array(far)], ["block", "pos", "far"])

    return kth


def _tag(groups: list[str]) -> Column:
    """The group as a text, so that a null is a group like any other."""
    return F.to_json(F.array(*[F.col(g).cast("string") for g in groups])) if groups else F.lit("[]")


def _level(boxes: DataFrame, width: int, pivots: int, parent: Column, child: Column) -> DataFrame:
    """The nodes ``parent`` of a group with what is known of their children, FAN at most, as parallel arrays."""
    wide = {"lo": (F.min, width), "hi": (F.max, width), "plo": (F.min, pivots), "phi": (F.max, pivots)}
    merged = boxes.groupBy("_tag", parent.alias("node"), child.alias("id")).agg(
        F.sum("n").alias("n"), *[F.array(*[f(F.get(c, F.lit(i))) for i in range(m)]).cast("array<double>").alias(c) for c, (f, m) in wide.items()])
    gathered = F.sort_array(F.collect_list(F.struct("id", "n", *EDGES)))
    return merged.groupBy("_tag", "node").agg(gathered.alias("b")).select(
        "_tag", F.col("node").alias("target"), F.col("b.id").alias("box_id"), F.col("b.n").alias("box_n"), *[F.flatten(f"b.{c}").alias(f"box_{c}") for c in EDGES])


def _probes(queries: DataFrame, targets: DataFrame, groups: list[str], width: int, metric: str, k: int,
            self_search: bool, key: T.DataType, pivots: np.ndarray, one: bool = False) -> DataFrame | None:
    """Each block's sites at the blocks (or bundles) that their bounds reach (``one``: at a near block). None when every group is one."""
    schema = T.StructType([queries.schema[g] for g in groups] + [
        T.StructField("target", T.LongType()), T.StructField("block", T.LongType()),
        T.StructField("keys", T.ArrayType(key)), T.StructField("mat", T.ArrayType(T.DoubleType())),
        T.StructField("theta", T.ArrayType(T.DoubleType())),
    ])
    need = k + 1 if self_search else k
    boxes = targets.select("block", "n", *EDGES, _tag(groups).alias("_tag"))
    sizes = boxes.groupBy("_tag").agg(F.count("*").alias("c")).agg(F.max("c").alias("most"), F.count("*").alias("groups")).first()
    most = sizes["most"] or 0
    if self_search and most <= 1:
        return None
    depth = 0
    while FAN ** (depth + 1) < most:
        depth += 1
    if depth:  # blocks are numbered along the order they were packed in
        boxes = cut(running_index(boxes, ["_tag"], ["block"], "place"), "directory")
    spread = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probes = queries.select(*groups, "block", "keys", "mat", *(["theta"] if "theta" in queries.columns else [])).withColumn("target", F.lit(0).cast("long"))
    for level in range(depth, -1, -1):
        node = F.floor((F.col("place") - 1) / FAN ** (level + 1)).cast("long") if depth else F.lit(0).cast("long")
        child = F.floor((F.col("place") - 1) / FAN**level).cast("long") if level else F.col("block")
        nodes = sizes["groups"] * max(1, most // FAN ** (level + 1))
        salts = max(1, spread // nodes)
        directory = _level(boxes, width, min(PIVOTS, len(pivots)), node, child).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        asked = probes.withColumn("_tag", _tag(groups)).withColumn("_salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
        route = _route(width, metric, need, "theta" in probes.columns, self_search and not level, to_arrow_schema(schema), groups, pivots, one)
        probes = cut(asked.join(directory, ["_tag", "target", "_salt"]).mapInArrow(route, schema), "probes")
    return probes


def _find(queries: DataFrame, targets: DataFrame, groups: list[str], width: int, metric: str, k: int,
          self_search: bool, key: T.DataType, pivots: np.ndarray) -> DataFrame | None:
    """Candidate pairs between blocks: (groups, src, nbr, dist). None when every group is one block."""
    blocks = _bundled(targets, groups, width)
    probes = _probes(queries, _bundles(blocks, groups, width, min(PIVOTS, len(pivots))), groups, width, metric, k, self_search, key, pivots)
    if probes is None:
        return None
    pair_schema = T.StructType([queries.schema[g] for g in groups] + [
        T.StructField("src", key), T.StructField("nbr", key), T.StructField("dist", T.DoubleType()),
    ])
    # Probes of a bundle are dealt to slices of bounded size, and its blocks are copied to each of them.
    asked = probes.groupBy("target").agg(F.ceil(F.count("*") / PROBES_PER_TASK).cast("int").alias("_slices"))
    asked = cut(asked, "slices")
    slices = asked.agg(F.sum("_slices")).first()[0] or 1
    spark = queries.sparkSession
    tasks = int(min(slices, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)))
    ends = [F.col("block").alias("t_block"), *[F.col(c).alias(f"t_{c}") for c in (*EDGES, "keys", "mat")]]
    contents = blocks.select(F.col("bundle").alias("target"), *ends).join(asked, "target").select(
        "target", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"), *[f"t_{c}" for c in ("block", *EDGES, "keys", "mat")])
    dealt = probes.join(asked, "target").select(
        "target", F.pmod(F.xxhash64("block"), F.col("_slices")).cast("int").alias("_slice"), *groups, "block", "keys", "mat", "theta")
    left, right = (df.repartition(tasks, "target", "_slice").groupBy("target", "_slice") for df in (dealt, contents))
    match = _match(width, metric, k, self_search, to_arrow_schema(pair_schema), groups, pivots)
    return left.cogroup(right).applyInArrow(match, pair_schema)


def _bundled(targets: DataFrame, groups: list[str], width: int) -> DataFrame:
    """``targets`` with ``bundle``: the block itself, or a number below zero for blocks that follow each other.

    A group has up to BUNDLES bundles, and more where they would be larger than BUNDLE_BYTES. So a site travels to few
    bundles, however many blocks there are.
    """
    tagged = targets.select("block", _tag(groups).alias("_tag"))
    most = tagged.groupBy("_tag").count().agg(F.max("count")).first()[0] or 0
    span = max(1, min(-(-most // BUNDLES), BUNDLE_BYTES // (8 * BLOCK_ROWS * max(1, width))))
    if span == 1:
        return targets.withColumn("bundle", F.col("block"))
    placed = cut(running_index(tagged, ["_tag"], ["block"], "place"), "places").withColumn("_b", F.floor((F.col("place") - 1) / span))
    first = F.min("block")
    named = placed.groupBy("_tag", "_b").agg(F.when(F.count("*") > 1, -1 - first).otherwise(first).alias("bundle"))
    return targets.join(placed.join(named, ["_tag", "_b"]).select("block", "bundle"), "block")


def _bundles(blocks: DataFrame, groups: list[str], width: int, pivots: int) -> DataFrame:
    """Bundles as blocks without contents."""
    wide = {"lo": (F.min, width), "hi": (F.max, width), "plo": (F.min, pivots), "phi": (F.max, pivots)}
    return blocks.groupBy(*groups, F.col("bundle").alias("block")).agg(
        F.sum("n").cast("int").alias("n"), *[F.array(*[f(F.get(c, F.lit(i))) for i in range(m)]).cast("array<double>").alias(c) for c, (f, m) in wide.items()])


def _bounded(queries: DataFrame, targets: DataFrame, groups: list[str], width: int, metric: str, k: int, pivots: np.ndarray) -> DataFrame:
    """``queries`` with ``theta``: for each site a distance within which k sites lie, namely those of one near block.

    The far corners of boxes, which are all that a block tells of itself, grow much looser with the columns.
    """
    placed = queries.withColumn("keys", F.transform("keys", lambda _, i: i.cast("long")))
    probes = _probes(placed, targets, groups, width, metric, k, False, T.LongType(), pivots, one=True)
    contents = targets.select(F.col("block").alias("target"), F.col("mat").alias("t_mat"))
    pairs = _join_ends(probes, contents, ["target"], _hubs(probes, ["target"], max(probes.count(), PROBES_PER_TASK * HOT_SHARE)), rows=PROBES_PER_TASK)
    found = pairs.mapInArrow(_kth(width, metric, k), "block long, pos long, far double")
    theta = found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pos", "far"))).alias("t")).select("block", F.col("t.far").alias("theta"))
    return cut(queries.join(theta, "block"), "bounded")


def _nearest(pairs: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k nearest finds of each source, ties by key."""
    order = Window.partitionBy(*by).orderBy("dist", "nbr")
    return pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def _hubs(edges: DataFrame, on: list[str], total: int) -> DataFrame | None:
    """Ends shared by more than 1/HOT_SHARE of the edges, of which there are fewer than HOT_SHARE; None if none."""
    many = edges.groupBy(*on).agg(F.count("*").alias("c")).where(F.col("c") > total / HOT_SHARE)
    hubs = cut(many, "hubs")
    return None if hubs.isEmpty() else hubs


def _join_ends(edges: DataFrame, per_end: DataFrame, on: list[str], hubs: DataFrame | None, how: str = "inner", rows: int = 1_000_000) -> DataFrame:
    return edges.join(per_end, on, how) if hubs is None else hot_join(edges, per_end, on, hubs, how, rows)


# --- sites -------------------------------------------------------------------------------------

class Sites:
    """Distinct vectors of a keyed table and, for each, the rows that may serve as neighbours.

    Where a table has no copies at all, a site is a row and every step about copies is left out.
    """

    def __init__(self, df: DataFrame, key: str, vec: str, groups: list[str], k: int):
        self.groups, self.key, self.k = list(groups), key, k
        # Two 64-bit hashes stand for the vector, so that vectors are neither compared nor shipped twice.
        self.rows = cut(df.select(
            *groups, F.col(key).alias("key"), F.col(vec).alias("vec"),
            F.xxhash64(vec).alias("hash"), F.xxhash64(F.lit("second"), vec).alias("hash2"),
        ), "vectors")
        first = self.rows.select(F.size("vec").alias("w")).first()
        self.width = first["w"] if first else 0
        self.by = [*groups, "hash", "hash2"]
        # Window group limits prune each partition to k+1 rows per vector before the shuffle.
        place = F.row_number().over(Window.partitionBy(*self.by).orderBy("key"))
        lowest = self.rows.withColumn("_r", place).where(F.col("_r") <= k + 1)
        few = lowest.groupBy(*self.by).agg(F.sort_array(F.collect_list("key")).alias("few"), F.first("vec").alias("vec"))
        self.table = cut(few.select(*self.by, F.get("few", F.lit(0)).alias("key"), "vec", "few"), "sites")
        self.copied = self.table.where(F.size("few") > 1).select(*self.by, "key")
        self.copies = not self.copied.isEmpty()
        if self.copies:
            # At most HOT_SHARE vectors can hold more than that share of the rows each.
            many = self.rows.groupBy(*self.by).agg(F.count("*").alias("c")).where(F.col("c") > self.rows.count() / HOT_SHARE)
            self.hot = cut(self.copied.join(many, self.by), "hot")

    def pairs(self, metric: str) -> DataFrame:
        """(groups, src, nbr, dist): the k nearest other sites of every site."""
        g = self.groups
        base = self.table.select(*g, "key", "vec")
        pivots = _pivots(base, self.width, metric)
        blocks = _blocks(base, g, self.width, metric, self.k, False, _grid_order(base, "vec", self.width), pivots)
        found = blocks.select(*g, F.inline(F.arrays_zip("src", "nbr", "dist")))
        across = _find(blocks, blocks, g, self.width, metric, self.k, True, self.table.schema["key"].dataType, pivots)
        return _nearest(found if across is None else found.unionByName(across), [*g, "src"], self.k)

    def neighbours(self, metric: str) -> DataFrame:
        """(groups, site, near): up to k+1 nearest rows per site, its own first copies included.

        ``near`` is an array of (dist, key, site) in order of distance and key.
        """
        g, k = self.groups, self.k
        own = self.table.select(*g, F.col("key").alias("src"), F.col("key").alias("nbr"), F.lit(0.0).alias("dist"), F.explode("few").alias("row"))
        pairs = self.pairs(metric)
        other = self.unfold(cut(pairs, "pairs")) if self.copies else pairs.withColumn("row", F.col("nbr"))
        every = other.unionByName(own)
        entry = F.struct("dist", F.col("row").alias("key"), F.col("nbr").alias("site"))
        near = F.slice(F.sort_array(F.collect_list(entry)), 1, k + 1)
        return every.groupBy(*g, F.col("src").alias("site")).agg(near.alias("near"))

    def unfold(self, pairs: DataFrame) -> DataFrame:
        """Pairs with one row per row of the neighbouring site that may count, as ``row``."""
        on = [*self.groups, "nbr"]
        lists = self.table.where(F.size("few") > 1).select(*self.groups, F.col("key").alias("nbr"), "few")
        joined = _join_ends(pairs, lists, on, _hubs(pairs, on, pairs.count()), "left")
        return joined.withColumn("row", F.explode(F.coalesce("few", F.array("nbr")))).drop("few")

    def expand(self, per_site: DataFrame) -> DataFrame:
        """Per-site columns brought to every row of the site. Sites with very many copies are spread out."""
        g = self.groups
        if not self.copies:
            return per_site.withColumn("key", F.col("site"))
        alias = self.copied.select(*self.by, F.col("key").alias("_site"))
        members = hot_join(self.rows.drop("vec"), alias, self.by, self.hot.select(*self.by, "c"), "left").select(
            *g, "key", F.coalesce("_site", "key").alias("site")
        )
        return hot_join(members, per_site, [*g, "site"], self.hot.select(*g, F.col("key").alias("site"), "c"))


def _without_self(near: str, key: str, k: int) -> Column:
    return F.slice(F.filter(near, lambda e: e["key"] != F.col(key)), 1, k)


def knn(df: DataFrame, key: str, vec: str, k: int, metric: str = "euclidean", partition_by: list[str] = ()) -> DataFrame:
    """The k nearest other rows of every row, inside its group: (groups, key, nbr, dist, rank).

    ``metric`` is ``euclidean`` or ``mean_abs`` (mean absolute difference of the entries).
    """
    g = list(partition_by)
    sites = Sites(df, key, vec, g, k)
    rows = sites.expand(sites.neighbours(metric).select(*g, "site", "near"))
    picked = rows.select(*g, "key", F.posexplode(_without_self("near", "key", k)).alias("pos", "e"))
    return picked.select(
        *g, F.col("key").alias(key), F.col("e.key").alias("nbr"), F.col("e.dist").alias("dist"),
        (F.col("pos") + 1).alias("rank"),
    )


def gower_scale(df: DataFrame, columns: list[str], partition_by: list[str] = (), out: str = "gower") -> DataFrame:
    """Columns scaled to their range inside the group, as one array; a constant column is 0.

    The mean absolute difference of two such arrays is Gower's distance.
    """
    g = list(partition_by)
    ranges = df.groupBy(*g).agg(*[f(c).cast("double").alias(f"_{t}_{c}") for c in columns
                                  for t, f in (("lo", F.min), ("hi", F.max))])
    if g:
        joined, edge = join_groups(df, ranges, g), F.col
    else:
        row = ranges.first()
        joined, edge = df, lambda name: F.lit(row[name])
    scaled = []
    for c in columns:
        span = edge(f"_hi_{c}") - edge(f"_lo_{c}")
        scaled.append(F.when(span > 0, (F.col(c).cast("double") - edge(f"_lo_{c}")) / span).otherwise(F.lit(0.0)))
    return joined.withColumn(out, F.array(*scaled)).drop(*[n for n in ranges.columns if n.startswith("_")])


def gower_neighbours(df: DataFrame, key: str, columns: list[str], k: int, partition_by: list[str] = ()) -> DataFrame:
    """The k smallest Gower distances of every row, inside its group."""
    return knn(gower_scale(df, columns, partition_by), key, "gower", k, "mean_abs", partition_by)


def lof(df: DataFrame, key: str, vec: str, k: int = 20, metric: str = "mean_abs", partition_by: list[str] = ()) -> DataFrame:
    """(groups, key, lof, mask): local outlier factor and -1 for rows above the cut, else 1.

    Copies of a vector share distance, density and factor, so everything is computed per site. In a
    group of n rows at most n-1 neighbours exist; a group of one row has factor 1.
    """
    g = list(partition_by)
    sites = Sites(df, key, vec, g, k)
    near = sites.neighbours(metric).select(*g, "site", "near")
    # The site's own lowest key stands for the row itself.
    picked = near.withColumn("near", _without_self("near", "site", k))
    reach = cut(picked.select(*g, "site", F.array_max("near.dist").alias("kdist"), "near"), "near")
    edges = reach.select(*g, "site", F.explode("near").alias("e")).select(
        *g, "site", F.col("e.dist").alias("dist"), F.col("e.site").alias("nbr")
    )
    on = [*g, "nbr"]
    hubs = _hubs(edges, on, reach.count() * k)
    kdist = reach.select(*g, F.col("site").alias("nbr"), "kdist")
    local = _join_ends(edges, kdist, on, hubs).groupBy(*g, "site").agg(
        (1.0 / (F.avg(F.greatest("dist", "kdist")) + LOF_EPSILON)).alias("lrd")
    )
    density = cut(local, "density")
    ratio = (
        _join_ends(edges, density.select(*g, F.col("site").alias("nbr"), F.col("lrd").alias("nbr_lrd")), on, hubs)
        .groupBy(*g, "site").agg(F.avg("nbr_lrd").alias("nbr_lrd"))
        .join(density, [*g, "site"])
        .select(*g, "site", (F.col("nbr_lrd") / F.col("lrd")).alias("lof"))
    )
    alone = sites.table.select(*g, F.col("key").alias("site"))
    factors = alone.join(ratio, [*g, "site"], "left").withColumn("lof", F.coalesce("lof", F.lit(1.0)))
    mask = F.when(F.col("lof") > LOF_CUT, -1).otherwise(1)
    return sites.expand(factors).select(*g, F.col("key").alias(key), "lof", mask.alias("mask"))


def remove_outliers(df: DataFrame, key: str, columns: list[str], k: int = 20, partition_by: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) rows by the local outlier factor of Gower distances, each group on its own."""
    g = list(partition_by)
    masked = cut(lof(gower_scale(df, columns, g), key, "gower", k, "mean_abs", g).select(*g, key, "mask"), "masked")
    joined = df.join(masked, [*g, key])
    return joined.where("mask = 1").drop("mask"), joined.where("mask = -1").drop("mask")


def tomek_links(df: DataFrame, key: str, vec: str, label: str, partition_by: list[str] = ()) -> DataFrame:
    """Pairs of opposite label that are each other's nearest neighbour: (groups, a, b, label_a, label_b), a < b.

    A mutual pair shows up as two edges with the same ends, so one aggregate finds it.
    """
    g = list(partition_by)
    edges = knn(df, key, vec, 1, "euclidean", g).join(df.select(*g, key, F.col(label).alias("_y")), [*g, key])
    ends = edges.select(*g, F.least(key, "nbr").alias("a"), F.greatest(key, "nbr").alias("b"),
                        (F.col(key) < F.col("nbr")).alias("_first"), "_y")
    return ends.groupBy(*g, "a", "b").agg(
        F.max(F.when(F.col("_first"), F.col("_y"))).alias("label_a"),
        F.max(F.when(~F.col("_first"), F.col("_y"))).alias("label_b"),
    ).where(F.col("label_a") != F.col("label_b"))


def tomek_undersample(df: DataFrame, key: str, vec: str, label: str, strategy: str = "all",
                      partition_by: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(kept, removed). ``all`` removes both ends of each link, ``auto`` spares the minority class.

    The minority class is the rarer label of the group, the lower label on a tie.
    """
    g = list(partition_by)
    links = tomek_links(df, key, vec, label, g)
    ends = links.select(*g, F.inline(F.array(
        F.struct(F.col("a").alias(key), F.col("label_a").alias("_y")),
        F.struct(F.col("b").alias(key), F.col("label_b").alias("_y")),
    )))
    if strategy == "auto":
        rare = _class_sizes(df, label, g).where("_minority").withColumnRenamed("_label", "_y")
        ends = ends.join(rare, [*g, "_y"], "left_anti")
    elif strategy != "all":
        raise ValueError(f"unknown strategy {strategy}")
    gone = cut(ends.select(*g, key), "tomek")
    return removed_rows(df, gone, [*g, key]), df.join(gone, [*g, key], "left_semi")


def knn_between(asked: Sites, given: Sites, metric: str = "euclidean") -> DataFrame:
    """The k nearest rows of ``given`` for every row of ``asked``: (groups, key, nbr, dist)."""
    g, k = given.groups, given.k
    code, pivots = _grid_order(given.table, "vec", given.width), _pivots(given.table, given.width, metric)
    q, t = (_blocks(s.table.select(*g, "key", "vec"), g, given.width, metric, k, True, code, pivots) for s in (asked, given))
    q = _bounded(q, t, g, given.width, metric, k, pivots)
    pairs = _nearest(_find(q, t, g, given.width, metric, k, False, given.table.schema["key"].dataType, pivots), [*g, "src"], k)
    entry = F.struct("dist", F.col("row").alias("key"))
    near = given.unfold(cut(pairs, "pairs")).groupBy(*g, F.col("src").alias("site")).agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("near")
    )
    return asked.expand(near).select(*g, "key", F.explode("near").alias("e")).select(
        *g, "key", F.col("e.key").alias("nbr"), F.col("e.dist").alias("dist")
    )


def _class_sizes(df: DataFrame, label: str, groups: list[str]) -> DataFrame:
    """(groups, _label, _n, _minority): the minority is the rarer label, the lower one on a tie."""
    sizes = df.groupBy(*groups, F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*groups).orderBy("_n", "_label")
    return sizes.withColumn("_minority", F.row_number().over(order) == 1)


def near_miss(df: DataFrame, key: str, vec: str, label: str, share: int, k: int = 3, partition_by: list[str] = ()) -> DataFrame:
    """Version-3 near-miss sampling: (groups, key, label, mean_dist) of the rows kept.

    Rows of a class that are among the k nearest of some minority row are its candidates; those with
    the largest mean distance to their k nearest minority rows are kept, one ``share``-th of the
    class at most. The minority class is sampled the same way, each row being its own nearest.
    """
    g = list(partition_by)
    sizes = _class_sizes(df, label, g)
    tagged = cut(df.select(*g, key, vec, F.col(label).alias("_label")).join(sizes, [*g, "_label"]), "classes", ("_label",))
    rare = Sites(tagged.where("_minority"), key, vec, g, k)
    kept = []
    for value in sorted(r["_label"] for r in tagged.select("_label").distinct().collect()):
        pool = tagged.where(F.col("_label") == value)
        short = knn_between(rare, Sites(pool, key, vec, g, k)).select(*g, F.col("nbr").alias(key)).distinct()
        candidates = cut(pool.join(short, [*g, key], "left_semi"), "candidates")
        far = knn_between(Sites(candidates, key, vec, g, k), rare).groupBy(*g, F.col("key").alias(key)).agg(F.avg("dist").alias("mean_dist"))
        ranked = candidates.select(*g, key, "_label", "_n").join(far, [*g, key]).withColumn("_near", -F.col("mean_dist"))
        best = running_index(ranked, g, ["_near", key], "_place").where(F.col("_place") <= F.floor(F.col("_n") / share))
        kept.append(best.select(*g, key, F.col("_label").alias(label), "mean_dist"))
    return reduce(DataFrame.unionByName, kept)
