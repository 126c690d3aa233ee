"""Gradient-boosted forests of many groups at once, by histograms of gradients.

Every round grows a forest for each group, all trees level by level. A level is one job: tasks add up gradients and
Hessians by tree, node, column and bin, the sums of a node meet in one task, which picks its split, and the driver
gets one row for each node. A leaf weighs -G / (H + l2); a round adds ``step`` times the mean of its trees. Groups have
their own bins, class weights, settings, losses and early stop, and drop out when they are done.

Columns are read once and kept as one byte each, in blocks of rows with their margins; the margins of a few rounds are
added on the way and written with the blocks from time to time. So a pass reads bytes, not vectors, and no row or sum
of rows comes to the driver: it holds bin edges, nodes and losses.

Rows without a group column are one group. Missing values are not supported: fit complete rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 8192  # rows to a block
FOLDED = 64  # splits of a tree that is evaluated over whole columns
LARGE = 65536  # rows from which on margins are written every other round
FLUSH = 8 << 20  # sums that a task holds before it passes them on
TINY = 1e-16
PLACES = 6  # to which gains are compared, so that the order of sums does not decide
NODES_PER_TASK = 64
ONE = "_one"  # the group of rows without groups


@dataclass
class Round:
    """The trees of a round as rows of nodes, padded: column (-1 in a leaf), bin, children, weight."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, trees: list["Growing"]) -> "Round":
        wide = max(len(t.value) for t in trees)
        grid = lambda name, fill, kind: np.array([getattr(t, name) + [fill] * (wide - len(t.value)) for t in trees], kind)
        return cls(grid("feature", -1, np.int32), grid("split", 0, np.float64), grid("left", 0, np.int32), grid("right", 0, np.int32), grid("value", 0.0, np.float64))

    def leaves(self, columns: np.ndarray, tree: int) -> np.ndarray:
        """The node that each row of ``columns`` (one to a line) ends in; a value goes left up to the split.

        A tree of few nodes is folded up from its leaves over whole columns, another is walked down row by row.
        """
        feature, split, left, right = self.feature[tree], self.split[tree], self.left[tree], self.right[tree]
        if np.count_nonzero(feature >= 0) <= FOLDED:
            same = columns.dtype.type

            def end(node: int):
                if feature[node] < 0:
                    return np.uint8(node)  # a tree numbers its nodes as they come
                goes_left = (columns[feature[node]] <= same(split[node])).view(np.uint8)
                a, b = end(left[node]), end(right[node])
                return (a ^ b) * goes_left ^ b if a.ndim + b.ndim == 0 else (a ^ b) & -goes_left ^ b

            return np.broadcast_to(end(0), columns.shape[1])
        at = np.zeros(columns.shape[1], np.int32)
        rows = np.arange(len(at))
        while len(rows):
            f = feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            node = at[rows]
            at[rows] = np.where(columns[f, rows] <= split[node], left[node], right[node])
        return at

    def mean(self, columns: np.ndarray) -> np.ndarray:
        """The mean weight over the trees."""
        total = np.zeros(columns.shape[1])
        for t in range(len(self.value)):
            total += self.value[t].take(self.leaves(columns, t))
        return total / len(self.value)


class Growing:
    """One tree while it grows."""

    def __init__(self, columns: np.ndarray):
        self.columns = columns
        self.feature, self.split, self.left, self.right, self.value = [-1], [0.0], [0], [0], [0.0]
        self.active = [0]

    def child(self, weight: float) -> int:
        for held, fill in ((self.feature, -1), (self.split, 0.0), (self.left, 0), (self.right, 0), (self.value, weight)):
            held.append(fill)
        return len(self.value) - 1


@dataclass
class BoostedForest:
    """A sum of forests on the log-odds scale: every round adds ``step`` times one forest's mean."""

    step: float
    rounds: list[Round] = field(default_factory=list)  # splits are values of the columns
    train_loss: list[float] = field(default_factory=list)
    valid_loss: list[float] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for at in range(0, len(x), BLOCK):
            columns = np.ascontiguousarray(x[at : at + BLOCK].T, np.float64)
            for r in self.rounds:
                total[at : at + BLOCK] += self.step * r.mean(columns)
        return total

    def transform(self, df: DataFrame, vector: str = "features") -> DataFrame:
        """``df`` with ``prob``."""
        return score({ONE: self}, df, None, vector)

    def rows(self) -> list[tuple]:
        """(round, tree, node, column or -1, split, left, right, weight) of every node; weights count with the step and the trees' share."""
        out = []
        for i, r in enumerate(self.rounds):
            for t in range(len(r.value)):
                reached = {0} | set(r.left[t][r.feature[t] >= 0].tolist()) | set(r.right[t][r.feature[t] >= 0].tolist())
                out += [(i, t, n, int(r.feature[t][n]), float(r.split[t][n]), int(r.left[t][n]), int(r.right[t][n]), float(r.value[t][n])) for n in sorted(reached)]
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), NODES)

    @classmethod
    def of_rows(cls, rows: list[tuple], step: float) -> "BoostedForest":
        """The model of saved nodes, see ``rows``."""
        rounds: dict[int, dict[int, Growing]] = {}
        for i, t, n, f, s, left, right, value in sorted(tuple(r) for r in rows):
            tree = rounds.setdefault(i, {}).setdefault(t, Growing(np.zeros(0, int)))
            if n:
                tree.child(0.0)
            tree.feature[n], tree.split[n], tree.left[n], tree.right[n], tree.value[n] = f, s, left, right, value
        return cls(step, [Round.of([trees[t] for t in sorted(trees)]) for _, trees in sorted(rounds.items())])


NODES = "round int, tree int, node int, feature int, split double, left int, right int, value double"


def score(models: dict[str, BoostedForest], df: DataFrame, by: str | None, vector: str = "features", out: str = "prob") -> DataFrame:
    """``df`` with the probability by the model of each row's group, all groups and trees in one pass; null without a model.

    The models travel in a broadcast, as large as their nodes.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("double")
    def prob(group: pa.Array, x: pa.Array) -> pa.Array:
        names = group.dictionary_encode()
        codes = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        p, known = np.zeros(len(x)), np.zeros(len(x), bool)
        for i, name in enumerate(names.dictionary.to_pylist()):
            if name in shared.value:
                at = np.flatnonzero(codes == i)
                values = x.take(pa.array(at))
                wide = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                p[at], known[at] = 1.0 / (1.0 + np.exp(-shared.value[name].margin(wide))), True
        return pa.array(p, mask=~known)

    group = F.col(by).cast("string") if by else F.lit(ONE)
    return df.withColumn(out, prob(group, vector_to_array(vector)))


# --- bins --------------------------------------------------------------------------------------

def few_values(rows: DataFrame, width: int, bins: int) -> dict[tuple[str, int], list[float] | None]:
    """(group, column) to its values in order, or None if there are more than ``bins``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray | None] = {}
        for b in batches:
            for name, x in by_group(b.column(0), b.column(1)):
                for c in range(x.shape[1]):
                    old = held.get((name, c), np.zeros(0))
                    if old is not None:
                        new = np.unique(np.concatenate((old, x[:, c])))
                        held[name, c] = new if len(new) <= bins else None
        out = [(g, c, v) for (g, c), values in held.items() for v in ([None] if values is None else values.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.float64()))], ["grp", "col", "value"])

    found: dict[tuple[str, int], list | None] = {}
    seen = rows.mapInArrow(gather, "grp string, col int, value double").groupBy("grp", "col").agg(
        F.bool_or(F.col("value").isNull()).alias("many"), F.array_sort(F.collect_set("value")).alias("values"))
    for r in seen.collect():
        found[r["grp"], r["col"]] = None if r["many"] or len(r["values"]) > bins else r["values"]
    return found


def edges_of(rows: DataFrame, width: int, bins: int) -> dict[str, list[np.ndarray]]:
    """By group and column the upper ends of its bins: every value of a column with few, else quantiles."""
    few = few_values(rows, width, bins)
    groups = sorted({g for g, _ in few})
    many = sorted({c for (_, c), values in few.items() if values is None})
    shares = [k / bins for k in range(1, bins)]
    quantiles = {}
    if many:
        asked = [F.percentile_approx(F.get("x", F.lit(c)), shares, 10_000).alias(f"q{c}") for c in many]
        quantiles = {r["grp"]: r for r in rows.groupBy("grp").agg(*asked).collect()}
    out = {}
    for g in groups:
        out[g] = [np.unique(np.array(few[g, c][:-1] if few[g, c] is not None else quantiles[g][f"q{c}"], np.float64)) for c in range(width)]
    return out


def by_group(names: pa.Array, lists: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
    coded = names.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    for i, name in enumerate(coded.dictionary.to_pylist()):
        some = lists.take(pa.array(np.flatnonzero(codes == i)))
        yield name, some.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(some), -1)


def blocks_of(rows: DataFrame, edges) -> DataFrame:
    """Blocks of rows: grp, held (validation or not), block, n, and as bytes the bins, labels and margins."""
    names = ["held", "block", "n", "bins", "y", "m", "grp"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[str, bool], list] = {}
        count = TaskContext.get().partitionId() << 32

        def block(key: tuple[str, bool], parts: list) -> pa.RecordBatch:
            nonlocal count
            bins, y = (np.concatenate(c) for c in zip(*parts))
            count += 1
            row = [key[1], count - 1, len(y), bins.tobytes(), y.tobytes(), np.zeros(len(y)).tobytes(), key[0]]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)

        for b in batches:
            for held in (False, True):
                part = b.filter(pa.array(b.column(3).to_numpy(zero_copy_only=False) == held))
                ys = part.column(2).to_numpy().astype(np.uint8)
                coded = part.column(0).dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                for i, (name, x) in enumerate(by_group(part.column(0), part.column(1))):
                    if name not in edges.value:
                        continue  # a group without training rows
                    bins = np.stack([np.searchsorted(e, x[:, c], "left") for c, e in enumerate(edges.value[name])], 1).astype(np.uint8)
                    mine = waiting.setdefault((name, held), [])
                    y = ys[codes == i]
                    for at in range(0, len(y), BLOCK):
                        mine.append((bins[at : at + BLOCK], y[at : at + BLOCK]))
                        if sum(len(v) for _, v in mine) >= BLOCK:
                            yield block((name, held), waiting[name, held])
                            mine = waiting[name, held] = []
        for key, parts in waiting.items():
            if parts:
                yield block(key, parts)

    return rows.mapInArrow(pack, "held boolean, block long, n long, bins binary, y binary, m binary, grp string")


# --- rounds ------------------------------------------------------------------------------------

@dataclass
class Group:
    """What the driver knows of a group."""

    settings: dict
    weight: float  # of a positive row
    edges: list[np.ndarray]
    done: list[Round] = field(default_factory=list)  # splits are bins
    written: int = 0  # rounds that the blocks' margins hold
    trees: list[Growing] = field(default_factory=list)
    train_loss: list[float] = field(default_factory=list)
    valid_loss: list[float] = field(default_factory=list)
    best: int = -1
    stopped: bool = False

    def heard(self, train: float, valid: float | None, patience: int) -> None:
        """Losses after the last round; stops when ``patience`` rounds brought no gain."""
        self.train_loss.append(train)
        if valid is None:
            return  # without validation rows there is nothing to stop by
        self.valid_loss.append(valid)
        if self.best < 0 or valid < self.valid_loss[self.best]:
            self.best = len(self.valid_loss) - 1
        self.stopped = len(self.valid_loss) - 1 - self.best >= patience

    def plan(self) -> dict:
        return {"step": self.settings["step"], "weight": self.weight, "rounds": self.done[self.written :], "round": len(self.done),
                "seed": self.settings["seed"], "subsample": self.settings["subsample"], "now": Round.of(self.trees) if self.trees else None,
                "active": [t.active for t in self.trees], "columns": [t.columns for t in self.trees]}

    def model(self) -> BoostedForest:
        rounds = self.done[: self.best + 1] if self.best >= 0 else self.done
        named = []
        for r in rounds:
            split = np.zeros(r.split.shape)
            for f, e in enumerate(self.edges):
                at = r.feature == f
                split[at] = e[r.split[at].astype(int)] if at.any() else 0.0
            named.append(Round(r.feature, split, r.left, r.right, r.value))
        return BoostedForest(self.settings["step"], named, self.train_loss, self.valid_loss)


def numbers(block: dict, plan: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns of bins, labels, margins) of a block, with the rounds that are not written yet."""
    y = np.frombuffer(block["y"], np.uint8).astype(np.float64)
    columns = np.ascontiguousarray(np.frombuffer(block["bins"], np.uint8).reshape(len(y), -1).T)
    m = np.frombuffer(block["m"], np.float64).copy()
    for r in plan["rounds"]:
        m += plan["step"] * r.mean(columns)
    return columns, y, m


def level_sums(blocks: DataFrame, plans, bins: int, measure: bool) -> DataFrame:
    """(grp, tree, slot, sums) of the active nodes; with ``measure``, (grp, -1, 0, loss sums) too: weighted loss and weight of the
    training rows, loss and number of the validation rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int], np.ndarray] = {}
        size = 0

        def emit() -> pa.RecordBatch:
            keys = list(held)
            out = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
            sums = pa.array([held[k].tobytes() for k in keys], pa.binary())
            return pa.RecordBatch.from_arrays([*out, sums], ["grp", "tree", "slot", "sums"])

        for b in batches:
            for row in b.to_pylist():
                plan, name = plans.value[row["grp"]], row["grp"]
                x, y, m = numbers(row, plan)
                p = 1.0 / (1.0 + np.exp(-m))
                w = np.where(y == 1, plan["weight"], 1.0)
                if measure:
                    loss = np.logaddexp(0, np.where(y == 1, -m, m))
                    mine = np.array([0, 0, loss.sum(), len(y)]) if row["held"] else np.array([(w * loss).sum(), w.sum(), 0, 0])
                    held[name, -1, 0] = held.get((name, -1, 0), np.zeros(4)) + mine
                if row["held"] or plan["now"] is None:
                    continue
                g, h = w * (p - y), np.maximum(w * p * (1 - p), TINY)
                drawn = None
                if plan["subsample"] < 1:
                    rng = np.random.Generator(np.random.Philox(key=[plan["seed"] << 32 | plan["round"], row["block"]]))
                    drawn = rng.random((len(plan["active"]), len(y)), np.float32) < plan["subsample"]
                wide = x.astype(np.intp)
                for t, active in enumerate(plan["active"]):
                    if not active:
                        continue
                    slots = np.full(plan["now"].value.shape[1], -1)
                    slots[active] = np.arange(len(active))
                    slot = slots.take(plan["now"].leaves(x, t))
                    rows = np.flatnonzero(slot >= 0 if drawn is None else (slot >= 0) & drawn[t])
                    slot, n = slot.take(rows), len(active) * bins
                    first, mine = slot * bins, [v.take(rows) for v in (g, h)]
                    both = np.empty((len(active), len(plan["columns"][t]), bins, 2))
                    for j, c in enumerate(plan["columns"][t]):
                        at = first + wide[c].take(rows)
                        for k, v in enumerate(mine):
                            both[:, j, :, k] = np.bincount(at, v, n).reshape(len(active), bins)
                    for s in np.flatnonzero(np.bincount(slot, minlength=len(active))).tolist():
                        old = held.get((name, t, s))
                        if old is None:
                            held[name, t, s] = both[s]
                            size += both[s].size
                        else:
                            old += both[s]
                if size * 8 > FLUSH:
                    yield emit()
                    held.clear()
                    size = 0
        if held:
            yield emit()

    return blocks.mapInArrow(add, "grp string, tree int, slot int, sums binary")


def best_split(sums: np.ndarray, allowed: np.ndarray, l2: float, least: float) -> tuple[float, int, int, float, float]:
    """(gain, place of the column, bin, G and H left of it) of a node's best split; ties to the first column, then bin."""
    total = sums[0].sum(0)
    left = np.cumsum(sums, 1)
    right = total - left
    part = lambda v: v[..., 0] ** 2 / (v[..., 1] + l2)
    gain = np.round(part(left) + part(right) - part(total), PLACES)
    # what is left of a sum of Hessians after all of them are taken away is no Hessian
    enough = (left[..., 1] >= least) & (right[..., 1] >= least) & (np.minimum(left[..., 1], right[..., 1]) > 1e-9 * total[1])
    gain = np.where(enough & allowed[:, None], gain, -np.inf)
    c, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[c, b]), int(c), int(b), float(left[c, b, 0]), float(left[c, b, 1])


def splits(sums: DataFrame, plans, bins: int, nodes: int) -> list:
    """One row for each node (its best split and its sums), and the sums of losses."""
    names = ["grp", "tree", "slot", "gain", "column", "bin", "gl", "hl", "g", "h", "losses"]

    def pick(t: pa.Table) -> pa.Table:
        total: dict[tuple, np.ndarray] = {}
        for grp, tree, slot, raw in zip(*(t.column(c).to_pylist() for c in ("grp", "tree", "slot", "sums"))):
            mine = np.frombuffer(raw, np.float64)
            total[grp, tree, slot] = total[grp, tree, slot] + mine if (grp, tree, slot) in total else mine
        out = []
        for (grp, tree, slot), mine in total.items():
            if tree < 0:
                out.append((grp, tree, slot, None, None, None, None, None, None, None, mine.tolist()))
                continue
            plan = plans.value[grp]
            mine = mine.reshape(len(plan["columns"][tree]), bins, 2)
            gain, c, b, gl, hl = best_split(mine, plan["allowed"][tree][slot], plan["l2"], plan["least"])
            out.append((grp, tree, slot, gain, c, b, gl, hl, float(mine[0, :, 0].sum()), float(mine[0, :, 1].sum()), None))
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.list_(pa.float64()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 11, kinds)], names)

    tasks = 1 + nodes // NODES_PER_TASK
    bucket = F.pmod(F.xxhash64("grp", "tree", "slot"), F.lit(tasks))
    return sums.groupBy(bucket).applyInArrow(
        pick, "grp string, tree int, slot int, gain double, column int, bin int, gl double, hl double, g double, h double, losses array<double>").collect()


def grow(groups: dict[str, Group], table: DataFrame, bins: int, measure: bool) -> None:
    """One level of the groups' trees, and with ``measure`` the losses of the rounds before."""
    sc = table.sparkSession.sparkContext
    plans = {}
    for name, g in groups.items():
        s, plan = g.settings, g.plan()
        rng = np.random.default_rng([s["seed"], len(g.done), sum(len(t.value) for t in g.trees)])
        plan["allowed"] = []
        for t in g.trees:
            n = max(1, int(s["columns_node"] * len(t.columns)))
            chosen = np.zeros((len(t.active), len(t.columns)), bool)
            for row in chosen:
                row[rng.choice(len(t.columns), n, replace=False)] = True
            plan["allowed"].append(chosen)
        plans[name] = plan | {"l2": s["l2"], "least": s["min_child_weight"]}
    shared = sc.broadcast(plans)
    nodes = sum(len(t.active) for g in groups.values() for t in g.trees)
    found = splits(level_sums(table.where(F.col("grp").isin(list(groups))), shared, bins, measure), shared, bins, nodes)
    shared.unpersist()
    for name, g in groups.items():
        for t in g.trees:
            t.was, t.active = t.active, []
    for r in sorted((r for r in found if r["tree"] >= 0), key=lambda r: (r["grp"], r["tree"], r["slot"])):
        g = groups[r["grp"]]
        tree, s = g.trees[r["tree"]], g.settings
        at = tree.was[r["slot"]]
        tree.value[at] = -r["g"] / (r["h"] + s["l2"])
        if r["gain"] > 1e-6 and r["gain"] >= s["gamma"]:
            tree.feature[at], tree.split[at] = int(tree.columns[r["column"]]), float(r["bin"])
            for side, grad, hess in (("left", r["gl"], r["hl"]), ("right", r["g"] - r["gl"], r["h"] - r["hl"])):
                child = tree.child(-grad / (hess + s["l2"]))
                getattr(tree, side)[at] = child
                tree.active.append(child)
    if measure:
        for r in found:
            if r["tree"] < 0 and groups[r["grp"]].done:
                loss, weight, held, n = r["losses"]
                groups[r["grp"]].heard(loss / weight if weight else float("nan"), held / n if n else None, groups[r["grp"]].settings["patience"])


def rewritten(table: DataFrame, groups: dict[str, Group]) -> DataFrame:
    """The blocks of ``groups`` with the margins of all rounds so far."""
    shared = table.sparkSession.sparkContext.broadcast({name: g.plan() for name, g in groups.items()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = [numbers(row, shared.value[row["grp"]])[2].tobytes() for row in b.to_pylist()]
            at = b.schema.get_field_index("m")
            yield b.set_column(at, "m", pa.array(m, pa.binary()))

    kinds = ", ".join(f"{n} {t}" for n, t in table.dtypes)
    out = cut(table.where(F.col("grp").isin(list(groups))).mapInArrow(add, kinds), "boost", ("grp",))
    for g in groups.values():
        g.written = len(g.done)
    return out


DEFAULTS = {"rounds": 500, "trees": 96, "depth": 4, "gamma": 1.0, "step": 0.5, "min_child_weight": 8.0, "subsample": 0.8, "columns": 0.8, "columns_node": 0.8,
            "l2": 1.0, "patience": 20, "seed": 7}


def boosted_forests(train: DataFrame, valid: DataFrame | None, label: str, by: str | None = None, bins: int = 48, cut_every: int = 8,
                    settings: dict[str, dict] | None = None, vector: str = "features", **common) -> dict[str, BoostedForest]:
    """A boosted forest for each group of ``by``, stopping early on its validation log loss.

    ``common`` and, by group, ``settings`` replace ``DEFAULTS``: ``columns`` is the share of columns a tree draws,
    ``columns_node`` the share of those a node draws, ``subsample`` the share of rows a tree draws, ``min_child_weight`` the
    least sum of Hessians in a child, ``gamma`` the least gain of a split.
    """
    if not 2 <= bins <= 256:
        raise ValueError("bins must be 2 to 256")
    for given in (common, *(settings or {}).values()):
        if set(given) - set(DEFAULTS):
            raise TypeError(f"unknown settings {sorted(set(given) - set(DEFAULTS))}")
    group = F.col(by).cast("string") if by else F.lit(ONE)
    read = lambda df, held: df.select(group.alias("grp"), vector_to_array(vector).alias("x"), F.col(label).cast("int").alias("y"), F.lit(held).alias("held"))
    rows = read(train, False).where("grp IS NOT NULL")
    counts = {r["grp"]: r for r in rows.groupBy("grp").agg(F.count_if(F.col("y") == 0).alias("n0"),
                                                          F.count_if(F.col("y") == 1).alias("n1"), F.max(F.size("x")).alias("p")).collect()}
    if not counts:
        raise ValueError("there are no training rows")
    width = max(r["p"] for r in counts.values())
    edges = edges_of(rows, width, bins)
    every = rows if valid is None else rows.unionByName(read(valid, True).where("grp IS NOT NULL"))
    # every pass to come reads what is dealt here: as many even tasks as there are cores, at least
    cores = train.sparkSession.sparkContext.defaultParallelism
    every = every.repartition(cores * -(-every.rdd.getNumPartitions() // cores))  # small files are read by as many to a task
    table = cut(blocks_of(every, train.sparkSession.sparkContext.broadcast(edges)), "boost", ("grp",))
    bins = 1 + max((len(e) for held in edges.values() for e in held), default=1)

    groups = {}
    for name, r in sorted(counts.items()):
        own = {**DEFAULTS, **common, **(settings or {}).get(name, {})}
        groups[name] = Group(own, r["n0"] / r["n1"] if r["n0"] and r["n1"] else 1.0, edges[name])
    open_ = dict(groups)
    while True:
        for name, g in open_.items():
            s, rng = g.settings, np.random.default_rng([g.settings["seed"], len(g.done)])
            some = max(1, int(s["columns"] * width))
            g.trees = [Growing(np.sort(rng.choice(width, some, replace=False))) for _ in range(s["trees"])] if len(g.done) < s["rounds"] else []
        level = 0
        while True:
            growing = {n: g for n, g in open_.items() if level == 0 or (any(t.active for t in g.trees) and level < g.settings["depth"])}
            if not growing:
                break
            grow(growing, table, bins, level == 0)
            if level == 0:
                open_ = {n: g for n, g in open_.items() if not g.stopped and g.trees}
            level += 1
        for g in open_.values():
            g.done.append(Round.of(g.trees))
            g.trees = []
        if not open_:
            return {name: g.model() for name, g in groups.items()}
        large = sum(counts[n]["n0"] + counts[n]["n1"] for n in open_) >= LARGE  # there a job costs less than its trees in every pass
        if max(len(g.done) - g.written for g in open_.values()) >= (min(2, cut_every) if large else cut_every):
            table = rewritten(table, open_)


def boosted_forest(train: DataFrame, valid: DataFrame | None, label: str, **settings) -> BoostedForest:
    """One boosted forest for all rows, see ``boosted_forests``."""
    return boosted_forests(train, valid, label, **settings)[ONE]


def boosted_trees(train: DataFrame, label: str, rounds: int, depth: int, step: float = 0.3, gamma: float = 0.0, **settings) -> BoostedForest:
    """Class-weighted gradient-boosted trees: one tree a round, on all rows and columns."""
    whole = {"trees": 1, "subsample": 1.0, "columns": 1.0, "columns_node": 1.0, "min_child_weight": 1.0, "bins": 256, **settings}
    return boosted_forest(train, None, label, rounds=rounds, depth=depth, step=step, gamma=gamma, **whole)
