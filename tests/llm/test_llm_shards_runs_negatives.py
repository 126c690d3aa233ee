"""Sharding, periodic runs and hard negatives against brute force, and their defined cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import negatives, periodic, sharding
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CLASH = ("key", "row", "place", "size", "shard", "slot", "runs", "n_words", "start", "leaf", "dim", "id", "low", "rank", "cell", "window")


def clashing(df):
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df


# --- sharding ----------------------------------------------------------------------------------

def fill(sizes, shards, capacity):
    """Ends of greedy shards, in groups."""
    ends, i = [], 0
    while i < len(sizes):
        held, i = sizes[i], i + 1
        while i < len(sizes) and held + sizes[i] <= capacity:
            held, i = held + sizes[i], i + 1
        ends.append(i)
    return ends


def largest_shard(sizes, shards):
    """The smallest possible largest shard of contiguous partitions, by dynamic programming."""
    before = np.concatenate(([0], np.cumsum(sizes)))
    best = before[1:].astype(float)
    for _ in range(shards - 1):
        best = np.array([min([best[j]] + [max(best[j - i - 1] if j - i else 0, before[j + 1] - before[j - i]) for i in range(j + 1)]) for j in range(len(sizes))])
    return int(best[-1])


@pytest.mark.parametrize("first, finer, kind", [(2, 1, "even"), (3, 2, "hot"), (1, 4, "hot"), (2, 3, "mixed"), (12, 6, "few")])
def test_cuts_are_the_best(spark, monkeypatch, first, finer, kind):
    monkeypatch.setattr(sharding, "FIRST", first)
    monkeypatch.setattr(sharding, "FINER", finer)
    monkeypatch.setattr(sharding, "RANGES", 3)
    rng = random.Random(first)
    n = {"few": 4}.get(kind, 70)
    places = sorted(rng.sample(range(1 << 60), n - n // 3) + [(5 << 40) + i for i in range(n // 3)])
    sizes = [rng.randint(8, 50) if kind == "even" else rng.choice([8, 20, 3000, 900]) if kind == "mixed" else rng.randint(8, 90) for _ in places]
    if kind == "hot":
        sizes[20], sizes[21], sizes[50] = 4000, 9, 1500
    shards = 6
    got = sharding.cuts_of(spark.createDataFrame(list(zip(places, sizes)), "place long, bytes long"), shards)
    low = min(c for c in range(sum(sizes) + 1) if len(fill(sizes, shards, c)) <= shards)
    want = fill(sizes, shards, low)
    assert [sum(p < c for p in places) for c in got] == want[:-1]
    held = [sum(sizes[a:z]) for a, z in zip([0, *want], want)]
    assert max(held) == largest_shard(sizes, shards)


def test_shards_of_documents(spark):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "naïve 中"), (3, "naïve 中"), (4, "w " * 100_000)] + [(10 + i, "copy of a text " * 20) for i in range(300)]
    rows += [(1000 + i, f"text {i} " * (i % 50)) for i in range(400)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sharding.shard(df, 8).collect()
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) <= set(range(8))
    for held in shards.values():
        held.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in held] == list(range(len(held)))
        assert [(r["place"], r["doc_id"] or -1) for r in held] == sorted((r["place"], r["doc_id"] or -1) for r in held)
    assert len({(r["shard"]) for r in got if r["size"] == 8}) == 1 and len({r["shard"] for r in got if 10 <= (r["doc_id"] or 0) < 310}) == 1
    held = sorted(sum(r["size"] for r in x) for x in shards.values())
    assert held[-2:] == [300 * 308, 200_008] and held[-3] < 1.05 * np.mean(held[:-2]) and held[0] > 0.9 * np.mean(held[:-2])


def test_no_documents(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(none, F.col("vec_id") > 0).count() == 0


# --- periodic runs -----------------------------------------------------------------------------

def runs_of(x, least=6, exponent=4):
    """All runs, each period's equal stretches walked word by word."""
    out = {}
    for p in range(1, len(x) // exponent + 1):
        i = 0
        while i + p < len(x):
            if x[i] != x[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(x) and x[i] == x[i + p]:
                i += 1
            if i - s + p >= max(least, exponent * p):
                out.setdefault((s, i - s + p), p)
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def answer(text, made=None):
    """The row that the contract states for one text."""
    w = (text or "").encode().split()
    n = len(w)
    if made is not None and made % 10 == 0 and n:
        g = made // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = (None,) * 4
    for s, m, p in sorted(runs, key=lambda r: (r[0], r[2])):
        if best[0] is None or m * best[2] > best[1] * p:
            best = (s, m, p, 1000 * m // p)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *best, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_periodic_runs_query(spark):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    small = {i: t for i, t in docs.items() if len((t or "").split()) < 3000}
    assert set(got) == set(docs) and len(small) > 150
    assert {i: got[i] for i in small} == {i: answer(t, zlib.crc32(str(i).encode())) for i, t in small.items()}
    assert sum(v[0] > 0 for v in got.values()) > 10


def test_finder_by_brute_force(monkeypatch):
    monkeypatch.setattr(periodic, "TEMPLATE", 300)
    monkeypatch.setattr(periodic, "CHUNK", 50)
    rng, finder = random.Random(1), periodic.Finder()
    for _ in range(400):
        n, k = rng.choice([0, 1, 5, 6, 7, 20, 90, 290, 700]), rng.choice([1, 2, 3, 20])
        x = [rng.randint(1, k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randrange(8))
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        assert [tuple(r) for r in finder.runs(np.array(x, np.int64)).tolist()] == runs_of(x)


def test_extensions():
    rng = random.Random(2)
    for _ in range(60):
        n, k = rng.randint(2, 300), rng.choice([1, 2, 5])
        x = [rng.randint(1, k) for _ in range(n)]
        x = (x[: rng.randint(1, n)] * n)[:n]
        i = np.array([rng.randrange(n - 1) for _ in range(80)])
        j = np.array([rng.randint(a + 1, n) for a in i.tolist()])
        want = [next((m for m in range(n) if b + m >= n or x[a + m] != x[b + m]), n) for a, b in zip(i.tolist(), j.tolist())]
        assert periodic.Extensions(np.array(x, np.int64))(i, j).tolist() == want


def test_cover_brings_all_places_together():
    r = np.arange(periodic.MODULUS)
    for a in range(periodic.MODULUS):
        assert np.isin((a + periodic.SHIFT[a]) % periodic.MODULUS, periodic.COVER).all()
        assert np.isin((r + periodic.SHIFT[a]) % periodic.MODULUS, periodic.COVER).all()


def test_periodic_edges(spark):
    long = " ".join(f"w{i % 5000}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "\t\n"), (4, "a a a a a"), (5, "a\ta\na  a a a"), (6, "x b a b a b a b a b a b"), (None, "k k k k k k"), (7, long), (7, long),
            (8, "é é é é é é é é é é é é"), (9, "a b c d e f"), (10, "q " + "a a a a a a a b " * 4)]
    got = periodic.periodic_runs(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and all(by[i]["n_runs"] == 0 and by[i]["runs"] == [] and by[i]["start"] is None for i in (1, 2, 3, 4, 9))
    assert by[1]["collapsed"] == by[2]["collapsed"] == by[3]["collapsed"] == "" and by[4]["collapsed"] == "a a a a a"
    assert (by[5]["start"], by[5]["length"], by[5]["period"], by[5]["exponent_milli"], by[5]["collapsed"]) == (0, 6, 1, 6000, "a")
    assert (by[6]["start"], by[6]["length"], by[6]["period"], by[6]["collapsed"]) == (1, 11, 2, "x b a")
    assert by[None]["collapsed"] == "k" and by[8]["collapsed"] == "é é"
    assert [tuple(r) for r in by[7]["runs"]] == [(0, 40_000, 5000)] and by[7]["collapsed"].split() == [f"w{i}" for i in range(5000)]
    assert [tuple(r) for r in by[10]["runs"]] == [(1, 7, 1), (1, 32, 8), (9, 7, 1), (17, 7, 1), (25, 7, 1)] and by[10]["start"] == 1 and by[10]["period"] == 1


# --- hard negatives ----------------------------------------------------------------------------

def mined(rows, is_anchor, positives=5, negatives_=5, scale=256):
    """Every anchor against every row, in whole numbers of any size."""
    kept = []
    for n, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((n, i, label, [int(np.floor(scale * float(np.float32(x)))) for x in v]))
    out, limit = [], negatives.LONG
    for n, i, label, v in kept:
        if not is_anchor(i):
            continue
        scored = sorted((-max(-limit, min(limit, sum(a * b for a, b in zip(v, w)))), j, m, k) for m, j, k, w in kept if m != n and len(w) == len(v))
        for s, j, _, _ in [x for x in scored if x[3] == label][:positives]:
            some = [(-t, m) for t, m, _, k in scored if k != label and 80 * -s <= 100 * -t <= 100 * -s][:negatives_]
            out += [(i, j, r + 1, m, -s, t) for r, (t, m) in enumerate(some)]
    return sorted(out)


@pytest.mark.parametrize("cell, chunk, leaf, fan", [(16_384, 1_024, 96, 8), (40, 3, 5, 3), (7, 2, 2, 2)])
def test_hard_negatives_by_brute_force(spark, monkeypatch, cell, chunk, leaf, fan):
    for name, value in (("CELL", cell), ("CHUNK", chunk), ("LEAF", leaf), ("FAN", fan), ("TILE", 5)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(cell)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), (centres[i % 6] * (1 + i % 3) + 0.2 * rng.normal(size=8)).tolist(), int(rng.integers(0, 3))) for i in range(500)]
    rows += [(1000 + i, [1.0] * 8, i % 4) for i in range(150)]  # copies
    rows += [(7, rows[3][1], 1), (100, rows[100][1], rows[100][2]), (100, rows[100][1], rows[100][2]), (300, rows[100][1], 2)]  # ids that recur
    rows += [(None, [1.0] * 8, 1), (2000, None, 1), (2001, [1.0] * 8, None), (2002, [float("nan")] * 8, 1), (2003, [None] * 8, 1), (2004, [float("inf")] * 8, 1),
             (2100, [1.0, 2.0], 1), (2101, [1.0, 2.0], 1), (2102, [1.0, 1.9], 2), (2200, [], 1), (2201, [], 1), (2202, [], 2), (2300, [-1.0] * 8, 9)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5))
    got = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == mined(rows, lambda i: i % 100 == 0)


def test_scores_beyond_doubles(spark):
    rows = [(100, [3e30, 1.0], 1), (1, [2e30, 1.0], 1), (2, [1e30, 0.0], 2), (200, [1e9, 7.0], 1), (3, [1e9, 3.0], 1), (4, [1e9, 2.0], 2), (5, [1e9, 4.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == mined(rows, lambda i: i % 100 == 0)


def test_siblings_are_ruled_out():
    """On clustered vectors most leaves are never visited, and none that holds an answer is left out."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * (np.repeat(rng.normal(size=(20, 16)), 100, 0) + 0.02 * rng.normal(size=(2000, 16))))
    tree = negatives.Tree(x[rng.permutation(2000)[:800]])
    leaf, ranges, norms = tree.leaf_of(x), {}, {}
    square = (x * x).sum(1)
    for node, rows, d, home in tree.descend(x):
        for c in np.unique(home).tolist():
            ranges[node, c] = d[home == c].min(0), d[home == c].max(0)
            norms[node, c] = square[rows[home == c]].min(), square[rows[home == c]].max()
    q = x[::50]
    scores = q @ x.T
    top = np.sort(scores, 1)[:, -5].astype(np.int64)
    alive = tree.alive(q, [np.array([t]) for t in top], [np.array([negatives.LONG])] * len(q), ranges, norms)
    assert all(alive[i, leaf[j]] for i, j in zip(*np.nonzero(scores >= top[:, None])))
    assert tree.leaves > 15 and alive.mean() < 0.2
