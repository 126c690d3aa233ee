"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints that differ in at most ``tau`` bits must, for any partition of the bits and any thresholds T with
the sum of (T + 1) equal to tau + 1, differ in at most T bits of some part. Correlated bits are grouped into the same
part; for each number of parts a dynamic program allocates the thresholds that cost least, by the number of keys a
fingerprint must be filed under and the number of candidate pairs that the bits' frequencies let expect over all
fingerprints. Distinct fingerprints are filed under every key within half the threshold of theirs, so that those within
the threshold share a key; pairs that share one are compared in full.

A bucket of more than ``SPLIT`` fingerprints is never held: its task passes the rows on, and Spark files them again under
more of their bits. Two that are close agree in all but tau of any bands, so each round takes more and narrower bands and
one key for each choice of those that agree; in the last one a bucket of tau up to 4 has 16 free bits, so that its size
has a bound however many texts come from one template.

Equal fingerprints count once, so copies are never paired. In a bucket only as many links are written as connect what
is linked there; the components of those links are those of all links.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other; rows that repeat are
one component; a null id stays, and its component has the smallest id that is not null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
SLICE_BYTES = 2 << 20
NEAR = 24  # buckets up to this size are compared pair by pair, larger ones by a search that visits each once
SPLIT = 20_000  # larger buckets are filed again under further bits
MOST_KEYS = 20_000  # of a fingerprint in a bucket that is filed again
NAMELESS = 1 << 62
ROW_COST, PAIR_COST = 1e-6, 1e-8  # seconds, for the plan only
ROWS_PER_TASK = 2_000_000


def shingles(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other as one buffer of words joined by single blanks (A-Z lower-cased), with the begin and
    end of every ``width``-word shingle in it and the number of shingles of each text."""
    begins = np.concatenate(([0], ends[:-1]))
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    sep = blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = True
    edge = edge[:-1]
    before = np.concatenate(([True], sep[:-1])) | edge
    start = np.flatnonzero(~sep & before)
    words = np.searchsorted(start, ends) - np.searchsorted(start, begins)
    first = np.zeros(len(start), bool)
    first[(np.cumsum(words) - words)[words > 0]] = True
    keep = ~sep
    glue = start[~first] - 1  # the separator before a word that follows another in its text
    keep[glue] = True
    out = np.where(sep, np.uint8(32), lower[data])[keep]
    place = np.cumsum(keep) - 1
    begin = place[start]
    after = np.concatenate((~sep[1:] & ~edge[1:], [False]))
    stop = place[np.flatnonzero(~sep & ~after)] + 1
    each = np.where(words > 0, np.maximum(1, words - (width - 1)), 0)
    word0 = np.cumsum(words) - words
    s0 = np.cumsum(each) - each
    left = np.repeat(word0 - s0, each) + np.arange(each.sum())
    right = left + np.repeat(np.minimum(words, width) - 1, each)
    return out.tobytes(), begin[left], stop[right], each


def fingerprint_bits(hashes: np.ndarray, each: np.ndarray) -> np.ndarray:
    """The fingerprint of each text from the hashes of its features (rows of bytes): a bit is set if set in over half."""
    out = np.zeros((len(each), hashes.shape[1] // 8), np.uint64)
    full = np.flatnonzero(each)
    if len(full):
        bits = np.unpackbits(hashes, axis=1, bitorder="little")
        begin = (np.cumsum(each) - each)[full]
        count = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * count > each[full][:, None], axis=1, bitorder="little").view(np.uint64)
    return out


def shingle_print(buffer: bytes, left: np.ndarray, right: np.ndarray, each: np.ndarray, seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    hashes = np.array([xxh64_intdigest(buffer[a:z], seed) for a, z in zip(left.tolist(), right.tolist())], np.uint64)
    return fingerprint_bits(hashes.view(np.uint8).reshape(-1, 8), each)


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and fp (64 bits as a signed long) of every row, from shingles of ``width`` words, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).fill_null("").cast(pa.large_binary())
            _, offsets, data = texts.buffers()
            offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            found, i = [np.zeros((0, 1), np.uint64)], 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
                found.append(shingle_print(*shingles(data[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i], width), seed))
                i = j
            prints = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints[:, 0].copy())], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


def bit_moments(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean of each bit, correlation of the bits) over all ``fp``; 64 rows of 65 numbers reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.unpackbits(b.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            both = x.T @ x
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BITS)), pa.array(np.full(BITS, len(x))), pa.array(both.tolist(), pa.list_(pa.float64()))], ["bit", "n", "both"])

    parts = prints.select("fp").mapInArrow(sums, "bit long, n long, both array<double>")
    rows = parts.groupBy("bit").agg(F.sum("n").alias("n"), *[F.sum(F.col("both")[j]).alias(f"s{j}") for j in range(BITS)]).collect()
    n = rows[0]["n"] if rows else 0
    both = np.zeros((BITS, BITS))
    for r in rows:
        both[r["bit"]] = [r[f"s{j}"] for j in range(BITS)]
    mean = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return n, mean, np.abs((both / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of even size; each takes the bits most correlated with those it has."""
    left, out = set(range(BITS)), []
    for size in (len(x) for x in np.array_split(np.arange(BITS), parts)):
        have = [max(sorted(left), key=lambda b: corr[b, sorted(left)].sum())]
        left.discard(have[0])
        while len(have) < size:
            have.append(max(sorted(left), key=lambda b: corr[b, have].sum()))
            left.discard(have[-1])
        out.append(sorted(have))
    return out


def within(mean: np.ndarray, most: int) -> float:
    """The chance that two fingerprints differ in at most ``most`` of the bits with these means."""
    chance = np.zeros(most + 2)
    chance[0] = 1
    for p in mean:
        r = 2 * p * (1 - p)
        chance[1:] = chance[1:] * (1 - r) + chance[:-1] * r
        chance[0] *= 1 - r
        chance[-1] = 0
    return float(chance[:-1].sum())


def plan(n: int, mean: np.ndarray, corr: np.ndarray, tau: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part in use, for the least estimated cost over all numbers of parts."""
    best: tuple[float, list] = (float("inf"), [])
    for parts in range(1, tau + 2):
        groups = group_bits(corr, parts)
        # cost[t] and choice of the first parts when they use up t of tau + 1 units
        table: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for bits in groups:
            after: dict[int, tuple[float, list]] = {}
            for used, (cost, chosen) in table.items():
                for threshold in range(-1, tau - used + 1):
                    price, own = 0.0, []
                    if threshold >= 0:
                        radius = (threshold + 1) // 2
                        keys = sum(1 for r in range(radius + 1) for _ in combinations(bits, r))
                        price = n * keys * ROW_COST + n * n * within(mean[bits], 2 * radius) * PAIR_COST
                        own = [(bits, threshold)]
                    to = used + threshold + 1
                    if to not in after or cost + price < after[to][0]:
                        after[to] = (cost + price, chosen + own)
            table = after
        if tau + 1 in table and table[tau + 1][0] < best[0]:
            best = table[tau + 1]
    return best[1]


def close(a: np.ndarray, b: np.ndarray, tau: int) -> np.ndarray:
    """Whether fingerprints differ in at most ``tau`` bits."""
    return np.bitwise_count(a ^ b) <= tau


def forest(fps: np.ndarray, ids: np.ndarray, tau: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all rows of ``fps`` that links connect, at most one less than there are in each part."""
    if len(fps) <= SPLIT:
        return walk(fps, ids, tau)
    out = []  # rows that link agree in one of tau + 1 bands
    for band in np.array_split(np.arange(BITS, dtype=np.uint64), tau + 1):
        key = fps & np.bitwise_or.reduce(np.uint64(1) << band)
        order = np.argsort(key, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            if len(part) > 1:
                out += walk(fps[part], ids[part], tau)
    return out


def walk(fps: np.ndarray, ids: np.ndarray, tau: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Visits every row once: from each, what is close and not yet reached is linked to it and visited later."""
    out, left, todo = [], np.arange(len(fps)), []
    while len(left):
        if todo:
            p = todo.pop()
        else:
            p, left = left[0], left[1:]
        near = close(fps[left], fps[p], tau)
        if near.any():
            found = left[near]
            out.append((np.full(len(found), ids[p]), ids[found]))
            todo.extend(found.tolist())
            left = left[~near]
    return out


FILED = ["part", "key", "node", "fp"]
FILED_AS = "part int, key long, node long, fp long"


def finer(tau: int) -> list[list[tuple[np.uint64, np.ndarray]]]:
    """Masks of the rounds after the first: of ever more bands, all choices that two close fingerprints may agree in."""
    rounds = []
    for bands in sorted({tau + 1, tau + 2, 2 * tau, 4 * tau}):
        if tau < bands <= BITS and comb(bands, tau) <= MOST_KEYS:
            one = [sum(1 << int(b) for b in band) for band in np.array_split(np.arange(BITS), bands)]
            rounds.append([(np.uint64(sum(some)), np.zeros(1, np.uint64)) for some in combinations(one, bands - tau)])
    return rounds


def planned(parts: list[tuple[list[int], int]]) -> list[tuple[np.uint64, np.ndarray]]:
    """(bits, flips of them) of each part in use."""
    out = []
    for bits, threshold in parts:
        flips = [sum(1 << b for b in some) for r in range((threshold + 1) // 2 + 1) for some in combinations(bits, r)]
        out.append((np.uint64(sum(1 << b for b in bits)), np.array(flips, np.uint64)))
    return out


def file_rows(prints: DataFrame, masks: list[tuple[np.uint64, np.ndarray]]) -> DataFrame:
    """``prints`` (node, fp) under its bits of each mask, with each of the mask's flips."""
    keys = sum(len(flips) for _, flips in masks)

    def file_under(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = 1 + 200_000 // keys
            for i in range(0, b.num_rows, step):
                rows = b.slice(i, step)
                fp = rows.column(1).to_numpy().view(np.uint64)
                part, key = [], []
                for number, (whole, flips) in enumerate(masks):
                    key.append(((fp[:, None] ^ flips) & whole).ravel())
                    part.append(np.full(len(key[-1]), number, np.int32))
                again = pa.array(np.concatenate([np.repeat(np.arange(len(fp)), len(flips)) for _, flips in masks]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part)), pa.array(np.concatenate(key).view(np.int64)), *(c.take(again) for c in rows.columns)], FILED)

    return prints.select("node", "fp").mapInArrow(file_under, FILED_AS)


def compared(filed: DataFrame, tasks: int, tau: int, last: bool) -> DataFrame:
    """Links (part -1, the two nodes as node and fp), and the rows of buckets that are too large unless this is the last round."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(cols) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], FILED)

        def edges(cols: list[np.ndarray]):
            ids, fps = cols[2], cols[3].view(np.uint64)
            bucket = np.cumsum(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in cols[:2]], axis=0))))
            size = np.bincount(bucket)[bucket]
            if not last and (size > SPLIT).any():
                yield rows([c[size > SPLIT] for c in cols])
            some = np.flatnonzero((size > 1) & (size <= NEAR))
            found = []
            for d in range(1, NEAR):
                pair = np.flatnonzero(bucket[some[d:]] == bucket[some[:-d]])
                if not len(pair):
                    break
                a, b = some[pair], some[pair + d]
                near = close(fps[a], fps[b], tau)
                found.append((ids[a[near]], ids[b[near]]))
            many = np.flatnonzero((size > NEAR) & (last | (size <= SPLIT)))
            for group in np.split(many, np.flatnonzero(np.diff(bucket[many])) + 1):
                if len(group):
                    found += forest(fps[group], ids[group], tau)
            found = [x for x in found if len(x[0])]
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                both = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1)
                yield rows([np.full(both.shape[1], -1, np.int32), np.zeros(both.shape[1], np.int64), both[0], both[1]])

        held: list[list[np.ndarray]] = []  # what has come of the last bucket, which may go on in the next batch
        passing = None  # a bucket that turned out too large and is passed on
        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            if passing is not None and b.num_rows:
                more = int(np.argmin(np.concatenate((np.all([c == v for c, v in zip(cols, passing)], axis=0), [False]))))
                if more:
                    yield rows([c[:more] for c in cols])
                cols = [c[more:] for c in cols]
                passing = passing if not len(cols[0]) else None
            if not len(cols[0]):
                continue
            other = np.flatnonzero(np.any([c != c[-1] for c in cols[:2]], axis=0))
            if held or len(other):
                cut = other[-1] + 1 if len(other) else 0
                same = held and cut == 0 and all(h[-1] == c[0] for h, c in zip(held[-1][:2], cols))
                if not same:
                    yield from edges([np.concatenate(x) for x in zip(*held, [c[:cut] for c in cols])])
                    held, cols = [], [c[cut:] for c in cols]
            held.append(cols)
            if not last and sum(len(h[0]) for h in held) > SPLIT:
                passing = [c[-1] for c in held[-1][:2]]
                for h in held:
                    yield rows(h)
                held = []
        if held:
            yield from edges([np.concatenate(x) for x in zip(*held)])

    return filed.repartition(tasks, "part", "key").sortWithinPartitions("part", "key").mapInArrow(compare, FILED_AS)


def links(prints: DataFrame, n: int, parts: list[tuple[list[int], int]], tau: int) -> DataFrame:
    """(a, b): links among the nodes of ``prints`` (node, fp) that connect what any links connect."""
    least = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    masks, found, rounds = planned(parts), None, finer(tau)
    while True:
        tasks = max(least, 1 + n * sum(len(flips) for _, flips in masks) // ROWS_PER_TASK)
        out = settle(compared(file_rows(prints, masks), tasks, tau, not rounds), "buckets")
        edges = out.where("part = -1").select(F.col("node").alias("a"), F.col("fp").alias("b"))
        found = edges if found is None else found.union(edges)
        prints = out.where("part >= 0").select("node", "fp").distinct()
        n = prints.count()
        if not n:
            return found
        masks, rounds = rounds[0], rounds[1:]


def near_duplicates(docs: DataFrame, width: int = 4, seed: int = 42, tau: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp and component_id (the smallest id that links reach, the row's own included) of every row.

    Links: at most ``tau`` differing bits of the fingerprint, see ``fingerprints``.
    """
    prints = settle(fingerprints(docs, width, seed, key, text), "fingerprints")
    # a node is a fingerprint, named by its smallest id; one that has none gets a name beyond all ids
    node = F.coalesce(F.min(key).cast("long"), F.lit(NAMELESS) + F.pmod(F.xxhash64("fp"), F.lit(1 << 61)))
    distinct = settle(prints.groupBy("fp").agg(node.alias("node")).select("node", "fp"), "distinct")
    n, mean, corr = bit_moments(distinct)
    if not n:
        return prints.withColumn("component_id", F.col(key).cast("long"))
    roots = components(links(distinct, n, plan(n, mean, corr, tau), tau)).withColumnRenamed("node", "other")
    named = distinct.join(roots, F.col("node") == F.col("other"), "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    shown = F.when(F.col("component_id") < NAMELESS, F.col("component_id"))
    return prints.join(settle(named, "named"), "fp").select(key, "fp", shown.alias("component_id"))


def hex16(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
