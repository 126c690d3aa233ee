"""Shards of near equal bytes: a minimax contiguous partition of groups of equal texts.

A group is all documents of one text and never parts. Groups that hold a fair share or more of what is left, the
largest first, come first in the order and fill a shard each, so that the rest is dealt evenly over the others; there
are fewer of them than shards. All other groups lie in the order of a hash of their text, and shards are contiguous
stretches of them. The capacity is the smallest at which the greedy fill, which closes a shard when the next group
would exceed it and gives a group above it a shard of its own, needs no more shards than there are. No contiguous
partition of the groups in this order has a smaller largest shard.

The driver searches with sums of blocks (ranges of the hash, 4,096 at first) in place of groups. A walk over
blocks gives a lower and an upper bound for each cut; where they leave a capacity undecided, Spark adds up the parts of
just those blocks that the walks touch. So the driver holds a bounded number of sums whatever the corpus, and the cuts
are exact. A document's shard follows from its hash and the cuts, as literals, without a join.

Defined cases: a null text has no bytes and is in one group with the empty text; repeated rows are rows of their own and
null ids are numbered first; with fewer groups than shards the last shards stay empty; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import running_index
from .common import settle

BITS = 60
FIRST, FINER = 12, 6  # bits of the hash that tell the first blocks apart, and parts of a block
AT_ONCE = 12  # capacities that one round looks into
RANGES = 32  # ranges of hashes that a round's scan is limited to
OVERHEAD = 8


def place_of(text: Column) -> Column:
    """The first 60 bits of the text's MD5: where its group lies."""
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


class Blocks:
    """Sums of ranges of the hash, in order: (prefix, shift, bytes, bytes of the first group, its hash, groups)."""

    def __init__(self, rows: list[tuple]):
        self.rows = sorted(rows, key=lambda r: r[0] << r[1])
        self.index()

    def index(self) -> None:
        self.last = np.cumsum([r[2] for r in self.rows], dtype=np.int64).tolist()  # where a block ends
        self.first = [end - r[2] + r[3] for end, r in zip(self.last, self.rows)]  # where its first group ends
        self.total = self.last[-1]

    def fit(self, p: int, capacity: int) -> tuple[int, int, set[int]]:
        """Bounds of the end of the shard that begins at byte p, and the blocks that keep them apart."""
        x = p + capacity
        b = bisect_right(self.first, x) - 1
        low = high = 0
        if b >= 0:
            low, high = (self.last[b], self.last[b]) if self.last[b] <= x else (self.first[b], x)
        # a shard holds one group at least
        j = bisect_right(self.last, p)
        if j == len(self.last):
            return self.total, self.total, set()
        one = (self.first[j], self.first[j]) if self.first[j] > p else (p + 1, self.last[j])
        blur = ({b} if low < high else set()) | ({j} if one[0] < one[1] and one[1] > low else set())
        return max(low, one[0]), max(high, one[1]), blur

    def walk(self, capacity: int, shards: int, upper: bool) -> tuple[list[int], set[int]]:
        """Bounds, lower or upper ones, of the ends of the shards."""
        p, ends, blur = 0, [], set()
        for _ in range(shards):
            low, high, more = self.fit(p, capacity)
            p = high if upper else low
            ends.append(p)
            blur |= more
        return ends, blur

    def least(self, shards: int, upper: bool) -> int:
        """The smallest capacity whose walk reaches the end."""
        lo, hi = 0, self.total
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.walk(mid, shards, upper)[0][-1] >= self.total else (mid + 1, hi)
        return lo

    def bound(self, end: int) -> int:
        """The hash from which on groups lie behind the byte ``end``, where a group ends."""
        b = bisect_right(self.last, end) - 1
        if b >= 0 and self.last[b] == end:
            return (self.rows[b][0] + 1) << self.rows[b][1]
        return self.rows[bisect_right(self.first, end) - 1][4] + 1


def sums(groups: DataFrame, shift: int) -> DataFrame:
    out = groups.groupBy(F.shiftright("place", shift).alias("prefix"), F.lit(shift).alias("shift"))
    return out.agg(F.sum("bytes").alias("bytes"), F.min_by("bytes", "place").alias("one"), F.min("place").alias("at"), F.count("*").alias("n"))


def covering(spans: list[tuple[int, int]], most: int) -> list[list[int]]:
    """At most ``most`` ranges that hold all of ``spans``."""
    spans = sorted(spans)
    gaps = sorted((b[0] - a[1] for a, b in zip(spans, spans[1:])), reverse=True)
    wide = gaps[most - 1] if len(gaps) >= most else 0
    out = [list(spans[0])]
    for lo, hi in spans[1:]:
        if lo - out[-1][1] > wide:
            out.append([lo, hi])
        else:
            out[-1][1] = hi
    return out


def refine(groups: DataFrame, blocks: Blocks, which: set[int]) -> None:
    """The blocks ``which`` in parts."""
    rows = [blocks.rows[i] for i in which]
    spans = covering([(r[0] << r[1], (r[0] + 1) << r[1]) for r in rows], RANGES)
    here = groups.where(" OR ".join(f"place >= {a} AND place < {b}" for a, b in spans))
    parts = []
    for shift in sorted({r[1] for r in rows}):
        mine = here.where(F.shiftright("place", shift).isin([r[0] for r in rows if r[1] == shift]))
        parts += [tuple(r) for r in sums(mine, max(0, shift - FINER)).collect()]
    blocks.rows = sorted([r for i, r in enumerate(blocks.rows) if i not in which] + parts, key=lambda r: r[0] << r[1])
    blocks.index()


def cuts_of(groups: DataFrame, shards: int) -> list[int]:
    """The hashes at which shards 1, 2, ... begin; ``groups`` has place and bytes."""
    first = [tuple(r) for r in sums(groups, BITS - FIRST).collect()]
    if not first:
        return []
    blocks = Blocks(first)
    while True:
        lo, hi = blocks.least(shards, True), blocks.least(shards, False)
        tried = sorted({lo + (hi - lo) * k // AT_ONCE for k in range(AT_ONCE + 1)})
        blur = set()
        for capacity in tried:
            low, a = blocks.walk(capacity, shards, False)
            high, b = blocks.walk(capacity, shards, True)
            blur |= a | b if low != high else set()
        if lo == hi and not blur:
            return [blocks.bound(e) for e in low[:-1] if e < blocks.total]
        refine(groups, blocks, {i for i in blur if blocks.rows[i][5] > 1})


def large_groups(groups: DataFrame, shards: int) -> list[int]:
    """The groups that fill a shard: each is at least a fair share of what it and the smaller ones hold."""
    left, aside = groups.agg(F.sum("bytes")).first()[0] or 0, []
    for r in groups.orderBy(F.desc("bytes"), "place").limit(shards).collect():
        if r["bytes"] * (shards - len(aside)) < left:
            break
        left -= r["bytes"]
        aside.append(r["place"])
    return sorted(aside)


def shard(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size (UTF-8 bytes and ``OVERHEAD``), text_crc32, place, shard and slot (0, 1, ... by place and key) of every row."""
    said = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), (F.octet_length(said) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(said.cast("binary")).alias("text_crc32"), place_of(said).alias("place"), F.monotonically_increasing_id().alias("row"))
    rows = settle(rows, "sizes")
    groups = settle(rows.groupBy("place").agg(F.sum("size").alias("bytes")).repartitionByRange("place").sortWithinPartitions("place"), "groups")
    aside = large_groups(groups, shards)
    at = F.lit(len(aside))
    for c in cuts_of(groups.where(~F.col("place").isin(aside)), shards - len(aside)):
        at = at + (F.col("place") >= c).cast("int")
    for i, place in enumerate(aside):
        at = F.when(F.col("place") == place, i).otherwise(at)
    numbered = running_index(rows.withColumn("shard", at.cast("int")), ["shard"], ["place", "key", "row"], "slot")
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", "place", "shard", (F.col("slot") - 1).cast("long").alias("slot"))
