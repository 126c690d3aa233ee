"""Periodic runs of words: all maximal repetitions of a high exponent, by longest common extensions.

A run is a stretch of words with smallest period q that repeats it ``exponent`` times or more, has ``least`` words or
more, and that no neighbour extends. For each period p the places 0, 2p, 4p, ... are looked at (a harmonic grid): a run of
four periods or more covers a place and the period behind it, so a few equal words there select it, and the longest
common extensions of (i, i + p) to both sides give its ends. Multiples of a run's period find the same ends; the
smallest period stays.

Extensions are answered from a difference cover: of the suffixes only those at places whose remainder modulo 31 lies in
the cover are sorted (first by 31 words, then by doubling). Two places are compared word by word until both are
sampled, which takes 30 words at most, and the rest is a range minimum over the sorted samples' common prefixes, from a
sparse table. A second table over the reversed words extends to the left. Tables are only built for texts that need them.

Each text is its task's own business: nothing is shuffled or collected.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; a text of any length is one row
of its batch; repeated rows are answered each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COVER, MODULUS = (0, 1, 3, 8, 12, 18), 31
TEMPLATE = 2048  # texts up to so many words share one list of grid places
CHUNK = 1 << 18  # grid places that are extended at once
GATHER = 4 << 20  # bytes of text to a batch of results


def shifts() -> np.ndarray:
    """For two remainders the least shift that brings both into the cover."""
    held = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    turned = np.stack([held[r : r + MODULUS] for r in range(MODULUS)])
    return (turned[:, None, :] & turned[None, :, :]).argmax(2).astype(np.int64)


SHIFT = shifts()


class Extensions:
    """Longest common extensions to the right of places of a text of word numbers from 1 on."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        self.x = np.concatenate((x, np.zeros(MODULUS + 1, x.dtype)))  # 0 ends the text and equals no word
        self.rank = None

    def sort(self) -> None:
        at = np.arange(self.n + 1)
        at = at[np.isin(at % MODULUS, COVER)]
        self.index = np.full(self.n + 1 + MODULUS, -1, np.int64)
        self.index[at] = np.arange(len(at))
        grams = np.lib.stride_tricks.sliding_window_view(self.x, MODULUS)[at].astype(">u4")
        _, rank = np.unique(np.ascontiguousarray(grams).view(f"S{4 * MODULUS}").ravel(), return_inverse=True)
        levels, step = [rank + 1], MODULUS
        while levels[-1].max(initial=0) < len(at):
            beyond = np.minimum(at + step, self.n + 1)
            behind = np.where(beyond <= self.n, self.index[beyond], -1)
            second = np.where(behind >= 0, levels[-1][behind], 0)
            _, rank = np.unique(levels[-1] * (len(at) + 1) + second, return_inverse=True)
            levels.append(rank + 1)
            step *= 2
        self.rank = levels[-1] - 1
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 2, -1, -1):
            same = levels[k][a] == levels[k][b]
            step = MODULUS << k
            common[same] += step
            a[same], b[same] = self.index[at[a[same]] + step], self.index[at[b[same]] + step]
        common += (grams[a] != grams[b]).argmax(1) if len(a) else 0
        self.least = [common]
        while 2 << len(self.least) - 1 <= len(common):
            half, low = 1 << len(self.least) - 1, self.least[-1]
            self.least.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on; i < j <= n."""
        out = np.zeros(len(i), np.int64)
        wait = SHIFT[i % MODULUS, j % MODULUS]
        left = np.arange(len(i))
        for k in range(int(wait.max(initial=0))):
            left = left[(wait[left] <= k) | (self.x[i[left] + np.minimum(k, wait[left])] == self.x[j[left] + np.minimum(k, wait[left])])]
            out[left[wait[left] > k]] += 1
        if len(left):
            if self.rank is None:
                self.sort()
            a, b = self.rank[self.index[i[left] + wait[left]]], self.rank[self.index[j[left] + wait[left]]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                mine = level == k
                table = self.least[k]
                out[left[mine]] += np.minimum(table[low[mine]], table[high[mine] - (1 << k)])
        return out


def grid(n: int, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, period, words that a text needs for them) of a text of n words, by that need."""
    place, period = [], []
    for p in range(1, n // exponent + 1):
        g = np.arange(0, n - 2 * p, 2 * p)
        place.append(g)
        period.append(np.full(len(g), p))
    place, period = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (place, period))
    need = np.maximum(np.maximum(place + 2 * period + 1, exponent * period), least)
    order = np.argsort(need, kind="stable")
    return place[order], period[order], need[order]


def alike(x: np.ndarray, g: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The places at which words a period apart are equal: here, half a period on, a period on."""
    hit = np.flatnonzero(x[g] == x[g + p])
    for step in (p, p // 2):
        a = g[hit] + step[hit]
        hit = hit[x[a] == x[a + p[hit]]]
    return hit


class Finder:
    """The runs of texts."""

    def __init__(self, least: int = 6, exponent: int = 4):
        if exponent < 3:
            raise ValueError("the grid needs an exponent of three or more")
        self.limits = least, exponent
        self.template = grid(TEMPLATE, least, exponent)

    def places(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches of (place, period) where equal words say that a run may be."""
        n = len(x)
        if n <= TEMPLATE:
            g, p, need = self.template
            upto = int(np.searchsorted(need, n, "right"))
            g, p = g[:upto], p[:upto]
            hit = alike(x, g, p)
            if len(hit):
                yield g[hit], p[hit]
            return
        held, size = [], 0
        for p in range(1, n // self.limits[1] + 1):
            g = 2 * p * np.flatnonzero(x[0 : n - 2 * p : 2 * p] == x[p : n - p : 2 * p])
            g = g[x[g + p] == x[g + 2 * p]]
            g = g[x[g + p // 2] == x[g + p // 2 + p]]
            if len(g):
                held.append((g, np.full(len(g), p)))
                size += len(g)
                if size >= CHUNK:
                    yield tuple(np.concatenate(c) for c in zip(*held))
                    held, size = [], 0
        if held:
            yield tuple(np.concatenate(c) for c in zip(*held))

    def runs(self, x: np.ndarray) -> np.ndarray:
        """(start, length, period) of the runs of the word numbers ``x``, by start, then period."""
        n, (least, exponent) = len(x), self.limits
        right = left = None
        found = np.zeros((0, 3), np.int64)
        for g, p in self.places(x):
            if right is None:
                right, left = Extensions(x), Extensions(x[::-1].copy())
            back = left(n - g - p, n - g)
            length = right(g, g + p) + back + p
            good = length >= np.maximum(least, exponent * p)
            found = np.concatenate((found, np.stack((g - back, length, p), 1)[good]))
            # of runs with the same ends the smallest period is the run's own
            found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
            found = found[new]
        return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated(runs: np.ndarray, n: int) -> np.ndarray:
    """The words that a run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def strongest(runs: np.ndarray) -> list[int | None]:
    """(start, length, period) of the run of the greatest length / period; ties to the smaller start, then period."""
    if not len(runs):
        return [None] * 3
    near = runs[runs[:, 1] / runs[:, 2] >= (runs[:, 1] / runs[:, 2]).max() * (1 - 1e-9)].tolist()
    top = near[0]
    for r in near[1:]:
        if r[1] * top[2] > top[1] * r[2]:
            top = r
    return top


FORM = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_runs, the strongest run, all ``runs`` and the ``collapsed`` text of every row.

    Collapsed: the words without those that a run repeats, joined by one blank.
    """

    def rows(keys: list, answers: list[tuple]) -> pa.RecordBatch:
        n, best, runs, texts = zip(*answers)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
        flat = np.concatenate(runs)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, c].copy(), pa.int64()) for c in range(3)], fields=list(RUN)))
        start, length, period = (pa.array([b[c] for b in best], pa.int64()) for c in range(3))
        milli = pa.array([None if b[0] is None else 1000 * b[1] // b[2] for b in best], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(keys), pa.array(n, pa.int64()), pa.array([len(r) for r in runs], pa.int64()), start, length, period, milli, lists, pa.array(texts, pa.string())],
            ["key", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(least, exponent)
        for b in batches:
            answers, size, done = [], 0, 0
            for i, said in enumerate(b.column(1)):
                held = (said.as_py() or "").encode().split()  # of bytes: at blanks, tabs, LF, VT, FF and CR, and nowhere else
                seen: dict[bytes, int] = {}
                x = np.array([seen.setdefault(w, len(seen) + 1) for w in held], np.int64)
                runs = finder.runs(x)
                if len(runs):
                    gone = repeated(runs, len(x)).tolist()
                    kept = [w for w, g in zip(held, gone) if not g]
                else:
                    kept = held
                answers.append((len(x), strongest(runs), runs, b" ".join(kept).decode()))
                size += len(answers[-1][3])
                if size >= GATHER:
                    yield rows([b.column(0).slice(done, i + 1 - done)], answers)
                    answers, size, done = [], 0, i + 1
            if answers:
                yield rows([b.column(0).slice(done)], answers)

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(find, f"key {kind}, {FORM}")
    return out.withColumnRenamed("key", key)
