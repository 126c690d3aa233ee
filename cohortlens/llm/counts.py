"""Token counts by rank-synchronous merging of ragged numpy arrays.

The distinct pre-tokens of a batch lie one after the other in one array of symbols. In each round every pre-token
finds the lowest rank among its adjacent pairs and merges all places of that pair at once; pre-tokens without a pair
that has a rank leave with the symbols they have. The vocabulary travels as a broadcast of fixed size.

Defined cases: a null text counts as empty, with 0 bytes and 0 tokens; repeated rows are counted each; a text of any
length is one row of its batch; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from .pretokens import character_classes, cut_texts, ragged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOTS = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """Ranked pairs of symbols as arrays, with a hashed lookup from a pair to its rank.

    ``vars(merges)`` travels in a broadcast; ``Merges(**vars)`` makes it anew in the task.
    """

    def __init__(self, **arrays):
        self.__dict__.update(arrays)

    @classmethod
    def read(cls, path: str) -> Merges:
        self = cls()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        letters = byte_letters()
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.keys = left << 32 | right
        slot = self.slot(self.keys)
        self.table = np.full(SLOTS, -1, np.int32)
        self.table[slot[::-1]] = np.arange(len(pairs), dtype=np.int32)[::-1]
        beaten = np.flatnonzero(self.table[slot] != np.arange(len(pairs)))
        order = beaten[np.argsort(self.keys[beaten])]
        self.late_keys, self.late_ranks = self.keys[order], order.astype(np.int32)
        self.special = {x["content"].encode(): x["id"] for x in file.get("added_tokens", ())}
        return self

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> np.uint64(44)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it has none."""
        keys = left.astype(np.int64) << 32 | right
        rank = self.table[self.slot(keys)]
        hit = (rank >= 0) & (self.keys[rank] == keys)
        out = np.where(hit, rank, NONE)
        miss = np.flatnonzero((rank >= 0) & ~hit)
        if len(miss) and len(self.late_keys):
            k = np.minimum(np.searchsorted(self.late_keys, keys[miss]), len(self.late_keys) - 1)
            out[miss] = np.where(self.late_keys[k] == keys[miss], self.late_ranks[k], NONE)
        return out


def merge_words(words: pa.Array, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words one after the other, and the offsets of each word."""
    data, offsets = ragged(words)
    size = np.diff(offsets)
    counts = size.astype(np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    word = np.flatnonzero(size)  # the words still in work, their sizes and symbols
    size = size[word]
    sym = merges.first[data]
    ends = np.cumsum(size)
    rank = np.full(len(sym), NONE, np.int32)
    if len(sym) > 1:
        rank[:-1] = merges.ranks(sym[:-1], sym[1:])
    rank[ends - 1] = NONE
    while len(word):
        lowest = np.minimum.reduceat(rank, ends - size)
        stop = lowest == NONE
        if stop.any():
            out = np.repeat(stop, size)
            done.append((np.repeat(word[stop], size[stop]), sym[out]))
            counts[word[stop]] = size[stop]
            sym, rank, lowest, word, size = sym[~out], rank[~out], lowest[~stop], word[~stop], size[~stop]
            ends = np.cumsum(size)
            if not len(word):
                break
        at = np.flatnonzero(rank == np.repeat(lowest, size))
        if (near := np.diff(at) == 1).any():  # a a a: every other one, from the left of each run
            begin = np.concatenate(([True], ~near))
            index = np.arange(len(at))
            run = np.maximum.accumulate(np.where(begin, index, 0))
            # two words may touch, but a pair never crosses words, so a run stays in one word
            at = at[(index - run) % 2 == 0]
        sym[at] = merges.merged[rank[at]]
        gone = np.zeros(len(sym), bool)
        gone[at + 1] = True
        owner = np.searchsorted(ends, at, "right")
        size = size - np.bincount(owner, minlength=len(size))
        shift = at - np.arange(len(at))  # where the merged symbols are once the others have gone
        sym, rank = sym[~gone], rank[~gone]
        ends = np.cumsum(size)
        last = np.zeros(len(sym), bool)
        last[ends - 1] = True
        anew = np.concatenate((shift, shift[shift > 0] - 1))
        open_, shut = anew[~last[anew]], anew[last[anew]]
        rank[open_] = merges.ranks(sym[open_], sym[open_ + 1])
        rank[shut] = NONE
    marks = np.concatenate(([0], np.cumsum(counts)))
    flat = np.empty(marks[-1], np.int32)
    for owner, symbols in done:
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        within = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
        flat[marks[owner] + within] = symbols
    for text, number in merges.special.items():
        k = words.index(pa.scalar(text, words.type)).as_py()
        if k >= 0:  # the cutter makes this pre-token only where the special string stands
            flat[marks[k]] = number
            flat = np.delete(flat, np.arange(marks[k] + 1, marks[k + 1]))
            marks = np.concatenate((marks[: k + 1], marks[k + 1 :] - (marks[k + 1] - marks[k] - 1)))
    return flat, marks


def tokenizer(spark, path: str):
    """The vocabulary and the character classes, read on the driver and broadcast (a few MB, fixed by the file)."""
    return spark.sparkContext.broadcast((vars(Merges.read(path)), character_classes()))


def special_of(merges: Merges) -> bytes | None:
    return next(iter(merges.special), None)


def token_counts(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens and whether there are more than ``limit`` tokens, for every row of ``docs``."""
    shared = tokenizer(docs.sparkSession, path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, classes = shared.value
        merges = Merges(**arrays)
        for b in batches:
            texts = b.column(1)
            codes, words, each = cut_texts(texts, classes, special_of(merges))
            per_word = np.diff(merge_words(words, merges)[1])
            total = np.concatenate(([0], np.cumsum(per_word[codes])))
            ends = np.cumsum(each)
            n = total[ends] - total[ends - each]
            size = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)
