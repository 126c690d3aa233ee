"""Byte-level BPE encoding and decoding.

Texts are cut into pre-tokens a batch at a time; the merges are folded over the bytes of the batch's distinct
pre-tokens, lowest rank first, and the ids are then spread back to the places of each pre-token. Decoding takes the
binary piece of each id from the vocabulary and concatenates them. The rank map is read on the driver and travels as a
broadcast of fixed size. (Why the fold is not written with Spark's higher-order functions: see the README.)

Defined cases: a null text counts as empty and has no ids; repeated rows are encoded each; a text of any length is one
row of its batch; an id outside the vocabulary is an error; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import spread
from .pretokens import character_classes, cut_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GATHER = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: merge the pair of the lowest rank, at all its places, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    rank = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
    while True:
        lowest = min((r for r in rank if r >= 0), default=-1)
        if lowest < 0:
            return [ranks[p] for p in parts]
        out, i, n = [], 0, len(parts)
        while i < n:
            if i < n - 1 and rank[i] == lowest and (pair := parts[i] + parts[i + 1]) in ranks:
                out.append(pair)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
        rank = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens and ids (little-endian unsigned 32-bit integers) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(path), character_classes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, classes = shared.value
        known: dict[bytes, list[int]] = {}
        for b in batches:
            codes, words, each = cut_texts(b.column(1), classes)
            if len(known) > 2_000_000:  # memory, not results: a word that is met again is folded again
                known.clear()
            ids = []
            for w in words.to_pylist():
                if (x := known.get(w)) is None:
                    x = known[w] = fold(w, ranks)
                ids.append(x)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            marks = np.concatenate(([0], np.cumsum(size)))
            flat = np.fromiter((i for x in ids for i in x), "<u4", int(marks[-1]))
            del ids
            ends, i = np.cumsum(each), 0
            while i < len(each):
                done = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, done + GATHER, "right")))
                mine = codes[done : ends[j - 1]]
                total = np.concatenate(([0], np.cumsum(size[mine])))
                at = total[np.concatenate(([0], ends[i:j] - done))]
                held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at * 4), pa.py_buffer(spread(mine, flat, marks))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(np.diff(at)), held.cast(pa.binary())], ["key", "n_tokens", "ids"])
                i = j

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(run, f"key {kind}, n_tokens long, ids binary")
    return out.withColumnRenamed("key", key)


def decode(coded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the bytes that its ids stand for; null ids give null."""
    table = read_ranks(path)
    pieces = [b""] * (max(table.values()) + 1)
    for piece, rank in table.items():
        pieces[rank] = piece
    shared = coded.sparkSession.sparkContext.broadcast(pieces)
    place = coded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(shared.value, pa.binary())
        for b in batches:
            step = 256
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                held = part.column(place).cast(pa.large_binary())
                n = pc.binary_length(held).fill_null(0).to_numpy(zero_copy_only=False) // 4
                whole = np.frombuffer(b"".join(x for x in held.to_pylist() if x), "<u4")
                said = vocabulary.take(pa.array(whole))
                _, offsets, data = said.buffers()
                offsets = np.frombuffer(offsets, np.int32, len(said) + 1, said.offset * 4)
                at = offsets[np.concatenate(([0], np.cumsum(n)))].astype(np.int64)
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at), data or pa.py_buffer(b"")])
                text = pc.if_else(held.is_valid(), text, None).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, out])

    schema = coded.select("*", F.lit(None).cast("binary").alias(out)).schema
    return coded.mapInArrow(run, schema)
