"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document of n tokens (its ids and one end mark) is cut, in order, into full sequences and then into one piece for each
binary digit of what is left, longest first. A piece is a sequence by itself, so sequences come in lengths of a power
of two, and those of one length (column ``length``) can be batched together.

Defined cases: a null or empty text gives one piece that holds the end mark; repeated rows are packed each, and a
sequence belongs to one row; a text of any length is cut within its batch; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counts import Merges, merge_words, special_of, tokenizer
from .pretokens import cut_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GATHER = 1_000_000  # pre-tokens turned into ids at once


def binary_pieces(n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents of ``n`` tokens; ``size`` is a power of two."""
    full, rest = n // size, n % size
    bits = size.bit_length() - 1
    powers = size >> np.arange(1, bits + 1)
    on = (rest[:, None] & powers) > 0
    each = full + on.sum(1)
    doc = np.repeat(np.arange(len(n)), each)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    length = np.full(len(doc), size, np.int64)
    length[within >= full[doc]] = np.broadcast_to(powers, on.shape)[on]
    start = np.cumsum(length) - length
    begin = np.cumsum(n) - n
    return doc, start - begin[doc], length


def spread(codes: np.ndarray, flat: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The ids of pre-tokens ``codes``, one after the other."""
    size = (marks[1:] - marks[:-1])[codes]
    at = np.repeat(marks[codes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return flat[at]


def pack(docs: DataFrame, path: str, size: int = 2048, end: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces: key, start, length, doc_tokens, ids (little-endian 32-bit integers), sequence_id, offset (0)."""
    if size & (size - 1) or size < 1:
        raise ValueError("size must be a power of two")
    shared = tokenizer(docs.sparkSession, path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, classes = shared.value
        merges = Merges(**arrays)
        for b in batches:
            codes, words, each = cut_texts(b.column(1), classes, special_of(merges))
            flat, marks = merge_words(words, merges)
            flat = np.append(flat, np.int32(end))  # the end mark is one more word
            marks = np.append(marks, marks[-1] + 1)
            ends, i = np.cumsum(each), 0
            while i < len(each):
                done = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, done + GATHER, "right")))
                mine = np.insert(codes[done : ends[j - 1]], ends[i:j] - done, len(marks) - 2)
                ids = spread(mine, flat, marks)
                total = np.concatenate(([0], np.cumsum((marks[1:] - marks[:-1])[mine])))
                stop = total[np.cumsum(each[i:j] + 1)]
                n = np.diff(np.concatenate(([0], stop)))
                doc, start, length = binary_pieces(n, size)
                at = np.concatenate(([0], np.cumsum(length))) * 4
                pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(at), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc + i)), pa.array(start), pa.array(length), pa.array(n[doc]), pieces.cast(pa.binary())],
                    ["key", "start", "length", "doc_tokens", "ids"])
                i = j

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(cut, f"key {kind}, start long, length long, doc_tokens long, ids binary")
    return out.select(F.col("key").alias(key), "start", "length", "doc_tokens", "ids").withColumn(
        "sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
