"""Removal of repeated passages by recompression.

A window is ``window`` consecutive words; a word goes if a window over it also starts in a document with a smaller id.

Recompression shortens all texts in rounds. A round first names each run of one symbol by symbol and length, then
splits the symbols into left and right ones by a bit of their name and names each pair of a left and a right symbol.
Names are hashes of what they stand for, so a round gives the same name to the same thing in every task without a
table. Whether a symbol arises depends on a few neighbours only; each symbol carries the span of words that decides
it. Equal windows therefore hold equal symbols wherever that span lies inside the window. After the rounds Spark counts
which symbols more than one document holds. A window with a decided symbol that no other document holds cannot be a
repeat; what is left, little more than the true repeats, is verified by 96-bit hashes of whole windows: Spark finds the
smallest id of each.

Data flow: the words of a few thousand documents make one block, dictionary coded and compressed, in a written table.
Each block files its distinct symbols (then windows) once per bucket, in order, and the bucket answers with one bit per
entry. Hot passages are thus combined within blocks before they are shuffled, there is one row per block and bucket as
there is one segment per task pair in any shuffle, and no bucket sees more than the blocks' distinct entries.

Defined cases: null, empty and blank texts have no words; rows with the same id do not remove from one another; a null
id counts as larger than all others and as equal to other nulls; texts under ``window`` words lose nothing; repeated
windows within one document stay; a text of any length is one row of its block; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS = 2
BLOCK_BYTES = 3 << 20
PIECE = 1 << 17  # words recompressed at once, in whole documents
ENTRIES = 4_000_000  # distinct symbols in a bucket, about
NOBODY = np.int64(2**63 - 1)
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M2
    x = (x ^ (x >> np.uint64(29))) * M3
    return x ^ (x >> np.uint64(32))


def recompress(word: np.ndarray, first: np.ndarray, window: int, rounds: int = ROUNDS):
    """(symbol, begin, end) with the span of words, ends included, that decides each symbol.

    ``word`` holds the hashes of all words, ``first`` marks those that begin a document.
    """
    sym = mix(word)
    low = np.arange(len(word), dtype=np.int64)
    high = low.copy()
    edge = first.copy()  # symbols that begin a document
    far = np.int64(window)
    for r in range(rounds):
        n = len(sym)
        if n < 2:
            break
        # runs of one symbol
        new = np.ones(n, bool)
        new[1:] = (sym[1:] != sym[:-1]) | edge[1:]
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], n) - 1
        size = (stop - begin + 1).astype(np.uint64)
        s = sym[begin]
        s = np.where(size > 1, mix(s * M1 + size), s)
        e = edge[begin]
        last = np.append(e[1:], True)
        # the neighbours tell that the run ends where it does; at the end of a document nothing tells
        lo = np.where(e, low[begin] - far, low[np.maximum(begin - 1, 0)])
        hi = np.where(last, high[stop] + far, high[np.minimum(stop + 1, n - 1)])
        lo, hi = np.minimum(lo, low[begin]), np.maximum(hi, high[stop])
        # pairs of a left and a right symbol
        right = (mix(s + np.uint64(r + 1) * M3) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(s), bool)
        pair[:-1] = ~right[:-1] & right[1:] & ~last[:-1]
        after = np.concatenate(([False], pair[:-1]))
        lone = ~pair & ~after
        nlo, nhi = lo.copy(), hi.copy()
        k = np.flatnonzero(pair)
        nhi[k] = np.maximum(hi[k], hi[k + 1])
        nlo[k] = np.minimum(lo[k], lo[k + 1])
        k = np.flatnonzero(lone & right)  # no left symbol before it
        nlo[k] = np.where(e[k], lo[k] - far, np.minimum(lo[k], lo[np.maximum(k - 1, 0)]))
        nhi[k] = np.where(e[k], hi[k], np.maximum(hi[k], hi[np.maximum(k - 1, 0)]))
        k = np.flatnonzero(lone & ~right)  # no right symbol after it
        nhi[k] = np.where(last[k], hi[k] + far, np.maximum(hi[k], hi[np.minimum(k + 1, len(s) - 1)]))
        nlo[k] = np.where(last[k], lo[k], np.minimum(lo[k], lo[np.minimum(k + 1, len(s) - 1)]))
        k = np.flatnonzero(pair)
        s[k] = mix(s[k] * M1 + s[k + 1] * M2 + np.uint64(r))
        sym, low, high, edge = s[~after], nlo[~after], nhi[~after], e[~after]
    return sym, low, high


def window_keys(word: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes, 64 and 32 bits, of the ``window`` words from each ``start``."""
    a, b = mix(word * M1), mix(word ^ M3)
    h1, h2 = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    for j in range(window):
        h1 = h1 * M2 + a[start + j]
        h2 = h2 * M3 + b[start + j]
    return mix(h1), (mix(h2) >> np.uint64(32)).astype(np.uint32)


BLOCK = "block long, n long, body binary"


def blocks(docs: DataFrame) -> DataFrame:
    """One row per block: its rows (first column the id, second the text) as a compressed Arrow stream, and their number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for b in batches:
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.concatenate(([0], np.cumsum(size)))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(total, total[i] + BLOCK_BYTES, "right")) - 1)
                part = pa.Table.from_batches([b.slice(i, j - i)]).combine_chunks()
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(part)
                n = int(Block(sink.getvalue()).counts.sum())
                row = [(task << 32) + made], [n], [sink.getvalue().to_pybytes()]
                yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1], pa.int64()), pa.array(row[2], pa.binary())], ["block", "n", "body"])
                made, i = made + 1, j

    return docs.mapInArrow(run, BLOCK)


class Block:
    """The rows of a block: ``ids``, ``counts`` of words, ``codes`` of all words in ``vocab``."""

    def __init__(self, body):
        pa.default_memory_pool().release_unused()  # of the block before; tasks share an executor's memory
        self.rows = pa.ipc.open_stream(body).read_all().combine_chunks()
        texts = self.rows.column(1).combine_chunks() if self.rows.num_rows else pa.array([], pa.string())
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        marks = lists.offsets.to_numpy().astype(np.int64)
        words = lists.flatten()
        real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        self.counts = np.diff(np.concatenate(([0], np.cumsum(real)))[marks - marks[0]])
        coded = words.filter(pa.array(real)).dictionary_encode()
        self.codes, self.vocab = coded.indices.to_numpy(), coded.dictionary
        ids = self.rows.column(0).cast(pa.int64())
        self.ids = ids.fill_null(int(NOBODY)).to_numpy()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, place of its document, whether it begins one)."""
        from xxhash import xxh64_intdigest

        hashes = np.array([xxh64_intdigest(w) for w in self.vocab.cast(pa.large_binary()).to_pylist()], np.uint64)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.counts)
        first = np.ones(len(doc), bool)
        first[1:] = doc[1:] != doc[:-1]
        return hashes[self.codes], doc, first

    def pieces(self) -> Iterator[tuple[int, int]]:
        """Begin and end of stretches of whole documents, of PIECE words or one document at most."""
        ends = np.cumsum(self.counts)
        at = 0
        while at < (int(ends[-1]) if len(ends) else 0):
            place = int(np.searchsorted(ends, at + PIECE, "right"))
            upto = int(ends[place - 1]) if place and ends[place - 1] > at else int(ends[np.searchsorted(ends, at, "right")])
            yield at, upto
            at = upto

    def decided(self, word: np.ndarray, doc: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols that words of their own document decide, with their spans. No symbol spans two documents, so pieces give the same ones."""
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
        for a, z in self.pieces():
            if z - a == 1:
                continue  # a lone word has no neighbours that decide it
            sym, low, high = recompress(word[a:z], first[a:z], window)
            inside = high - low < window  # a symbol at the end of a document reaches beyond it, so its span is too long
            inside &= (low >= 0) & (high < z - a)
            inside[inside] &= doc[a + low[inside]] == doc[a + high[inside]]
            out.append((sym[inside], (a + low[inside]).astype(np.int32), (a + high[inside]).astype(np.int32)))
        return tuple(np.concatenate(c) for c in zip(*out))

    def symbols(self, buckets: int, window: int, words: tuple | None = None):
        """The decided symbols in order of their key: place among the keys, span, and keys with a mark of two documents."""
        word, doc, first = words or self.words()
        if not len(word):
            return None
        sym, low, high = self.decided(word, doc, first, window)
        key = ((sym >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)) << np.uint64(32) | (sym & np.uint64(0xFFFFFFFF))
        order = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))) if len(key) else np.zeros(0, np.int64)
        place = np.empty(len(key), np.int64)
        place[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(key))))
        holder = doc[low[order]]
        twice = holder[begin] != holder[np.append(begin[1:], len(key)) - 1] if len(key) else np.zeros(0, bool)
        return place, low, high, key[order][begin], twice

    def windows(self, buckets: int, window: int, shared: np.ndarray):
        """Windows that may repeat: start, id of the document, place among the keys; then keys and smallest id of each."""
        word, doc, first = self.words()
        n = len(word) - window + 1
        if n < 1:
            return None
        start = doc[:n] == doc[window - 1 :]
        place, low, high, _, _ = self.symbols(buckets, window, (word, doc, first))
        alone = ~shared[place]
        change = np.bincount(np.maximum(high[alone] - window + 1, 0), minlength=len(word) + 1).astype(np.int64)
        change -= np.bincount(low[alone] + 1, minlength=len(word) + 1)[: len(change)]
        start = np.flatnonzero(start & (np.cumsum(change)[:n] == 0))
        h1, h2 = window_keys(word, start, window)
        order = np.lexsort((h2, h1))
        k1, k2, own = h1[order], h2[order], self.ids[doc[start]][order]
        begin = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))) if len(order) else np.zeros(0, np.int64)
        at = np.empty(len(order), np.int64)
        at[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        least = np.minimum.reduceat(own, begin) if len(begin) else own
        return start, self.ids[doc[start]], at, k1[begin], k2[begin], least


def bits_of(answers: list[dict], kind: int, size: int) -> np.ndarray:
    """The answers of all buckets, in their order, as one bit per entry."""
    parts = sorted((a["bucket"], a["n"], a["bits"]) for a in answers if a["kind"] == kind)
    found = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n) for _, n, bits in parts]
    out = np.concatenate(found).astype(bool) if found else np.zeros(0, bool)
    if len(out) != size:
        raise RuntimeError("answers do not fit the block")
    return out


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The buckets in a sorted array and where each lies."""
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket.astype(np.int64))) + 1, [len(bucket)]))
    for a, z in zip(cuts[:-1], cuts[1:]):
        if z > a:
            yield int(bucket[a]), slice(a, z)


ANSWER = "block long, kind int, bucket long, n long, bits binary"


def answer(rows: pa.Table, kind: int, bits: np.ndarray) -> pa.Table:
    n = rows.column("n").to_numpy()
    ends = np.cumsum(n)
    packed = [np.packbits(bits[e - k : e]).tobytes() for k, e in zip(n.tolist(), ends.tolist())]
    return pa.table([rows.column("block"), pa.array(np.full(len(n), kind, np.int32)), rows.column("bucket"), pa.array(n), pa.array(packed, pa.binary())],
                    [f.split()[0] for f in ANSWER.split(", ")])


def joined(rows: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(column).to_pylist()), kind)


def shared_symbols(table: DataFrame, buckets: int, window: int) -> DataFrame:
    """For each block and bucket one bit per distinct symbol: whether another document, here or elsewhere, holds it."""

    def file_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: c[i].as_py() for n, c in zip(b.schema.names, b.columns)}
                found = Block(row["body"]).symbols(buckets, window)
                if found is None:
                    continue
                _, _, _, key, twice = found
                parts = list(by_bucket(key >> np.uint64(32)))
                low = (key & np.uint64(0xFFFFFFFF)).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _ in parts], pa.int64()), pa.array([row["block"]] * len(parts), pa.int64()),
                    pa.array([s.stop - s.start for _, s in parts], pa.int64()), pa.array([low[s].tobytes() for _, s in parts], pa.binary()),
                    pa.array([np.packbits(twice[s]).tobytes() for _, s in parts], pa.binary())], ["bucket", "block", "n", "keys", "twice"])

    def compare(rows: pa.Table) -> pa.Table:
        key = joined(rows, "keys", "<u4")
        twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(rows.column("twice").to_pylist(), rows.column("n").to_pylist())])
        order = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
        many = np.diff(np.append(begin, len(key))) > 1
        many |= np.maximum.reduceat(twice[order], begin) > 0
        bits = np.empty(len(key), bool)
        bits[order] = np.repeat(many, np.diff(np.append(begin, len(key))))
        return answer(rows, 0, bits)

    filed = table.mapInArrow(file_symbols, "bucket long, block long, n long, keys binary, twice binary")
    return filed.groupBy("bucket").applyInArrow(compare, ANSWER)


def earlier_windows(table: DataFrame, shared: DataFrame, buckets: int, window: int) -> DataFrame:
    """For each block and bucket one bit per distinct window: whether a smaller id than any in the block holds it."""

    def file_windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["bucket", "block", "n", "k1", "k2", "least"]
        kinds = [pa.int64()] * 3 + [pa.binary()] * 3
        rows = []
        for row in left.to_pylist():
            answers = right.to_pylist()
            found = Block(row["body"]).windows(buckets, window, bits_of(answers, 0, sum(a["n"] for a in answers)))
            if found is not None:
                _, _, _, k1, k2, least = found
                for bucket, s in by_bucket((k1 >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)):
                    rows.append([bucket, row["block"], s.stop - s.start, k1[s].tobytes(), k2[s].tobytes(), least[s].tobytes()])
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

    def compare(rows: pa.Table) -> pa.Table:
        k1, k2, least = joined(rows, "k1", "<u8"), joined(rows, "k2", "<u4"), joined(rows, "least", "<i8")
        order = np.lexsort((k2, k1))
        a, b = k1[order], k2[order]
        begin = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        lowest = np.minimum.reduceat(least[order], begin)
        bits = np.empty(len(k1), bool)
        bits[order] = np.repeat(lowest, np.diff(np.append(begin, len(k1)))) < least[order]
        return answer(rows, 1, bits)

    filed = table.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        file_windows, "bucket long, block long, n long, k1 binary, k2 binary, least binary")
    return filed.groupBy("bucket").applyInArrow(compare, ANSWER)


def remove_repeats(docs: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """key, n_words, n_removed and ``kept`` (the words that stay, joined by one blank) of every row of ``docs``.

    With ``whole``, in place of the key, the whole row as the struct ``doc``.
    """
    rest = [c for c in docs.columns if c not in (key, text)] if whole else []
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]
    table = settle(blocks(docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"), *named)), "blocks")
    words = table.agg(F.sum("n")).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(tasks, 1 + int(words) // (2 * ENTRIES))
    shared = settle(shared_symbols(table, buckets, window), "symbols")
    earlier = settle(earlier_windows(table, shared, buckets, window), "windows")
    held = docs.select(F.col(f"`{text}`").alias("text"), *named).schema if whole else docs.select().schema
    form = T.StructType([T.StructField("key", T.LongType()), *held.fields, *(T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")),
                         T.StructField("kept", T.StringType())])

    def remove(key_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            answers, block = right.to_pylist(), Block(row["body"])
            symbols = bits_of(answers, 0, sum(a["n"] for a in answers if a["kind"] == 0))
            found = block.windows(buckets, window, symbols)
            gone = np.zeros(len(block.codes) + 1, np.int64)
            if found is not None:
                start, own, at, _, _, least = found
                hit = start[bits_of(answers, 1, len(least))[at] | (own > least[at])]
                gone += np.bincount(hit, minlength=len(gone)) - np.bincount(np.minimum(hit + window, len(gone) - 1), minlength=len(gone))
            stays = np.cumsum(gone)[:-1] == 0
            before = np.concatenate(([0], np.cumsum(stays)))
            marks = np.concatenate(([0], np.cumsum(block.counts)))
            lists = pa.LargeListArray.from_arrays(pa.array(before[marks]), block.vocab.take(pa.array(block.codes[stays])))
            kept = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            n, stay = block.counts, np.diff(before[marks])
            columns = block.rows.columns if whole else block.rows.columns[:1]
            out.append(pa.table([*columns, pa.array(n), pa.array(n - stay), kept], form.names))
        return pa.concat_tables(out)

    answers = shared.unionByName(earlier)
    out = table.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(remove, form)
    if not whole:
        return out.withColumnRenamed("key", key)
    kinds = {key: F.col("key").cast(docs.schema[key].dataType), text: F.col("text"), **{c: F.col(f"c{i}") for i, c in enumerate(rest)}}
    return out.select(F.struct(*[kinds[c].alias(c) for c in docs.columns]).alias("doc"), "n_words", "n_removed", "kept")
