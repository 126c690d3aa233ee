"""Blocks are recompressed in pieces: the same symbols, in less memory."""

import tracemalloc

import numpy as np
import pyarrow as pa

from cohortlens.llm import recompress as R


def block(texts):
    table = pa.table({"key": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return R.Block(sink.getvalue().to_pybytes())


def texts(n, length, seed=3):
    rng = np.random.default_rng(seed)
    out = [" ".join(f"w{int(v)}" for v in rng.integers(0, 60, rng.integers(0, length))) for _ in range(n)]
    return out + [out[1], "", None, "one", "w1 " * 40]


def test_memory_of_a_block(monkeypatch):
    """Of 400,000 words, the names of one piece at a time."""
    made = block(texts(2000, 400))
    words = made.words()
    monkeypatch.setattr(R, "PIECE", 1 << 15, raising=False)
    made.symbols(7, 13)
    tracemalloc.start()
    made.symbols(7, 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90 * len(words[0])


def test_pieces_name_alike(monkeypatch):
    made = block(texts(60, 50))
    monkeypatch.setattr(R, "PIECE", 1 << 40, raising=False)
    whole = made.symbols(7, 13)
    for size in (1, 30, 1000):
        monkeypatch.setattr(R, "PIECE", size, raising=False)
        for a, b in zip(whole, made.symbols(7, 13)):
            assert np.array_equal(a, b)
