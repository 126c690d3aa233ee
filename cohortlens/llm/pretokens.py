"""Texts cut into pre-tokens with numpy, a batch at a time, by the public byte-level pattern:

    's|'t|'re|'ve|'m|'ll|'d| ?letters+| ?numbers+| ?others+| white space not before a word | white space

The pattern only looks at character classes, so the places where pre-tokens begin follow from the classes of
neighbouring characters and are found for all texts of a batch at once. Distinct pre-tokens of a batch are then found
by Arrow's dictionary encoding; merging works on those.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK, WHITE, LETTER, NUMBER, OTHER = 0, 1, 2, 3, 4
SLICE_BYTES = 4 << 20


def character_classes() -> np.ndarray:
    """The class of each code point, made on the driver and sent to the tasks (1.1 MB, whatever the data)."""
    import regex

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        found = "".join(regex.findall(pattern + "+", every))
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    out[32] = BLANK
    return out


def code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code points of the UTF-8 characters that begin at ``at``."""
    lead = data[at].astype(np.int32)
    out = lead.copy()
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        k = np.flatnonzero((lead >= low) & (lead < high))
        if len(k):
            cp = lead[k] & mask
            for j in range(1, more + 1):
                cp = (cp << 6) | (data[np.minimum(at[k] + j, len(data) - 1)] & 0x3F)
            out[k] = cp
    return np.minimum(out, 0x10FFFF)


def cut_slice(data: np.ndarray, ends: np.ndarray, classes: np.ndarray, special: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where pre-tokens begin, and the number of pre-tokens in each text.

    ``data`` holds the texts one after the other, ``ends`` where each ends. ``special`` is a string that is one
    pre-token wherever it stands, and that ends the text before it.
    """
    counts = np.zeros(len(ends), np.int64)
    if not len(data):
        return np.zeros(0, np.int64), counts
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(at)
    kind = classes[code_points(data, at)] if n < len(data) else classes[data]
    begins = np.concatenate(([0], ends[:-1]))
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    inside: list[tuple[int, int]] = []
    if special:
        raw, i = data.tobytes(), -1
        while (i := raw.find(special, i + 1)) >= 0:
            j = i + len(special)
            if ends[np.searchsorted(ends, i, "right")] >= j:  # not across two texts
                first[i] = first[j] = True
                inside.append((i, j))
                i = j - 1
    first = first[:-1][at] if n < len(data) else first[:-1]
    white = kind <= WHITE
    group = np.maximum(kind, WHITE)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(group[1:], group[:-1], out=new[1:])
    new |= first
    bound = new.copy()
    # the last white space before a word stands alone, or goes with the word if it is a blank
    e = np.flatnonzero(new[1:] & ~first[1:] & white[:-1] & ~white[1:]) + 1
    bound[e - 1] = True
    bound[e] = kind[e - 1] != BLANK
    # an apostrophe with one of the short endings
    e = np.flatnonzero((data[at[:-1]] == 39) & bound[:-1] & new[:-1] & new[1:] & ~first[1:] & (kind[1:] == LETTER)) if n > 1 else np.zeros(0, int)
    if len(e):
        c1 = data[at[e + 1]]
        one = e[np.isin(c1, np.frombuffer(b"stmd", np.uint8))]
        bound[one + 1] = False
        bound[one[one + 2 < n] + 2] = True
        e = e[e + 2 < n]
        e = e[~new[e + 2]]
        pair = data[at[e + 1]].astype(np.int32) * 256 + data[at[e + 2]]
        two = e[np.isin(pair, [a * 256 + b for a, b in (b"re", b"ve", b"ll")])]
        bound[two + 1] = False
        bound[two + 2] = False
        bound[two[two + 3 < n] + 3] = True
    starts = at[bound]
    for i, j in inside:
        starts = starts[(starts <= i) | (starts >= j)]
    counts = np.searchsorted(starts, ends) - np.searchsorted(starts, begins)
    return starts, counts


def cut_texts(texts: pa.Array, classes: np.ndarray, special: bytes | None = None) -> tuple[np.ndarray, pa.BinaryArray, np.ndarray]:
    """(code of each pre-token, distinct pre-tokens, number of pre-tokens of each text); null texts have none."""
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_binary())
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    chunks, counts, i = [], [], 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        starts, each = cut_slice(part, offsets[i + 1 : j + 1] - offsets[i], classes, special)
        counts.append(each)
        if len(starts):
            marks = np.append(starts, len(part))
            marks = marks.astype(np.int32) if len(part) < 1 << 31 else marks
            whole = pa.BinaryArray if marks.dtype == np.int32 else pa.LargeBinaryArray
            words = whole.from_buffers(pa.binary() if whole is pa.BinaryArray else pa.large_binary(), len(starts), [None, pa.py_buffer(marks), pa.py_buffer(part)])
            chunks.append(words.dictionary_encode())
        i = j
    if not chunks:
        return np.zeros(0, np.int32), pa.array([], pa.binary()), np.zeros(n, np.int64)
    same = pa.chunked_array(chunks).unify_dictionaries().chunks
    codes = np.concatenate([c.indices.to_numpy() for c in same])
    return codes, same[-1].dictionary, np.concatenate(counts)


def ragged(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, and the offsets of each (one more than there are words)."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
