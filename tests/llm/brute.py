"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def remove_repeats(docs, window=13):
    """docs: (id, text) rows. {row: (n_words, n_removed, kept words)}; a null id is larger than all others."""
    order = lambda i: float("inf") if i is None else i
    least = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            least[g] = min(order(i), least.get(g, float("inf")))
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < order(i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


def majority(features, size=64):
    """Bits set in over half of the byte strings."""
    count = Counter()
    for f in features:
        value = int.from_bytes(f, "little")
        for b in range(size):
            count[b] += value >> b & 1
    return sum(1 << b for b in range(size) if 2 * count[b] > len(features))


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    return [" ".join(w[i : i + width]).encode() for i in range(max(1, len(w) - width + 1))] if w else []


def fingerprint(text, width=4, seed=42):
    return majority([xxhash.xxh64_intdigest(s, seed).to_bytes(8, "little") for s in shingles(text, width)])


def groups(ids, linked):
    """{id: smallest id that links reach}."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(ids)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def differ(a, b):
    return bin(a ^ b).count("1")


def repeated_words(w, width=5):
    count = Counter(tuple(w[k : k + width]) for k in range(len(w) - width + 1))
    inside = set()
    for k in range(len(w) - width + 1):
        if count[tuple(w[k : k + width])] > 1:
            inside.update(range(k, k + width))
    return len(inside)


def normal(line):
    return " ".join(words(line)).translate(LOWER)


def quality(docs, share, min_docs, min_words):
    """docs: (id, text, host) rows. [(id, n_words, n_removed, base_failed, kept, cleaned text)]."""
    lines = lambda t: [x for x in (t or "").split("\n") if words(x)]
    texts = {(h, t or "") for _, t, h in docs}
    size = Counter(h for h, _ in texts)
    above = lambda n, h: n > min_docs and n > share * size[h]
    own = {(h, t): {normal(x) for x in lines(t)} for h, t in texts}
    often = Counter((h, x) for (h, t), found in own.items() for x in found)
    frequent = {k for k, n in often.items() if above(n, k[0])}
    weight = lambda h, found, among: sum(len(x.split(" ")) for x in found if (h, x) in among)
    md5 = lambda x: int(hashlib.md5(x.encode()).hexdigest()[:15], 16)
    classes = {}
    for h, t in texts:
        held = {x for x in own[h, t] if (h, x) in frequent}
        if held:
            classes.setdefault((h, min(map(md5, held))), []).append((md5(t), t, held))
    voters = set(texts)
    for (h, _), found in classes.items():
        _, one, lines_of_one = min(found)
        for _, t, held in found:
            shared = weight(h, held & lines_of_one, frequent)
            if t != one and 9 * shared >= 4 * (len(words(t)) + len(words(one))):
                voters.discard((h, t))
    again = Counter((h, x) for (h, t) in voters for x in own[h, t] if (h, x) in frequent)
    bad = {k for k, n in again.items() if above(n, k[0])}
    out = []
    for i, t, h in docs:
        w = words(t)
        failed = len(w) < 10 or 100 * repeated_words(w) > 20 * len(w)
        removed = weight(h, [normal(x) for x in lines(t)], bad)
        clean = "\n".join(x for x in (t or "").split("\n") if (h, normal(x)) not in bad) if removed else t
        out.append((i, len(w), removed, failed, not failed and len(w) - removed >= min_words, clean))
    return out
