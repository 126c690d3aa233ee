"""Queries that SQL cannot state, against plain Python and the public tokenizer libraries."""

import base64
import hashlib
import html
import random
import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from cohortlens.llm import counts, extract, pretokens, recompress, simhash
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_substring_dedup(spark, docs):
    want = {i: (n, r, hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, n, r, k in brute.remove_repeats(list(docs.items()))}
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op2_substring_dedup"](spark, SF).collect()}
    assert got == want and any(r for _, r, _ in want.values())


def test_simhash(spark, docs):
    prints = {i: brute.fingerprint(t) for i, t in docs.items()}
    want = brute.groups(docs, lambda a, b: brute.differ(prints[a], prints[b]) <= 4)
    got = QUERIES["op3_simhash"](spark, SF).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_byte_bpe(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"](spark, SF).collect()}
    assert set(got) == set(docs)
    for i, t in docs.items():
        ids = lib.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_packing(spark, docs, library):
    pieces = defaultdict(list)
    rows = QUERIES["op6_packing"](spark, SF).collect()
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, t in docs.items():
        ids, at = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["offset"] == 0
            assert r["length"] in {1 << k for k in range(12)}
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_token_counts(spark, docs, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op8_token_counts"](spark, SF).collect()}
    for i, t in docs.items():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 512)


def test_main_text(spark):
    """The test pages hold the article in one element, with malformed paragraphs and cut-off ends."""
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    got = {r["page_id"]: r for r in QUERIES["op9_main_text"](spark, SF).collect()}
    for p in pages:
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", p["html"] or "", re.S)
        body = re.sub(r"</?(?:b|a|i)(?:\s[^>]*)?>|<[a-zA-Z/!][^>]*\Z", "", inside[1] if inside else "")
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"<[a-zA-Z/!][^>]*>", body)]
        want = "\n".join(x for x in parts if x)
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want) and got[p["page_id"]]["url"] == p["url"]


PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "s", "re", "ll", "'ve", "'t", "1", "23", "é", "ß", "中", "文", "!", "..", "<|endoftext|>",
          " ", "　", "\x1c", "\x85", "😀", "don't", "m", "d", "İ", "ñ", "aaaa", "===", "Ⅷ", "́", "​"]


def test_any_text_as_the_libraries(library):
    rng = random.Random(5)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(3000)] + ["", "x" * 5000, " " * 300, "ab" * 2000]
    merges, classes = counts.Merges.read(BPE), pretokens.character_classes()
    codes, words, each = pretokens.cut_texts(pa.array(texts), classes, b"<|endoftext|>")
    flat, marks = counts.merge_words(words, merges)
    at = 0
    for text, n in zip(texts, each.tolist()):
        ids = [x for c in codes[at : at + n].tolist() for x in flat[marks[c] : marks[c + 1]].tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        at += n
    # without the special string, cut as the public pattern cuts
    codes, words, each = pretokens.cut_texts(pa.array(texts), classes)
    import regex

    held, at = words.to_pylist(), 0
    for text, n in zip(texts, each.tolist()):
        assert [held[c].decode() for c in codes[at : at + n].tolist()] == regex.findall(public_tokenizers.PATTERN, text)
        at += n


def test_recompression_is_consistent():
    """Equal stretches of words hold equal decided symbols at equal places."""
    rng = np.random.default_rng(3)
    for _ in range(40):
        vocabulary = rng.integers(0, 2**63, rng.integers(2, 30)).astype(np.uint64)
        common = rng.choice(vocabulary, 40)
        texts = [np.concatenate((rng.choice(vocabulary, rng.integers(0, 30)), common, rng.choice(vocabulary, rng.integers(0, 30)))) for _ in range(4)]
        seen = []
        for t in texts:
            first = np.zeros(len(t), bool)
            first[0] = True
            sym, low, high = recompress.recompress(t, first, 13)
            at = next(i for i in range(len(t)) if (t[i : i + 40] == common).all())
            inside = (low >= at) & (high < at + 40)
            seen.append(set(zip(sym[inside].tolist(), (low[inside] - at).tolist(), (high[inside] - at).tolist())))
        assert all(s == seen[0] for s in seen) and seen[0]


@pytest.mark.parametrize("tau", [1, 4, 8])
def test_links_connect_what_is_linked(spark, tau):
    """Clusters, chains and noise, compared pair by pair; a cluster larger than the sizes at which the method changes."""
    rng = random.Random(tau)
    prints = set()
    for n in (1, 3, 200):
        base = rng.getrandbits(64)
        for _ in range(n):
            p = base
            for b in rng.sample(range(64), rng.randint(0, tau)):
                p ^= 1 << b
            prints.add(p)
    step = rng.getrandbits(64)
    for k in range(0, 60, tau):  # a chain, each linked to the next
        step ^= ((1 << tau) - 1) << k
        prints.add(step & (1 << 64) - 1)
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(300)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "node long, fp long")
    n, mean, corr = simhash.bit_moments(df)
    parts = simhash.plan(n, mean, corr, tau)
    assert sum(t + 1 for _, t in parts) >= tau + 1
    edges = simhash.links(df, n, parts, tau)
    want = brute.groups(range(len(prints)), lambda a, b: brute.differ(prints[a], prints[b]) <= tau)
    got = {i: i for i in range(len(prints))} | {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == want
    assert edges.count() <= 67 * 5 * len(prints)


def test_large_buckets_are_cut(monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 10)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6).astype(np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) for b in base]))
    ids = np.arange(len(fps))
    found = {(min(a, b), max(a, b)) for x, y in simhash.forest(fps, ids, 4) for a, b in zip(x.tolist(), y.tolist())}
    want = brute.groups(ids.tolist(), lambda a, b: brute.differ(int(fps[a]), int(fps[b])) <= 4)
    assert brute.groups(ids.tolist(), lambda a, b: (a, b) in found) == want


@pytest.mark.parametrize("rows, keys", [(10_000, 20_000), (20, 100)])
def test_large_buckets_are_filed_again(spark, monkeypatch, rows, keys):
    """Buckets over the limit pass through all rounds, within one batch of rows and over several."""
    monkeypatch.setattr(simhash, "SPLIT", 12)
    assert [len(m) for m in simhash.finer(4)] == [5, 15, 70, 1820] and all(bin(int(m)).count("1") == 48 for m, _ in simhash.finer(4)[-1])
    monkeypatch.setattr(simhash, "MOST_KEYS", keys)
    rng = np.random.default_rng(2)
    balls = [np.uint64(b) ^ (np.uint64(1) << rng.integers(0, 64, (80, 3)).astype(np.uint64)).sum(1).astype(np.uint64) for b in rng.integers(0, 2**62, 4)]
    low = rng.integers(0, 2**10, 60).astype(np.uint64)  # in a common bucket at every round, linked or not
    fps = np.unique(np.concatenate((*balls, low, rng.integers(0, 2**63, 60).astype(np.uint64))))
    df = spark.createDataFrame([(i, int(f.view(np.int64))) for i, f in enumerate(fps)], "node long, fp long")
    n, mean, corr = simhash.bit_moments(df)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        edges = simhash.links(df, n, simhash.plan(n, mean, corr, 4), 4)
        found = [tuple(r) for r in edges.distinct().collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    near = lambda a, b: brute.differ(int(fps[a]), int(fps[b])) <= 4
    assert all(near(a, b) for a, b in found)
    pairs = set(found)
    assert brute.groups(range(len(fps)), lambda a, b: (min(a, b), max(a, b)) in pairs) == brute.groups(range(len(fps)), near)


PAGE = """<html><head><title>T</title></head><body><header><h2>Site</h2></header><div class="menu-1">Menu one</div>
<div id="c3" class="cookie-notice">We use cookies</div><div class="wrap"><div class="post post-12"><h1>Head &amp; line</h1>
<p>First   para&shy;graph of the story, long enough to count for much more than the rest of the page does.<p>Second one<br>after a break
<ul><li>an item</ul><form><input name=x>Your mail</form><script>if (a < b) document.write("<p>no</p>")</script></div>
<aside>Aside</aside><div class="comments"><p>Reader says a very long thing that is nevertheless not part of the article at all, at all, at all.</p>
</div></div><footer>&copy; foot</footer></body></html>"""


def test_extraction_leaves_out_what_is_no_article():
    path, _ = extract.best_path(extract.read_blocks(PAGE))
    assert path.endswith("div.wrap/div.post.post-")
    assert extract.main_text(PAGE, path).split("\n") == [
        "Head & line", "First para­graph of the story, long enough to count for much more than the rest of the page does.", "Second one", "after a break", "an item"]


def test_hosts_outvote_a_page(spark):
    """A page whose longest container is another one is read by its host's path."""
    body = "<html><body><div class='a'><p>{}</p></div><div class='b'><p>{}</p></div></body></html>"
    rows = [(i, "http://h.org/x", body.format("main text here " * 5, "little")) for i in range(3)]
    rows += [(9, "http://h.org/y", body.format("short main", "much longer text in the other place " * 9)), (10, "http://k.org/", body.format("k", "long " * 20))]
    got = {r["page_id"]: r["text"] for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short main" and got[10] == ("long " * 20).strip()
