"""The corpus pipeline against a brute-force version of all its stages, on a small corpus with planted cases."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortlens.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    texts = ["\n".join(prose(rng.randint(10, 30)) for _ in range(rng.randint(1, 6))) for _ in range(120)]
    texts[60:70] = [texts[5]] * 10  # copies
    for k in range(70, 80):  # near copies: one word of many changed
        w = (texts[6] + " " + prose(150)).split(" ") if k == 70 else texts[70].split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts[k] = " ".join(w)
    passage = prose(60)
    for k in range(80, 90):
        texts[k] = texts[k] + "\n" + passage + "\n" + prose(20)
    for k in range(0, 120, 2):
        texts[k] += "\nRead  our NEWSLETTER every week"
    texts[90], texts[91], texts[92], texts[93] = "", None, "too short", "spam spam " * 40
    texts[94] = "\n".join(["Read our newsletter every week"] * 3)
    texts[95] = " ".join(texts[80].split()[:40])
    return [(i, t, "en", "hot" if i % 3 else "cold", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        result = stage(spark, docs, folder)
        if name != "packing":
            assert result.columns == docs.columns
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return folder, out


def held(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage(run):
    rows = corpus()
    first = {i: t for i, n, r, failed, kept, t in brute.quality([(i, t, s) for i, t, _, s, _ in rows], quality.SHARE, quality.MIN_DOCS, quality.MIN_WORDS) if kept}
    got = held(run[1][0])
    assert got == first and 94 not in got and "NEWSLETTER" in got[0] and "NEWSLETTER" not in got[2]
    prints = {i: brute.fingerprint(t) for i, t in first.items()}
    near = lambda a, b: brute.differ(prints[a], prints[b]) <= 4
    root = brute.groups(first, near)
    second = {i: t for i, t in first.items() if root[i] == i}
    got = held(run[1][1])
    assert got == second and not set(range(61, 70)) & set(got) and not set(range(71, 80)) & set(got) and len(got) > 80
    third = {}
    for i, n, removed, kept in brute.remove_repeats(sorted(second.items())):
        if kept or not n:
            third[i] = " ".join(kept) if removed else second[i]
    got = held(run[1][2])
    assert got == third and 95 not in got and 81 in got
    assert all(r["n_chars"] == len(r["text"]) for r in run[1][2].collect())
    lib, pieces = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    for r in run[1][3].orderBy("doc_id", "start").collect():
        ids, at = pieces.setdefault(r["doc_id"], ([*lib.encode(third[r["doc_id"]], add_special_tokens=False).ids, 1], [0]))
        assert r["start"] == at[0] and r["ids_crc32"] == zlib.crc32(np.array(ids[at[0] : at[0] + r["length"]], "<u4").tobytes())
        at[0] += r["length"]
    assert set(pieces) == set(third) and all(at[0] == len(ids) for ids, at in pieces.values())


def test_run_gives_the_last_stage(spark, run):
    got = corpus_pipeline.run(spark, run[0]).drop("sequence_id")
    assert sorted(got.collect()) == sorted(run[1][3].drop("sequence_id").collect())


def test_odd_rows_pass(spark, tmp_path):
    """Null ids, repeated rows, nulls everywhere, and columns named like the stages' own."""
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text, "en", None, 1), (None, text, None, "s", None), (3, text, "en", "s", 1), (3, text, "en", "s", 1), (4, None, None, None, None), (5, "", "", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("kept", "n_words", "_row", "doc", "nth", "key", "fp", "kept_sha256", "_text", "lost"):
        docs = docs.withColumn(c, F.lit(7))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        got = out.collect()
        assert all(r["nth"] == 7 and r["kept"] == 7 for r in got)
        if name == "near_dedup":
            assert sorted((r["doc_id"] is None, r["doc_id"]) for r in got if r["doc_id"]) == [(False, 3), (False, 4)] and len(got) == 4
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
