"""Defined results for nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm.common import salted_join
from cohortlens.llm import bpe, counts, extract, licenses, packing, quality, recompress, simhash, topk, urls

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"w{i % 977} x{i}" for i in range(60_000))
CLASH = ("n_words", "n_removed", "kept", "fp", "component_id", "key", "text2", "block", "ids", "_text", "_row", "rank", "host", "verdict", "words")


@pytest.fixture(scope="module")
def docs(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(1, None, "s"), (2, "", None), (3, " \t\n ", "s"), (4, passage, "s"), (4, passage, "s"), (5, passage + " end", None), (None, passage, "s"),
            (6, LONG, "s"), (7, "Licensed under CC BY-NC 4.0.", "s"), (8, "a", None), (9, "naïve İstanbul 中文 text", "s"), (10, LONG, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_substring_dedup(docs):
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(((i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest()) for i, n, gone, kept in brute.remove_repeats(pairs)), key=repr)
    out = recompress.remove_repeats(docs, 13)
    assert rows_of(out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == want
    whole = recompress.remove_repeats(docs, 13, whole=True)
    assert rows_of(whole.select("doc.*")) == rows_of(docs) and whole.select("doc.*").columns == docs.columns


def test_simhash(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by[1] == by[2] == by[3] == 1 and by[4] == 4 and by[6] == by[10] == 6
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [4]
    lone = docs.where("doc_id IS NULL OR doc_id = 8")
    assert {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(lone).collect()} == {(None, None), (8, 8)}


def test_tokens(docs):
    lib = Tokenizer.from_file(BPE)
    want = sorted(((i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 512)
                   for i, t in docs.select("doc_id", "text").collect()), key=repr)
    assert rows_of(counts.token_counts(docs, BPE, 512)) == want
    pieces = packing.pack(docs, BPE).collect()
    assert sum(r["length"] for r in pieces) == sum(w[2] + 1 for w in want) and len({r["sequence_id"] for r in pieces}) == len(pieces)
    coded = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert rows_of(coded.select("doc_id", F.decode("decoded", "utf-8"))) == rows_of(docs.select("doc_id", F.coalesce("text", F.lit(""))))


def test_quality(docs):
    got = quality.line_quality(docs)
    assert got.count() == docs.count()
    by = {r["doc_id"]: r for r in got.collect()}
    assert not by[1]["kept"] and by[1]["n_words"] == 0 and by[6]["n_words"] == 120_000 and by[6]["kept"] and by[4]["kept"] and not by[8]["kept"]


@pytest.mark.parametrize("share, min_docs", [(0.05, 3), (0.1, 2)])
def test_quality_by_brute_force(spark, share, min_docs):
    import random

    rng = random.Random(2)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(30)]
    rows = []
    for i in range(150):
        own = [" ".join(f"u{i}.{k}.{j}" for j in range(rng.randint(1, 9))) for k in range(rng.randint(0, 4))]
        text = "\n".join(rng.sample(own + rng.choices(lines, k=rng.randint(0, 5)), k=len(own)) if own else rng.choices(lines, k=3))
        rows.append((i, text if i % 20 else None, rng.choice(["h", "k", None])))
    rows += [(200 + k, rows[7][1], rows[7][2]) for k in range(40)]
    want = {i: (n, gone, failed, kept, clean) for i, n, gone, failed, kept, clean in brute.quality(rows, share, min_docs, 10)}
    df = quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("t", F.col("text")), ("doc_id", "t"),
                              share=share, min_docs=min_docs)
    got = {r["doc_id"]: tuple(r)[1:] for r in df.select("doc_id", "n_words", "n_removed", "base_failed", "kept", quality.cleaned(df, "t")).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_copies_have_no_vote_and_boilerplate_goes(spark):
    """Near copies in large numbers are left to the near-dedup; a line that pages with their own text share is removed."""
    same = "\n".join(" ".join(f"copy{k}.{j}" for j in range(12)) for k in range(6))
    rows = [(i, same + f"\nedit{i}", "h") for i in range(60)]
    rows += [(100 + i, " ".join(f"own{i}.{j}" for j in range(30)) + "\nSubscribe to our newsletter today", "h") for i in range(60)]
    rows += [(300, "Subscribe to OUR newsletter  today\nSubscribe to our newsletter today\n" * 2, "h")]
    got = {r["doc_id"]: r for r in quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["kept"] and got[i]["n_removed"] == 0 for i in range(60))
    assert all(got[100 + i]["kept"] and got[100 + i]["n_removed"] == 5 for i in range(60))
    assert not got[300]["kept"]


def test_depleted_pages_are_rejected(spark):
    """Pages that are boilerplate for the most part vote like any other."""
    shared = "\n".join(" ".join(f"menu{k}.{j}" for j in range(10)) for k in range(2))
    rows = [(i, shared + "\n" + " ".join(f"own{i}.{j}" for j in range(8)), "h") for i in range(100)]
    rows += [(200, " ".join(f"long{j}" for j in range(40)) + "\n" + shared, "h")]
    got = {r["doc_id"]: r for r in quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(not got[i]["kept"] and got[i]["n_removed"] == 20 and not got[i]["base_failed"] for i in range(100))
    assert got[200]["kept"] and got[200]["n_removed"] == 20


def test_salts_follow_each_key(spark):
    """One hot key and many warm ones: the keys' table stays far smaller than the rows, and no row is lost."""
    rows = spark.range(60_000).select(F.when(F.col("id") < 40_000, 0).otherwise(F.col("id") % 10_000 + 1).alias("k"), F.col("id").alias("row"))
    keys = rows.groupBy("k").agg(F.count("*").alias("n")).where("k % 2 = 0")
    joined = salted_join(rows, keys.withColumn("name", F.col("k") * 10), ["k"], F.col("row"), "n", 100)
    assert joined.count() == 50_000 and joined.where("name <> k * 10").count() == 0 and joined.select("row").distinct().count() == 50_000
    plan = salted_join(rows, keys, ["k"], F.col("row"), "n", 100, "left_semi")
    assert plan.count() == 50_000 and plan.columns == ["k", "row"]


def test_licenses(spark, docs):
    got = licenses.scan(docs).collect()
    assert [(r["doc_id"], r["license"], r["containment"]) for r in got] == [(7, "cc-by-nc-4.0", 1.0)]
    long = licenses.TEMPLATES["mit-permission"].replace("merge", "unite")
    near = spark.createDataFrame([(1, LONG + "\n" + long.upper() + "\n" + LONG), (2, long[: len(long) // 2])], "doc_id long, text string")
    got = [(r["doc_id"], r["license"]) for r in licenses.scan(near).collect()]
    assert got == [(1, "mit-permission")]


def test_every_license_is_told_from_its_relatives(spark):
    """Each template, in other case, among other words, is found as itself; versions and families do not stand for one another."""
    names = list(licenses.TEMPLATES)
    rows = [(i, LONG[:400] + "\n" + licenses.TEMPLATES[n].upper() + "\nand then more of it") for i, n in enumerate(names)]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = r["containment"]
    inside = {"apache-2.0-header": {"apache-2.0"}}
    for i, n in enumerate(names):
        assert set(got[i]) == {n} | inside.get(n, set()) and got[i][n] == 1.0
    other = spark.createDataFrame([(1, "This work is licensed under the GNU General Public License, version 4")], "doc_id long, text string")
    assert licenses.scan(other).count() == 0


def test_licenses_by_sql(spark, tmp_path):
    """The registered query and its SQL on texts with edits, cuts and wrong versions."""
    import random

    import duckdb

    from cohortlens.llm import queries
    from tools.check import compare

    rng, rows = random.Random(4), []
    for n, body in licenses.TEMPLATES.items():
        for k in range(6):
            w = body.split()
            for _ in range(k):
                w[rng.randrange(len(w))] = "other"
            rows.append((len(rows), " ".join(f"x{rng.randrange(99)}" for _ in range(20)) + " " + " ".join(w)))
        rows.append((len(rows), body.replace(" 2", " 7").replace(" 3", " 8")))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    df = queries.QUERIES["op7_license_scan"](spark, str(tmp_path)).cache()
    assert compare(df, con, queries.ORACLES["op7_license_scan"]) == "ok" and df.count() > 40


def test_top_k(spark):
    inf = float("inf")
    rows = [(100, [1.0, 0.0]), (200, [0.5, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [None, 1.0]), (5, None), (6, [inf, 0.0]),
            (7, [float("nan"), 0.0]), (8, [1.0]), (None, [9.0, 9.0]), (300, [1e30, 1e30]), (9, []), (400, []), (2, [1.0, 1.0]), (10, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit("x"))
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    got = {k: sorted(v) for k, v in got.items()}
    top = topk.LONG
    assert got[100] == [(1, 300, top), (2, 1, 1024**2), (3, 2, 1024**2)]
    assert got[200] == [(1, 300, top), (2, 1, 1024**2), (3, 2, 1024**2)]
    # rows that share an id are candidates each, also of one another
    again = spark.createDataFrame([(100, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [1.0, 0.0]), (200, [0.0, 3.0]), (200, [0.0, 2.0])], "vec_id long, embedding array<float>")
    found = sorted(map(tuple, topk.top_k(again, F.col("vec_id") % 100 == 0, k=2).collect()))
    one = 1024**2
    assert found == [(100, 1, 1, 2 * one), (100, 2, 1, one), (200, 1, 200, 6 * one), (200, 1, 200, 6 * one), (200, 2, 1, 0), (200, 2, 1, 0)]
    assert got[300] == [(1, 1, top), (2, 2, top), (3, 2, top)] and got[400] == [(1, 9, 0)]


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_top_k_visits_cells_by_bound(spark, monkeypatch, spread):
    """Many cells, some of several parts (a third of all rows is one vector), chunks of queries; exact, and clusters are pruned."""
    monkeypatch.setattr(topk, "VALUES", 16 * 64)
    monkeypatch.setattr(topk, "CHUNK", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (12, 16))
    x = np.concatenate((centres[rng.integers(0, 12, 1400)] + rng.normal(0, spread, (1400, 16)), np.tile(centres[:1], (700, 1))))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[rng.permutation(len(x))])], "vec_id long, embedding array<double>").repartition(5).cache()
    routes, real = [], topk.route

    def seen(asked, table, k, first):
        routes.append((real(asked, table, k, first), table.value))
        return routes[-1][0]

    monkeypatch.setattr(topk, "route", seen)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()))
    rows = {r["vec_id"]: np.floor(1024 * np.array(r["embedding"])).astype(int) for r in df.collect()}
    want = []
    for q in range(0, len(rows), 20):
        best = sorted((-int(rows[q] @ v), i) for i, v in rows.items() if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    _, sizes, _, _ = routes[0][1][16]
    parts = -(-sizes // topk.room(16))
    assert len(parts) > 20 and parts.max() > 5
    visits = sum(r.count() for r, _ in routes)
    everywhere = parts.sum() * len(range(0, len(rows), 20))
    assert visits <= everywhere and (spread > 1 or visits < everywhere / 2)


def linked_pages():
    """Hosts that farm links to blocked ones, that merely hold a few, that trusted ones link to, and that have no page themselves."""
    link = "<a class='x' href='https://{}/x'>l</a>"
    rows = [(1, None, None), (2, "no scheme", ""), (3, "http://BAD.org/a?x=1#y", None), (4, "http://www.bad.org/fine/p", ""), (5, "http://bad.org", ""),
            (6, "http://farm.net/1", link.format("bad.org") * 5), (7, "http://fan.net/1", link.format("good.org")), (8, "http://notbad.org/", ""),
            (9, "HTTP://a.com?q", ""), (1, None, None), (10, "http://unseen.net/1", link.format("never.bad.org")), (11, "http://image.net/1", "<img src='https://bad.org/i.png'>" * 9),
            (12, "http://half.net/1", link.format("bad.org") + link.format("a.com")), (13, "http://few.net/1", link.format("bad.org") + link.format("a.com") * 2),
            (14, "http://good.org/1", (link.format("praised.net")) * 3), (15, "http://praised.net/1", link.format("bad.org") + link.format("a.com")), (16, "http://far.net/", link.format("farm.net"))]
    rows += [(20 + i, f"http://bad.org/{i}", "") for i in range(20)]
    rows += [(100 + i, f"http://big.org/{i}", link.format("bad.net")) for i in range(200)] + [(400 + i, f"http://bad.net/{i}", "") for i in range(20)]
    return rows


LINK_RULES = [("block", "bad.org/"), ("allow", "good.org/"), ("allow", "bad.org/fine/"), ("block", "bad.net/"), ("block", "bad.net/")]


def test_urls(spark):
    rows = linked_pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.link_filter(df, LINK_RULES).collect()}
    assert urls.link_filter(df, LINK_RULES).count() == len(rows)
    assert got[1] == ("", "", None, "allow") and got[2] == ("", "", None, "allow")
    assert got[3] == ("bad.org", "/a", "bad.org/", "block") and got[4] == ("www.bad.org", "/fine/p", "bad.org/fine/", "allow")
    assert got[5][1:3] == ("", None) and got[5][3] == "block"  # no rule fits an empty path; the host is distrusted
    assert got[6][3] == "block" and got[7][3] == "allow" and got[8] == ("notbad.org", "/", None, "allow") and got[9][:2] == ("a.com", "")
    assert got[10][3] == "block"  # the blocked host has no page of its own
    assert got[11][3] == "allow"  # images are no links
    assert got[12][3] == "block" and got[13][3] == "allow" and got[15][3] == "allow" and got[16][3] == "block"
    assert all(got[100 + i][3] == "block" for i in range(200))  # whatever the number of its pages


def test_urls_by_sql(spark, tmp_path, monkeypatch):
    """The registered query and its SQL on pages that link to one another."""
    import duckdb

    from cohortlens.llm import queries
    from tools.check import compare

    swap = {"bad.org": "spam.net", "good.org": "ok.org/fr", "bad.net": "bulk.net", "farm.net": "farm.com", "fan.net": "fan.com", "half.net": "half.com", "few.net": "few.com",
            "big.org": "big.com", "far.net": "far.com", "unseen.net": "unseen.com", "image.net": "image.com", "praised.net": "praised.com"}
    rows = []
    for i, url, html in linked_pages():
        for a, z in swap.items():
            url, html = url and url.replace(a, z), html and html.replace(a, z)
        rows.append((i, url, html))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    df = queries.QUERIES["op4_url_filter"](spark, str(tmp_path)).cache()
    assert compare(df, con, queries.ORACLES["op4_url_filter"]) == "ok"
    by = {r["host"]: r["verdict"] for r in df.where("rule IS NULL").collect()}
    assert by["farm.com"] == by["big.com"] == by["far.com"] == by["unseen.com"] == "block" and by["few.com"] == by["fan.com"] == by["image.com"] == by["praised.com"] == "allow"


def test_pages(spark):
    rows = [(1, None, None), (2, "http://h/", ""), (3, "http://h/", "just text &amp; more"), (4, "http://h/", "<p>" + "long " * 200_000), (4, "http://h/", "<p><p>"),
            (5, "x", "<div class=ad>no</div>"), (6, None, "<html><body><main><p>a<p>b</main>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("text", "n_chars", "winner", *CLASH):
        df = df.withColumn(c, F.lit("x"))
    got = extract.extract(df).collect()
    assert len(got) == len(rows)
    text = {(r["page_id"], r["n_chars"] > 0): r["text"] for r in got}
    assert text[1, False] == "" and text[2, False] == "" and text[3, True] == "just text & more" and text[6, True] == "a\nb"
    assert text[4, True] == ("long " * 200_000).strip()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (recompress.remove_repeats(docs), simhash.near_duplicates(docs), counts.token_counts(docs, BPE, 5), packing.pack(docs, BPE),
               bpe.decode(bpe.encode(docs, RANKS), RANKS), quality.line_quality(docs), licenses.scan(docs), topk.top_k(vectors, F.col("vec_id") > 0),
               urls.link_filter(pages, [("block", "x/")]), extract.extract(pages)):
        assert df.count() == 0
