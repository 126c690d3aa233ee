"""Quality rules by cross-document line frequency (DataFrame functions only).

Lines are normalised (white space collapsed, A-Z lower-cased) and hashed. Per host a line is frequent if more than
``share`` of the host's distinct texts, and more than ``min_docs``, hold it. Near copies count once, as copies do: of the
texts that have the frequent line of the smallest hash in common, one stands for all those whose frequent lines, which
both hold, are 0.8 or more of the words of the two, shared ones counted once. Lines still above the limits without the
votes of these are boilerplate: they are removed, and a document left with fewer than ``min_words`` words is rejected.

Defined cases: a null or empty text has no words and fails the base rules; null hosts form one host; repeated rows
each get their verdict and count once as texts; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, SPLIT, ascii_lower, salted_join, settle, words

SYMBOLS = "#*$%&|<>"
SHARE = 0.05
MIN_DOCS = 20
MIN_WORDS = 10
ROWS_PER_TASK = 50_000


def normal(lines: Column) -> Column:
    """An array of lines with white space collapsed and trimmed, A-Z lower-cased."""
    flat = F.transform(lines, lambda x: F.btrim(F.regexp_replace(x, SPLIT, " "), F.lit(" ")))
    # lower() is fast, but touches more than A-Z where there is more than ASCII
    return F.transform(flat, lambda x: F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(ascii_lower(x)))


def text_lines(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def hashed(text: Column) -> Column:
    """60 bits of the MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def ranked_windows(hashes: str) -> Column:
    """(hash, place) of the windows in order of hash, if any hash occurs twice; else empty."""
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), ranked).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def covered_words(ranked: str, width: int) -> Column:
    """Words inside windows whose hash another window has: those equal to a neighbour, their spans united."""
    at = F.col(ranked)
    twice = F.filter(at, lambda x, k: (x["h"] == F.coalesce(F.get(at, k - 1)["h"], F.bitwise_not(x["h"]))) | (x["h"] == F.coalesce(F.get(at, k + 1)["h"], F.bitwise_not(x["h"]))))
    return F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + width - F.greatest(a["end"], i)).alias("n"), (i + width).alias("end")),
        lambda a: a["n"],
    )


def base_rules(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with the counts of each ``_text``, ``base_failed``, and ``_lines``: hash and words of each line."""
    none = F.array().cast("array<bigint>")
    at = F.col("_hash")
    df = docs.withColumn("_text", F.coalesce(F.col("_text"), F.lit("")))
    df = df.withColumn("_words", words(F.col("_text"))).withColumn("_own_lines", text_lines(F.col("_text")))
    df = df.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long")).withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("_grams", F.when(
        F.size("_hash") >= width,
        F.transform(F.slice("_hash", F.lit(1), F.size("_hash") - (width - 1)),
                    lambda h, i: F.xxhash64(h, *[F.get(at, i + k) for k in range(1, width)])),
    ).otherwise(none))
    df = df.withColumn("_normal", normal(F.col("_own_lines")))
    df = df.withColumn("_lines", F.transform("_normal", lambda x: F.struct(
        hashed(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("w"))))
    df = (
        df.withColumn("n_symbols", F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_own_lines") - F.size(F.array_distinct("_own_lines"))).cast("long"))
        .withColumn("_ranked", ranked_windows("_grams"))
        .withColumn("_key", F.struct(hashed(F.col("_text")).alias("at"), F.xxhash64("_text").alias("also")))
    )
    df = df.withColumn("n_repeat_words", covered_words("_ranked", width).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return df.drop("_text", "_words", "_hash", "_grams", "_own_lines", "_normal", "_ranked")


def near_copies(hits: DataFrame) -> DataFrame:
    """_row of the texts that another text stands for; ``hits`` has the frequent lines (h, w) of every text (_row, _key, n_words) once."""
    text = [F.first(c).alias(c) for c in ("_host", "n_words", "_key")]
    firsts = settle(hits.groupBy("_row").agg(F.min("h").alias("first"), *text), "firsts")
    chosen = F.min_by(F.struct("_row", "n_words"), "_key")
    classes = firsts.groupBy("_host", "first").agg(chosen.alias("one"), F.count("*").alias("_count")).where("_count > 1")
    classes = settle(classes.select("_host", "first", F.col("one._row").alias("one"), F.col("one.n_words").alias("one_words"), "_count"), "classes")
    others = salted_join(firsts, classes, ["_host", "first"], F.col("_row"), "_count", ROWS_PER_TASK).where("_row <> one")
    others = settle(others.select("_row", "one", "one_words", "n_words"), "others")
    theirs = hits.select("_row", "h", "w").join(others, "_row")
    members = others.groupBy("one").agg(F.count("*").alias("_count"))
    lines = hits.select(F.col("_row").alias("one"), "h").join(members, "one")
    common = salted_join(theirs, lines, ["one", "h"], F.col("_row"), "_count", ROWS_PER_TASK, "left_semi")
    both = common.groupBy("_row").agg(F.sum("w").alias("shared"), F.first(F.col("n_words") + F.col("one_words")).alias("both"))
    return both.where("9 * shared >= 4 * both").select("_row")


def boilerplate(rows: DataFrame, share: float, min_docs: int) -> DataFrame:
    """The lines above the limits: _host, h, and the number of documents that may hold them (_count)."""
    texts = settle(rows.groupBy("_host", "_key").agg(
        F.min("_row").alias("_row"), F.first(F.array_distinct("_lines")).alias("_lines"), F.first("n_words").alias("n_words")), "texts")
    hosts = texts.groupBy("_host").agg(F.count("*").alias("_texts"))
    lines = texts.select("_host", "_row", "_key", "n_words", F.explode("_lines").alias("x")).select("_host", "_row", "_key", "n_words", "x.h", "x.w")

    def above(counted: DataFrame) -> DataFrame:
        few = counted.where(F.col("_count") > min_docs)
        return few.join(hosts, "_host").where(F.col("_count") > share * F.col("_texts")).drop("_texts")

    frequent = settle(above(lines.groupBy("_host", "h").agg(F.count("*").alias("_count"))), "frequent")
    hits = settle(salted_join(lines, frequent, ["_host", "h"], F.col("_row"), "_count", ROWS_PER_TASK, "left_semi"), "hits")
    copies = settle(near_copies(hits), "copies")
    again = above(hits.join(copies, "_row", "left_anti").groupBy("_host", "h").agg(F.count("*").alias("_count")))
    # copies count once as texts, but their rows all meet the line: the salts follow the rows
    kept = settle(again.select("_host", "h"), "boilerplate")
    held = rows.select("_host", F.explode(F.transform("_lines", lambda x: x["h"])).alias("h")).groupBy("_host", "h").agg(F.count("*").alias("_count"))
    return settle(held.join(kept, ["_host", "h"]), "boilerplate-rows")


def line_quality(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", host: str = "source", share: float = SHARE,
    min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with counts, ``base_failed``, ``n_removed`` (words of removed lines), ``_removed`` (their hashes) and ``kept``."""
    docs = docs.select(*keep, F.col(text).alias("_text"), F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")).alias("_host"))
    rows = settle(base_rules(docs).withColumn("_row", F.monotonically_increasing_id()), "quality")
    slim = rows.select("_row", "_host", "_key", "_lines", "n_words")
    limits = boilerplate(slim, share, min_docs)
    held = slim.select("_row", "_host", F.explode("_lines").alias("x")).select("_row", "_host", "x.h", "x.w")
    lost = salted_join(held, limits, ["_host", "h"], F.col("_row"), "_count", ROWS_PER_TASK, "left_semi")
    lost = lost.groupBy("_row").agg(F.sum("w").alias("n_removed"), F.collect_set("h").alias("_removed"))
    out = rows.drop("_host", "_key", "_lines").join(lost, "_row", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed") >= min_words)).drop("_row")


def cleaned(df: DataFrame, text: str = "text") -> Column:
    """The text of a row of ``line_quality`` without its removed lines."""
    lines = F.split(F.col(text), "\n", -1)
    pairs = F.arrays_zip(lines.alias("line"), normal(lines).alias("normal"))
    left = F.transform(F.filter(pairs, lambda x: ~F.array_contains("_removed", hashed(x["normal"]))), lambda x: x["line"])
    return F.when(F.col("_removed").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
