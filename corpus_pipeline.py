"""From raw documents to packed training sequences: quality rules, near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of their docs.

Defined cases: rows without an id always stay in the near-dedup; of rows that share an id one stays there; a document
whose words have all gone with repeated passages goes; an empty table passes through as such; columns beyond those of
``documents`` pass through, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm import packing, quality, recompress, simhash
from cohortlens.session import cut

# Near-duplicates differ in 4 or fewer bits of the fingerprint of their four-word shingles.
NEAR = {"width": 4, "seed": 42, "tau": 4}


def rows_of(docs: DataFrame, df: DataFrame, text) -> DataFrame:
    """The rows held in ``df``'s struct ``doc``, with another text, and n_chars to match."""
    df = df.select("doc", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return df.select(*[changed.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits of their host go from those that stay."""
    kept = quality.line_quality(docs.select(F.struct("*").alias("doc"), "text", "source"), keep=("doc",)).where("kept")
    return rows_of(docs, kept, quality.cleaned(kept, "doc.text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect, the one with the smallest id stays."""
    groups = simhash.near_duplicates(docs, **NEAR)
    lost = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("lost")).distinct()
    rows = docs.select(F.struct("*").alias("doc")).join(lost, F.col("doc.doc_id") == F.col("lost"), "left_anti")
    # of rows with one id the first stays; rows without an id are dealt by their text and all stay
    same = Window.partitionBy("doc.doc_id", F.when(F.col("doc.doc_id").isNull(), F.xxhash64("doc.text"))).orderBy("doc.text")
    return rows.withColumn("nth", F.row_number().over(same)).where("nth = 1 OR doc.doc_id IS NULL").select("doc.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; a text that loses none stays as it is."""
    rows = recompress.remove_repeats(docs, window=13, whole=True).where("n_words = 0 OR n_removed < n_words")
    return rows_of(docs, rows, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc.text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of up to 2,048 tokens, each from one document."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end=1)
    return pieces.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", pack)]

# Connected components and the library's token ids are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
