"""One registered query per operator, with the SQL that states the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from .common import words
from . import bpe, counts, extract, licenses, negatives, packing, periodic, quality, recompress, sharding, simhash, topk, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WS = "[\\x20\\x09-\\x0D]"
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MD5 = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host FROM documents),
ws AS (SELECT rid, list_filter(regexp_split_to_array(t, '{WS}+'), lambda x: x <> '') AS w FROM d),
grams AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM ws)),
twice AS (SELECT rid, i FROM grams WHERE (rid, g) IN (SELECT (rid, g) FROM grams GROUP BY rid, g HAVING count(*) > 1)),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid),
lines AS (SELECT rid, host, t, line, translate(trim(regexp_replace(line, '{WS}+', ' ', 'g'), ' '), {AZ}) AS norm
          FROM (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
sized AS (SELECT *, len(string_split(norm, ' ')) AS k FROM lines),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
once AS (SELECT DISTINCT host, t, norm, k FROM sized),
frequent AS (SELECT host, norm FROM once JOIN hosts USING (host) GROUP BY host, norm, n HAVING count(*) > {quality.MIN_DOCS} AND count(*) > {quality.SHARE} * n),
hits AS (SELECT o.* FROM once o JOIN frequent USING (host, norm)),
hit_texts AS (SELECT h.host, h.t, len(any_value(w)) AS n_words, min({MD5.format('norm')}) AS first, {MD5.format('h.t')} AS mark
              FROM (SELECT DISTINCT d.host, d.t, w FROM d JOIN ws USING (rid)) c JOIN hits h ON c.host = h.host AND c.t = h.t GROUP BY h.host, h.t),
classes AS (SELECT host, first, arg_min(t, mark) AS one, arg_min(n_words, mark) AS one_words FROM hit_texts GROUP BY host, first HAVING count(*) > 1),
copies AS (SELECT o.host, o.t FROM hit_texts o JOIN classes c ON o.host = c.host AND o.first = c.first AND o.t <> c.one
           JOIN hits h ON h.host = o.host AND h.t = o.t JOIN hits h2 ON h2.host = o.host AND h2.t = c.one AND h2.norm = h.norm
           GROUP BY o.host, o.t HAVING 9 * sum(h.k) >= 4 * (any_value(o.n_words) + any_value(c.one_words))),
boiler AS (SELECT host, norm FROM hits ANTI JOIN copies USING (host, t) JOIN hosts USING (host) GROUP BY host, norm, n
           HAVING count(*) > {quality.MIN_DOCS} AND count(*) > {quality.SHARE} * n),
lost AS (SELECT rid, sum(k) AS n FROM sized JOIN boiler USING (host, norm) GROUP BY rid),
base AS (SELECT d.rid, d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed
         FROM d JOIN ws USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed,
       n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_removed >= {quality.MIN_WORDS} AS kept
FROM base"""


@query("op10_quality_rules", OP10)
def op10(spark, sf):
    rows = quality.line_quality(table(spark, sf, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed", "base_failed", "kept")


@query("op5_byte_bpe")
def op5(spark, sf):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.decode(bpe.encode(table(spark, sf, "documents"), path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_packing")
def op6(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=2048, end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_token_counts")
def op8(spark, sf):
    return counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


OP1 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.rid, q.vec_id AS query_id, v.rid AS other, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
          FROM v q JOIN v ON len(q.e) = len(v.e) AND q.rid <> v.rid WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS INT) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query("op1_top_k", OP1)
def op1(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def rank_rounds(name: str, onto: str, by: str, seed: str) -> str:
    """The rounds of spreading a score as one CTE each."""
    out = [f"{name}0 AS MATERIALIZED (SELECT host, {seed} AS seed, {seed} AS score FROM hosts)"]
    for i in range(urls.ROUNDS):
        out.append(f"""{name}{i + 1} AS MATERIALIZED (
SELECT n.host, seed, seed + {urls.DAMPING} * coalesce(got, 0) AS score
FROM {name}{i} n LEFT JOIN (SELECT {onto} AS onto, sum(score * share) AS got FROM {name}{i} JOIN forth e ON host = e.{by} GROUP BY {onto}) s ON n.host = s.onto)""")
    return ",\n".join(out)


FITS = " ".join(
    f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{{}}'".format(r)
    for _, r in sorted(RULES, key=lambda x: -len(x[1])))
SAYS = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in RULES) + " END"
PATH = "regexp_extract({}, '^[^/?#]*([^?#]*)', 1)"
HOST = f"translate(regexp_extract({{}}, '^([^/?#]*)', 1), {AZ})"
OP4 = f"""
WITH cut AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, {HOST.format('rest')} AS host, {PATH.format('rest')} AS path FROM cut),
ruled AS (SELECT *, CASE {FITS} END AS rule FROM parts),
judged AS (SELECT *, {SAYS} AS says FROM ruled),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '{urls.LINK.replace("'", "''")}', 1)) AS link FROM parts),
ends AS (SELECT src, {HOST.format('target')} AS host, {PATH.format('target')} AS path FROM (SELECT src, regexp_replace(link, '(?i)^(https?:)?//', '') AS target FROM links)),
linked AS (SELECT *, CASE rule_ WHEN '' THEN NULL ELSE {SAYS.replace('CASE rule', 'CASE rule_')} END AS says
           FROM (SELECT *, CASE {FITS} ELSE '' END AS rule_ FROM ends WHERE src <> host AND src <> '' AND host <> '')),
w AS MATERIALIZED (SELECT src, host AS dst, count(*) AS w FROM linked GROUP BY src, host),
forth AS MATERIALIZED (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS share FROM w),
own AS (SELECT host, count(*) AS n, count(*) FILTER (says = 'allow') AS allowed, count(*) FILTER (says = 'block') AS blocked FROM judged WHERE host <> '' GROUP BY host),
known AS (SELECT * FROM own UNION ALL
          SELECT host, count(*), count(*) FILTER (says = 'allow'), count(*) FILTER (says = 'block') FROM linked WHERE host NOT IN (SELECT host FROM own) GROUP BY host),
hosts AS MATERIALIZED (SELECT host, allowed / n AS trusted, blocked / n AS distrusted FROM known),
{rank_rounds('t', 'dst', 'src', 'trusted')},
{rank_rounds('d', 'src', 'dst', 'distrusted')},
bad AS (SELECT t.host FROM t{urls.ROUNDS} t JOIN d{urls.ROUNDS} d ON t.host = d.host
        WHERE round(d.score - t.score, {urls.PLACES}) > 0 AND round(d.score - {urls.MARGIN}, {urls.PLACES}) > 0)
SELECT page_id, j.host, path, rule, coalesce(says, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN bad ON j.host = bad.host"""


@query("op4_url_filter", OP4)
def op4(spark, sf):
    return urls.link_filter(table(spark, sf, "pages"), RULES)


@query("op9_main_text")
def op9(spark, sf):
    return extract.extract(table(spark, sf, "pages"))


@query("op3_simhash")
def op3(spark, sf):
    rows = simhash.near_duplicates(table(spark, sf, "documents"), width=4, seed=42, tau=4)
    return rows.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


@query("op2_substring_dedup")
def op2(spark, sf):
    rows = recompress.remove_repeats(table(spark, sf, "documents"), window=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


PUNCTUATION = "'!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~'"


def sql_shingles(source: str, columns: str, text: str) -> str:
    return f"""SELECT {columns}, CASE WHEN len(w) < {licenses.WIDTH} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {licenses.WIDTH - 1}], ' ') END AS s
FROM (SELECT {columns}, w, unnest(range(1, greatest(len(w) - {licenses.WIDTH - 2}, 2))) AS i
      FROM (SELECT {columns}, list_filter(list_transform(regexp_split_to_array(lower(coalesce({text}, '')), '{WS}+'), lambda x: trim(x, {PUNCTUATION})),
                                          lambda x: x <> '') AS w FROM {source}) WHERE len(w) > 0)"""


TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES.items())
TELLING_ROWS = ", ".join(f"('{n}', '{p}')" for n, phrases in licenses.TELLING.items() for p in phrases)
OP7 = f"""
WITH t(license, body) AS (VALUES {TEMPLATE_ROWS}),
tell(license, phrase) AS (VALUES {TELLING_ROWS}),
ts AS (SELECT DISTINCT license, s FROM ({sql_shingles('t', 'license', 'body')})),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
ds AS (SELECT DISTINCT rid, doc_id, s FROM ({sql_shingles('d', 'rid, doc_id', 'text')})),
n AS (SELECT license, count(*) AS n_template FROM ts GROUP BY license),
shared AS (SELECT rid, doc_id, license, s FROM ds JOIN ts USING (s)),
told AS (SELECT rid, license, count(DISTINCT phrase) AS n FROM shared JOIN tell USING (license) WHERE contains(' ' || s || ' ', ' ' || phrase || ' ') GROUP BY rid, license),
wanted AS (SELECT license, count(*) AS n FROM tell GROUP BY license)
SELECT doc_id, license, n_template, n_shared, n_shared / n_template AS containment
FROM (SELECT rid, doc_id, license, count(*) AS n_shared FROM shared GROUP BY rid, doc_id, license) JOIN n USING (license)
     LEFT JOIN told USING (rid, license) LEFT JOIN wanted USING (license)
WHERE n_shared / n_template >= {licenses.LEAST} AND coalesce(told.n, 0) = coalesce(wanted.n, 0)"""


@query("op7_license_scan", OP7)
def op7(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


SHARDS = 24
# The smallest feasible capacity by a binary search whose every step fills all shards greedily.
OP11 = f"""
WITH RECURSIVE d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + {sharding.OVERHEAD} AS BIGINT) AS size, coalesce(text, '') AS t,
           {MD5.format("coalesce(text, '')")} AS place FROM documents),
every AS (SELECT place, CAST(sum(size) AS BIGINT) AS bytes FROM d GROUP BY place),
ranked AS (SELECT *, row_number() OVER w - 1 AS above, sum(bytes) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lft FROM every
           WINDOW w AS (ORDER BY bytes DESC, place)),
large AS (SELECT place, CAST(row_number() OVER (ORDER BY place) - 1 AS INT) AS shard
          FROM (SELECT place, bool_and(bytes * ({SHARDS} - above) >= lft) OVER (ORDER BY above) AS fills FROM ranked WHERE above < {SHARDS}) WHERE fills),
have AS (SELECT {SHARDS} - count(*) AS n FROM large),
g AS (SELECT place, CAST(sum(bytes) OVER (ORDER BY place) AS BIGINT) AS last FROM every WHERE place NOT IN (SELECT place FROM large)),
e AS MATERIALIZED (SELECT list(last ORDER BY last) AS e, max(last) AS total, any_value(n) AS n FROM g, have),
search(lo, hi) AS (
  SELECT CAST(0 AS BIGINT), total FROM e
  UNION ALL
  SELECT CASE WHEN full_ THEN lo ELSE mid + 1 END, CASE WHEN full_ THEN mid ELSE hi END
  FROM (SELECT lo, hi, mid, list_reduce(list_transform(range(n + 1), lambda z: CAST(0 AS BIGINT)), lambda p, z:
                 greatest(list_max(list_filter(e, lambda x: x <= p + mid)), list_min(list_filter(e, lambda x: x > p)))) = total AS full_
        FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM search WHERE lo < hi), e)),
least AS (SELECT lo AS capacity FROM search WHERE lo = hi LIMIT 1),
cuts(k, p) AS (
  SELECT 0, CAST(0 AS BIGINT)
  UNION ALL
  SELECT k + 1, greatest(list_max(list_filter(e, lambda x: x <= p + capacity)), list_min(list_filter(e, lambda x: x > p))) FROM cuts, least, e WHERE k < n - 1),
poly AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
           CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END)) AS tab),
crc AS (SELECT place, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), CAST(4294967295 AS BIGINT)) AS text_crc32 FROM (SELECT DISTINCT place, t FROM d), poly),
dealt AS (SELECT place, CAST((SELECT count(*) FROM cuts WHERE k > 0 AND p < last) + {SHARDS} - (SELECT n FROM have) AS INT) AS shard FROM g UNION ALL FROM large)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM d JOIN dealt USING (place) JOIN crc USING (place)"""


@query("op11_sharding", OP11)
def op11(spark, sf):
    rows = sharding.shard(table(spark, sf, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """Every tenth document, by a hash of its id, repeats a stretch of its words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w = words(F.col("text"))
    df = docs.select("doc_id", "text", (F.floor(h / 10)).cast("long").alias("g"), (h % 10 == 0).alias("made"))
    df = df.withColumn("w", F.when(F.col("made"), w)).withColumn("n", F.size("w").cast("long"))
    df = df.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    df = df.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get(F.col("w"), (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return df.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(again, " ")).alias("text"))


@query("op12_periodic_runs")
def op12(spark, sf):
    rows = periodic.periodic_runs(made_periodic(table(spark, sf, "documents")))
    said = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return rows.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(said, 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP13 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.rid, q.vec_id AS anchor_id, v.rid AS other, v.vec_id, q.label = v.label AS same, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
           FROM v q JOIN v ON len(q.e) = len(v.e) AND q.rid <> v.rid WHERE q.vec_id % 100 = 0),
positive AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS nth FROM scored WHERE same) WHERE nth <= 5),
ranked AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                  CAST(row_number() OVER (PARTITION BY p.rid, p.nth ORDER BY n.score DESC, n.vec_id, n.other) AS INT) AS rank
           FROM positive p JOIN scored n ON n.rid = p.rid AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""


@query("op13_hard_negatives", OP13)
def op13(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)
