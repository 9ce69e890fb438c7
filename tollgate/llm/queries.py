"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    automaton_dedup,
    decontaminate,
    importance,
    kneser_ney,
    lattice,
    licenses,
    periodic_runs,
    personal_data,
    secrets_scan,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    tree_search,
)
from .frames import table, texts


#: The tokenizer model that the registered query and the pipeline use.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), MODEL_FILE, keep_ids=False)
    return out.drop("ids").withColumnRenamed("id", "doc_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id",
        "lang",
        F.col("_p.n").alias("n_words"),
        F.col("_p.word").alias("word_perplexity"),
        F.col("_p.shape").alias("shape_perplexity"),
        F.col("_max_word").alias("word_threshold"),
        F.col("_max_shape").alias("shape_threshold"),
        F.col("_keep").alias("keep"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return secrets_scan.find_secrets(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        *[secrets_scan.n_of(spans, k).alias(f"n_{k}") for k in secrets_scan.KINDS],
        F.sha2(secrets_scan.span_list(spans, secrets_scan.KINDS[:3]), 256).alias("base_sha256"),
        secrets_scan.span_list(spans, secrets_scan.KINDS).alias("spans"),
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep=False)
    return out.drop("kept").withColumnRenamed("id", "doc_id")


def op7_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_texts(table(spark, sf_dir, "documents"), MODEL_FILE).withColumnRenamed("id", "doc_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = automaton_dedup.remove_passages(table(spark, sf_dir, "documents"), keep=False)
    return out.drop("kept").withColumnRenamed("id", "doc_id")


def op10_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tree_search.search(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def periodic_tails(docs: DataFrame) -> DataFrame:
    """(id, text): a tenth of the documents, by CRC-32 of the id, repeat their words from some place on."""
    blank = r"[^\x20\x09-\x0D]+"
    h = F.crc32(F.col("id").cast("string").cast("binary"))
    own = texts(docs).withColumn("h", h).withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(blank), F.lit(0))))
    own = own.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    own = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    own = own.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = F.transform(
        F.sequence(F.lit(0), (F.col("n") - 1).cast("int")),
        lambda i: F.get("words", F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")),
    )
    return own.select("id", F.when(F.col("n") > 0, F.array_join(place, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(periodic_tails(table(spark, sf_dir, "documents")), "id", keep=False)
    longest = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda best, x: F.when(best.isNull() | (x["length"] > best["length"]), x).otherwise(best),  # runs come by start, then period
    )
    line = F.transform("runs", lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n")))
    out = out.select("*", longest.alias("best"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return personal_data.find_personal_data(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        *[secrets_scan.n_of(spans, k).alias(f"n_{k}") for k in personal_data.BASE_KINDS],
        F.sha2(secrets_scan.span_list(spans, personal_data.BASE_KINDS), 256).alias("base_sha256"),
        secrets_scan.span_list(spans, personal_data.KINDS).alias("spans"),
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id").select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_licenses": op4_licenses,
    "op5_simhash": op5_simhash,
    "op6_suffix_array": op6_suffix_array,
    "op7_lattice": op7_lattice,
    "op8_decontamination": op8_decontamination,
    "op9_substrings": op9_substrings,
    "op10_tree_search": op10_tree_search,
    "op11_runs": op11_runs,
    "op12_personal_data": op12_personal_data,
    "op13_importance": op13_importance,
}

#: DuckDB SQL for the queries that it can express.  The others rest on models, hashes, compression or an
#: approximate search, and are tested against brute force.
ORACLE_SQL = {
    "op8_decontamination": r"""
WITH doc AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
item AS (
  SELECT item_id AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT item, ws, least(13, len(ws)) AS n, unnest(range(0, greatest(len(ws) - 12, 1))) AS s FROM item WHERE len(ws) > 0),
item_win AS (SELECT DISTINCT item, n, array_to_string(ws[s + 1 : s + n], ' ') AS text FROM win),
size AS (SELECT DISTINCT n FROM item_win),
doc_start AS (SELECT id, ws, n, unnest(range(0, len(ws) - n + 1)) AS s FROM doc, size),
hit AS (
  SELECT id, s, n, item FROM (SELECT id, s, n, array_to_string(ws[s + 1 : s + n], ' ') AS text FROM doc_start) JOIN item_win USING (n, text)),
covered AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY id),
named AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM hit) GROUP BY id),
token AS (SELECT id, unnest(ws) AS term, unnest(range(0, len(ws))) AS pos FROM doc),
term_count AS (SELECT term, count(*) AS n FROM token GROUP BY term),
place AS (
  SELECT win.item, win.n AS len, win.s, win.s + o AS off, ws[win.s + o + 1] AS term FROM win, range(0, 13) AS t(o) WHERE o < win.n),
ranked AS (
  SELECT item, s, len, off, count(*) OVER (PARTITION BY item, s) AS known,
    row_number() OVER (PARTITION BY item, s ORDER BY term_count.n, off) AS rn FROM place JOIN term_count USING (term)),
anchor AS (
  SELECT DISTINCT r.item, r.off, item.ws[r.off + 1] AS term FROM ranked r JOIN item USING (item) WHERE known = len AND rn <= 2),
found AS (SELECT id, item, pos - off AS shift, off FROM token JOIN anchor USING (term)),
pair AS (
  SELECT id, item, off, shift - lag(shift) OVER w AS gap, lag(off) OVER w AS other FROM found
  WINDOW w AS (PARTITION BY id, item ORDER BY shift, off)),
near AS (SELECT id, count(DISTINCT item) AS n_near FROM pair WHERE gap <= 3 AND other <> off GROUP BY id)
SELECT id AS doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated,
  coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN covered USING (id) LEFT JOIN named USING (id) LEFT JOIN near USING (id)
""",
    "op9_substrings": r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(ws[s : s + 12], ' ') AS text FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS s FROM doc)),
first AS (SELECT text, min(doc_id) AS first_id FROM win GROUP BY text),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN first USING (text) WHERE first_id < doc_id),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM doc),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
""",
}
