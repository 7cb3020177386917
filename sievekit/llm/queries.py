"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.llm import (capture_archive, decontaminate, html_extract, line_dedup, near_dup, packing,
                          piecewise_hash, prefix_trie, sharding, structure_repair, suffix_dedup, token_counts,
                          toxicity)
from sievekit.llm.common import read_table, row_hash

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    out = html_extract.extract(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_dup.near_duplicate_groups(docs, percent=85)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = read_table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, bench)
    base = docs.select("doc_id", row_hash(F.coalesce("text", F.lit(""))).alias("rh"),
                       decontaminate.word_count(F.col("text")).alias("n_words"))
    j = base.join(found, base["doc_id"].eqNullSafe(found["id"]) & (base["rh"] == found["th"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return j.select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"))


ORACLE["op3_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
hw AS (SELECT doc_id, count(DISTINCT q) AS n_hit
       FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items,
         sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shard(docs, shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"), end_id=1)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1, keep="none")
    out = line_dedup.apply_bitmaps(docs, bitmaps)
    return out.select("doc_id", F.col("_ld_n_lines").alias("n_lines"),
                      F.col("_ld_n_dropped").alias("n_dropped"),
                      F.sha2("_ld_kept", 256).alias("kept_sha256"))


ORACLE["op6_line_dedup"] = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s),
k AS (SELECT doc_id, pos, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*)::BIGINT AS n_lines, count(hot.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot ON k.key = hot.key GROUP BY k.doc_id
"""


@query
def op7_capture_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = capture_archive.archive_round_trip(pages, min_bytes=0)
    return out.select(F.col("uid").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                      "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = token_counts.byte_level_vocabulary(vocabulary_path("byte_bpe_50k.json"))
    return token_counts.token_counts(docs, pieces)


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return piecewise_hash.neighbour_likeness(docs)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ids = prefix_trie.rebuilt(prefix_trie.turns(read_table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(rows, ids)


@query
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    return structure_repair.repair(structure_repair.damage(rows), rows.select(F.col("conv_id").alias("c")))


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=400).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
