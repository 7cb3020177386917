"""Corpus pipeline: toxicity, line de-duplication, near-duplicate removal,
benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``docs``. ``run`` applies them to
the ``documents`` table, each stage's result written as Parquet to the shared
work folder and read again.

No stage fails on null or empty texts, repeated rows, empty tables or further
columns; what each does with them stands at its function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from sievekit.llm.common import read_table, row_hash, stored
from sievekit.llm.queries import vocabulary_path

MIN_DOCS = 10
LONG_WORDS = 50                 # a line of more words is a passage: two documents are enough
PERCENT = 85


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels`` and these texts,
    scores 0.5 or more go. Null and empty texts score as the intercept does
    and stay unless everything goes; a null id is never a training row's."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model, out_col="_tx_score")
            .where(F.col("_tx_score") < 0.5).drop("_tx_score"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ``MIN_DOCS`` documents, and lines of over ``LONG_WORDS``
    words found in two, stay in the first one only; ``n_chars`` follows the text. A document with nothing but such lines left
    goes; documents that lose no line, empty ones too, stay as they are (null
    texts become empty)."""
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=MIN_DOCS, keep="first", long_words=LONG_WORDS)
    out = line_dedup.apply_bitmaps(docs, bitmaps)
    bare = F.octet_length(F.btrim(F.col("_ld_kept"), F.lit(line_dedup.ASCII_SPACE))) == 0
    out = (out.where(~((F.col("_ld_n_dropped") > 0) & bare))
              .withColumn("text", F.col("_ld_kept")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_ld_n_dropped") > 0, F.char_length("text"))
                             .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-duplicate texts the one with the smallest id
    stays (a null id comes last), one row of it if it repeats. Unlinked texts
    stay, also under one id or none; documents without words all stay."""
    groups = near_dup.near_duplicate_groups(docs, percent=PERCENT).where("component is not null")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th"))
    stay = (groups.groupBy("component").agg(F.min(order).alias("r"))
                  .select(F.col("r.id").alias("_nd_id"), F.col("r.th").alias("_nd_k")))
    text = F.coalesce("text", F.lit(""))
    bare = F.octet_length(F.btrim(text, F.lit(line_dedup.ASCII_SPACE))) == 0
    keyed = docs.where(~bare).withColumn("_nd_th", row_hash(text))
    kept = keyed.join(stay, F.col("doc_id").eqNullSafe(F.col("_nd_id")) & (F.col("_nd_th") == F.col("_nd_k")))
    return kept.dropDuplicates(["_nd_id", "_nd_k"]).select(*docs.columns).unionByName(docs.where(bare))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a
    whole shorter item) go."""
    found = decontaminate.hits(docs, read_table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("id").alias("_dc_id"), F.col("th").alias("_dc_k")).distinct()
    keyed = docs.withColumn("_dc_th", row_hash(F.coalesce("text", F.lit(""))))
    clean = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_dc_id")) & (F.col("_dc_th") == F.col("_dc_k")),
                       "left_anti")
    return clean.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row per piece of a document."""
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"), end_id=1)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("packing", pack_sequences)]

#: the classifier, the tokeniser and the packing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
