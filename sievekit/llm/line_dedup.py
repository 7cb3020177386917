r"""Corpus-wide line de-duplication that moves hashes and returns bitmaps.

Lines become (128-bit key hash, document, position) rows. They are range
partitioned by (hash, document), so a line that a third of all documents hold
spreads over many partitions, and sorted by position inside a document; one
streaming pass marks a key's first occurrence in each document, and only one
count per (key, partition) is shuffled to find keys found in ``min_docs``
documents. What comes back per document is its *keep bitmap*, run-length
encoded as (start, length) runs of kept lines; no text is in any of these
shuffles.

Null or empty text is one empty line. Lines whose key has fewer than
``min_chars`` code points are always kept. Rows that repeat both id and text
count as one document; rows that repeat an id with another text count as
different ones. Null ids are an id like any other. An empty table gives an
empty result. The input may have any further columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import ASCII_SPACE, ascii_lower, let, row_hash, stored


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int, long_words: int | None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = F.split(ascii_lower(text), "\n", -1)
    # the outer form: the plain one infers a filter that splits the text again
    lines = (docs.select(F.col(id_col).alias("id"), row_hash(text).alias("th"),
                         split.alias("lines"), F.size(split).alias("n_lines"))
                 .select("id", "th", "n_lines", F.posexplode_outer("lines").alias("pos", "line")))
    key = F.btrim(F.col("line"), F.lit(ASCII_SPACE))
    marks = []
    if long_words is not None:               # so many words take at least 2 * long_words + 1 characters
        words = F.size(F.split("line", r"[ \t\n\x0B\f\r]+", -1))
        marks = [F.when(F.char_length("line") > 2 * long_words, words > long_words).otherwise(False).alias("long")]
    return (lines.withColumn("line", key)
                 .where(F.char_length("line") >= min_chars)
                 .select("id", "th", "n_lines", "pos", F.xxhash64("line").alias("h1"),
                         F.xxhash64(F.lit(1), "line").alias("h2"), *marks))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = 10, min_chars: int = 1, keep: str = "none",
                 long_words: int | None = None, long_docs: int = 2) -> DataFrame:
    """One row per document that loses a line: ``id``, ``th`` (text hash),
    ``n_lines``, ``n_dropped``, ``keep_runs`` array<struct<start,len>>.

    Keys found in at least ``min_docs`` documents lose all their lines
    (``keep="none"``) or all but the first occurrence in (id, position) order
    (``keep="first"``). With ``long_words``, lines of more words need only
    ``long_docs`` documents.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    rows = stored(_line_rows(docs, id_col, text_col, min_chars, long_words), "lines")
    ordered = (rows.repartitionByRange("h1", "h2", "id", "th")
                   .sortWithinPartitions("h1", "h2", "id", "th", "pos"))
    in_doc = Window.partitionBy("h1", "h2", "id", "th").orderBy("pos")
    firsts = ordered.withColumn("rn", F.row_number().over(in_doc)).where("rn = 1")
    aggs = [F.count(F.lit(1)).alias("n_docs")]
    if keep == "first":
        aggs.append(F.min(F.struct("id", "th", "pos")).alias("first"))
    frequent = F.col("n_docs") >= min_docs
    if long_words is not None:
        aggs.append(F.max("long").alias("is_long"))
        frequent |= F.col("is_long") & (F.col("n_docs") >= long_docs)
    # written, so that the join's two sides are plain shuffles and a frequent
    # line's side can be split
    hot = stored(firsts.groupBy("h1", "h2").agg(*aggs).where(frequent), "frequent-lines")
    hit = rows.join(hot, ["h1", "h2"])
    if keep == "first":
        hit = hit.where(~F.struct("id", "th", "pos").eqNullSafe(F.col("first")))
    drops = (hit.groupBy("id", "th")
                .agg(F.max("n_lines").alias("n_lines"),
                     F.sort_array(F.collect_set("pos")).alias("pos")))
    ends = F.concat(F.array(F.lit(-1)), F.col("pos"), F.array(F.col("n_lines")))
    runs = let(ends, lambda e: F.transform(
        F.sequence(F.lit(1), F.size(e) - 1),
        lambda i: F.struct((F.get(e, i - 1) + 1).alias("start"),
                           (F.get(e, i) - F.get(e, i - 1) - 1).alias("len"))))
    return drops.select("id", "th", F.col("n_lines").cast("long").alias("n_lines"),
                        F.size("pos").cast("long").alias("n_dropped"),
                        F.filter(runs, lambda r: r["len"] > 0).alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", prefix: str = "_ld_") -> DataFrame:
    """The input rows with ``<prefix>n_lines``, ``<prefix>n_dropped`` and
    ``<prefix>kept`` (the kept lines joined by a line feed)."""
    b = bitmaps.select(F.col("id").alias(prefix + "id"), F.col("th").alias(prefix + "th"),
                       F.col("n_dropped").alias(prefix + "d"),
                       F.col("keep_runs").alias(prefix + "runs"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn(prefix + "h", row_hash(text))
    j = d.join(b, F.col(id_col).eqNullSafe(F.col(prefix + "id"))
               & (F.col(prefix + "h") == F.col(prefix + "th")), "left")
    kept = let(split_lines(F.col(text_col)), lambda lines: F.array_join(F.flatten(F.transform(
        F.col(prefix + "runs"), lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n"))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return (j.withColumn(prefix + "n_lines", n_lines.cast("long"))
             .withColumn(prefix + "n_dropped", F.coalesce(F.col(prefix + "d"), F.lit(0)).cast("long"))
             .withColumn(prefix + "kept", F.when(F.col(prefix + "runs").isNull(), text).otherwise(kept))
             .drop(*[prefix + c for c in ("h", "id", "th", "d", "runs")]))
