r"""Benchmark decontamination by winnowed fingerprints.

A word sequence's k-gram hashes are winnowed: every window of ``w``
consecutive hashes keeps its minimum (all of them on ties), k + w - 1 = ``span``
words. Two sequences that share a span of that length hold the same window of
hashes, hence share a kept fingerprint at the same place inside it, so the join
of training and test fingerprints misses no shared span. A joined pair carries
the ``span`` - k words on either side; it is extended word by word and is a hit
if the equal run reaches ``span`` words. Items shorter than ``span`` words are
matched as a whole (k = their length, w = 1).

All of it is array expressions and joins; which side of the fingerprint join is
broadcast is Spark's choice by size (the test fingerprints are written first,
so their size is known).

Null or empty texts have no words and no hits; an item without words is never
found. Rows that repeat id and text get the same counts. Items with a null id
can hit words but are not listed. Equal items are matched once and listed each.
An empty benchmark leaves every document clean; an empty corpus gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import ascii_lower, row_hash, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Maximal runs of digits, a-z and non-ASCII characters after A-Z are
    lower-cased. (Splitting at the rest costs a tenth of extracting the runs.)"""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def word_count(text: Column) -> Column:
    """Number of words, without the lower-casing."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_WORD_ANY_CASE), "")).cast("long")


def _with_grams(seqs: DataFrame, k: int, span: int) -> DataFrame:
    """Adds ``grams``, the hashes of all k consecutive ``hashes``; null where
    there are fewer than ``span``. Runs double in length step by step, since
    zipping two arrays is much cheaper than indexing one inside a lambda. Each
    step is a projection that refers to the one before twice, so it is not
    inlined, and no filter is put between them: it would be pushed below."""
    def glue(a: str, b: str, after: int) -> Column:
        return F.zip_with(a, F.slice(b, after + 1, F.greatest(F.size(b), F.lit(1))),
                          lambda x, y: F.xxhash64(x, y))
    df, have, doubled, length = seqs, None, "hashes", 1
    at = 0
    while length <= k:
        if k & length:
            if have is None:
                have, at = doubled, length
            else:
                df = df.withColumn(f"run{at + length}", glue(have, doubled, at))
                have, at = f"run{at + length}", at + length
        if 2 * length <= k:
            df = df.withColumn(f"pow{2 * length}", glue(doubled, doubled, length))
            doubled = f"pow{2 * length}"
        length *= 2
    return df.withColumn("grams", F.when(
        F.size("hashes") >= span, F.slice(have, 1, F.greatest(F.size("hashes") - (k - 1), F.lit(0)))))


def fingerprints(seqs: DataFrame, k: int, span: int) -> DataFrame:
    """Winnowed fingerprints of the column ``hashes`` (word hashes): the other
    columns plus ``pos``, ``fp``, ``left`` (context words before pos) and
    ``ctx`` (word hashes from pos - left on)."""
    w, side = span - k + 1, span - k
    keep = [c for c in seqs.columns if c != "hashes"]
    # the outer form: the plain one infers a filter that repeats all of the above
    rows = (_with_grams(seqs, k, span)
            .select(*keep, "hashes", "grams", F.posexplode_outer("grams").alias("pos", "fp"))
            .where(F.col("pos").isNotNull()))

    def at_least(step: int) -> Column:
        """How many neighbours on one side are no smaller, w - 1 at most. A hash
        is some window's minimum iff both sides together have w - 1 of them."""
        out = F.lit(w - 1)
        for j in range(w - 1, 0, -1):
            ok = F.coalesce(F.get(F.col("grams"), F.col("pos") + step * j) >= F.col("fp"), F.lit(False))
            out = F.when(~ok, j - 1).otherwise(out)
        return out

    if w > 1:
        rows = rows.where(at_least(-1) + at_least(1) >= w - 1)
    left = F.least(F.col("pos"), F.lit(side))
    return rows.select(*keep, "pos", "fp", left.alias("left"),
                       F.slice("hashes", F.col("pos") - left + 1, left + k + side).alias("ctx"))


def _equal_run(offset, most: int) -> Column:
    """How many words agree in the two contexts, at ``offset(0)``,
    ``offset(1)``, ..., ``most`` at most. A fold: unrolled, it would make the
    join's generated method too large to be compiled."""
    def step(run: Column, j: Column) -> Column:
        same = (F.get(F.col("ctx"), F.col("left") + offset(j))
                == F.get(F.col("i_ctx"), F.col("i_left") + offset(j)))
        return F.when((run == j) & F.coalesce(same, F.lit(False)), run + 1).otherwise(run)
    return F.aggregate(F.sequence(F.lit(0), F.lit(most - 1)), F.lit(0), step) if most else F.lit(0)


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_text: str = "text", span: int = 10, k: int = 4) -> DataFrame:
    """Matching spans: ``id``, ``th``, ``item_class`` (md5 of the item's words),
    ``start``, ``end`` (word positions, inclusive)."""
    hashes = F.transform(F.col("w"), lambda x: F.xxhash64(x))
    seqs = (items.select(words(F.col(item_text)).alias("w"))
                 .select(F.md5(F.array_join("w", " ")).alias("item_class"), hashes.alias("hashes"))
                 .dropDuplicates(["item_class"]))
    seqs = stored(seqs, "items")
    short = [r.n for r in seqs.select(F.size("hashes").alias("n")).where(F.col("n").between(1, span - 1))
             .distinct().collect()]     # at most span - 1 values
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = (docs.select(F.col(id_col).alias("id"), row_hash(text).alias("th"),
                     words(F.col(text_col)).alias("w"))
             .select("id", "th", hashes.alias("hashes")))
    found = None
    for n in [span, *sorted(short)]:
        kk = k if n == span else n
        own = seqs if n == span else seqs.where(F.size("hashes") == n)
        fp_i = stored(fingerprints(own, kk, n), "item-fingerprints").select(
            "item_class", "fp", F.col("left").alias("i_left"), F.col("ctx").alias("i_ctx"))
        # most fingerprints are in no item: the bare hashes sort them out before
        # any context is compared
        known = stored(fp_i.select("fp").distinct(), "item-hashes")
        pairs = fingerprints(d, kk, n).join(known, "fp", "left_semi").join(fp_i, "fp")
        side = n - kk
        ext = (pairs.withColumn("l", _equal_run(lambda j: -1 - j, side))
                    .withColumn("r", _equal_run(lambda j: kk + j, side))
                    .where(F.col("l") + F.col("r") >= side)
                    .select("id", "th", "item_class", (F.col("pos") - F.col("l")).alias("start"),
                            (F.col("pos") + kk - 1 + F.col("r")).alias("end")))
        found = ext if found is None else found.unionByName(ext)
    return found


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  span: int = 10, k: int = 4) -> DataFrame:
    """Per contaminated document: ``id``, ``th``, ``n_hit`` (words inside any
    occurrence of a window), ``n_items`` and ``items_sha256`` of the ids of the
    items found, sorted as strings and joined by commas."""
    h = stored(hits(docs, items, id_col, text_col, item_text, span, k).distinct(), "hits")
    before = (Window.partitionBy("id", "th").orderBy("start", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    spans = h.select("id", "th", "start", "end").distinct()
    covered = (spans.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(-1)))
                    .withColumn("new", F.greatest(F.lit(0), F.col("end")
                                                  - F.greatest(F.col("done"), F.col("start") - 1)))
                    .groupBy("id", "th").agg(F.sum("new").cast("long").alias("n_hit")))
    sets = (h.groupBy("id", "th").agg(F.sort_array(F.collect_set("item_class")).alias("classes"))
             .withColumn("set_key", F.md5(F.array_join("classes", ","))))
    # ids are listed once for each distinct set of items, not for each document
    members = items.select(F.md5(F.array_join(words(F.col(item_text)), " ")).alias("item_class"),
                           F.col(item_id).cast("string").alias("item"))
    lists = (sets.select("set_key", "classes").dropDuplicates(["set_key"])
                 .select("set_key", F.explode("classes").alias("item_class"))
                 .join(members, "item_class")
                 .groupBy("set_key").agg(F.sort_array(F.collect_set("item")).alias("ids"))
                 .select("set_key", F.size("ids").cast("long").alias("n_items"),
                         F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")))
    return (covered.join(sets.select("id", "th", "set_key"),
                         covered["id"].eqNullSafe(sets["id"]) & (covered["th"] == sets["th"]))
                   .select(covered["id"], covered["th"], "n_hit", "set_key")
                   .join(lists, "set_key").drop("set_key"))
