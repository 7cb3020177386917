import hashlib
import random
import re

import pytest

from sievekit.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, span=10):
    out = {}
    for i, t in rows:
        w = words(t)
        hit, ids = set(), set()
        for item, it in items:
            iw = words(it)
            if not iw:
                continue
            n = min(len(iw), span)
            grams = {tuple(iw[p:p + n]) for p in range(len(iw) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in grams:
                    hit.update(range(p, p + n))
                    if item is not None:
                        ids.add(str(item))
        if hit:
            out[i, t] = (len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
    return out


def run(spark, df, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    from pyspark.sql import functions as F
    got = D.contamination(df, bench).alias("g")
    keyed = df.withColumn("rh", F.xxhash64(F.coalesce("text", F.lit("")))).alias("d")
    j = keyed.join(got, F.col("d.doc_id").eqNullSafe(F.col("g.id")) & (F.col("d.rh") == F.col("g.th")))
    return {(r.doc_id, r.text): (r.n_hit, r.n_items, r.items_sha256) for r in j.collect()}


def test_odd_rows(spark, make, odd_rows):
    items = [(1, "quick brown fox jumps over the lazy dog near the"), (10, "the LAZY dog"), (2, None), (3, ""),
             (4, "two words"), (5, "two  words!"), (None, "one"), (6, "fox jumps over the lazy dog near the old river"),
             (7, "line 19999 of a very long text with word459 and more")]
    assert run(spark, make(odd_rows), items) == brute(odd_rows, items)


@pytest.mark.parametrize("seed", range(2))
def test_few_words_many_ties(spark, make, seed):
    """Two or three different words give equal hashes inside windows."""
    rng = random.Random(seed)
    text = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60), "ab" if i % 3 else "abc")) for i in range(60)]
    items = [(i, text(rng.choice([3, 9, 10, 11, 14, 25]), "abc")) for i in range(25)]
    assert run(spark, make(rows), items) == brute(rows, items)


def test_empty_tables(spark, make):
    assert run(spark, make([]), [(1, "a b c")]) == {}
    assert run(spark, make([(1, "a b c")]), []) == {}


def test_every_long_enough_span_shares_a_fingerprint(spark):
    rng = random.Random(5)
    from pyspark.sql import functions as F
    a = [rng.getrandbits(60) for _ in range(300)]
    rows = [(i, a[i:i + 10]) for i in range(0, 290, 7)] + [(-1, a)]
    df = spark.createDataFrame(rows, "k long, hashes array<long>")
    got = D.fingerprints(df, 4, 10)
    own = {r.fp for r in got.where("k = -1").collect()}
    assert {r.k for r in got.where(F.col("fp").isin(list(own))).collect()} >= {k for k, _ in rows}
    assert len(own) < 120       # a third of the 297 hashes, not all
