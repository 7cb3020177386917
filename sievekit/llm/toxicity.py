"""Toxicity scores by non-negative positive-unlabelled learning.

Only confirmed toxic documents and documents of unknown kind are used. A
document is the set of its words and word beginnings, hashed to ``1 <<
HASH_BITS`` features. A feature's scale is its squared log-ratio between
confirmed toxic documents and the corpus (document frequencies over all
training documents on both sides), zero where it doesn't speak for toxicity. The linear
classifier minimises the class-prior-corrected risk

    prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)])

with the sigmoid loss; where the second part turns negative its gradient is
ascended instead, which keeps the estimate from going below zero. The prior is
the share of toxic rows among the labels learnt from.

The classifier is fitted in numpy on at most ``MAX_POSITIVE`` confirmed and
``MAX_UNLABELLED`` other documents (the lowest hashes of id and text, so any
cluster draws the same ones; a full repeat counts once); the prior and both
sides' document frequencies cover all training rows. Scoring reads whole texts
and nothing but the text. Ids, text hashes and feature counts are shuffled;
texts only where more than ``BROADCAST_IDS`` documents are confirmed.

Null and empty texts have no features and get the score of the intercept.
Without a confirmed toxic document everything scores 0. Labels with a null id
or value are ignored; a document with contradicting labels counts as confirmed.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import row_hash, stored

HASH_BITS = 18
MAX_POSITIVE = 4000
MAX_UNLABELLED = 8000
BROADCAST_IDS = 200_000         # confirmed ids up to here go to the texts, more are joined by a shuffle
#: digits and letters; A-Z become a-z, other ASCII becomes space, the rest stays
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32
                for b in range(256))


def features(raw: bytes | None, bits: int = HASH_BITS) -> np.ndarray:
    """Hashed words and word beginnings of a text, each once, ascending."""
    words = set((raw or b"").translate(LETTERS).split())
    mask, crc = (1 << bits) - 1, zlib.crc32
    found = {crc(w) & mask for w in words}
    found |= {crc(w + b"*") & mask for w in {w[:4] for w in words if len(w) > 4}}
    return np.array(sorted(found), np.int64)


def feature_scales(positive: np.ndarray, n_positive: int, corpus: np.ndarray, n_corpus: int) -> np.ndarray:
    """Squared positive log-ratio of document frequencies; rare features get 0."""
    ratio = np.log((positive + 1) / (n_positive + 10)) - np.log((corpus + 3) / (n_corpus + 30))
    return np.where(positive >= 2, np.clip(ratio, 0, None) ** 2, 0.0)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _scores(rows: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weights[x].sum() for x in rows]) + bias


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, scales: np.ndarray,
             epochs: int = 10, batch: int = 128, rate: float = 0.1, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights (scales included) and intercept; AdaGrad over mini-batches that
    hold the same share of both samples."""
    w, bias = np.zeros(len(scales)), 0.0
    w_sq, bias_sq = np.full(len(scales), 1e-2), 1e-2
    rng = np.random.default_rng(seed)
    batches = max(1, len(positive) // batch)
    for _ in range(epochs):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for b in range(batches):
            p = [positive[i] for i in p_order[b::batches]]
            u = [unlabelled[i] for i in u_order[b::batches]]
            if not p or not u:
                continue
            scaled = w * scales
            zp, zu = _sigmoid(_scores(p, scaled, bias)), _sigmoid(_scores(u, scaled, bias))
            slope_p, slope_u = zp * (1 - zp), zu * (1 - zu)     # of the loss on the negative side
            if zu.mean() - prior * zp.mean() >= 0:
                dp, du = -2 * prior * slope_p / len(p), slope_u / len(u)
            else:
                dp, du = prior * slope_p / len(p), -slope_u / len(u)
            grad = np.zeros(len(scales))
            for rows, d in ((p, dp), (u, du)):
                sizes = [len(x) for x in rows]
                grad += np.bincount(np.concatenate(rows), np.repeat(d, sizes), len(scales))
            grad *= scales
            d_bias = dp.sum() + du.sum()
            w_sq += grad ** 2
            bias_sq += d_bias ** 2
            w -= rate * grad / np.sqrt(w_sq)
            bias -= rate * d_bias / np.sqrt(bias_sq)
    return w * scales, bias


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id's text is a
    multiple of 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _feature_rows(docs: DataFrame, bits: int) -> DataFrame:
    """``group`` and the hashed ``features`` of every ``no``, repeats once."""
    def run(batches):
        seen = set()
        for batch in batches:
            new = [i for i, no in enumerate(batch.column("no").to_pylist()) if not (no in seen or seen.add(no))]
            batch = batch.take(pa.array(new, pa.int64()))
            rows = [features(b, bits) for b in batch.column("b").to_pylist()]
            sizes = np.cumsum([0, *map(len, rows)])
            flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("no"), batch.column("group"), lists],
                                             ["no", "group", "features"])
    return (docs.mapInArrow(run, "no long, group int, features array<int>")
                .dropDuplicates(["no"]).orderBy("no").select("group", "features"))


def _document_frequencies(docs: DataFrame, bits: int) -> tuple[int, np.ndarray]:
    """Number of rows and, per feature, of rows that have it; every task adds
    up its own rows first."""
    def run(batches):
        total, n = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for b in batch.column("b").to_pylist():
                total[features(b, bits)] += 1
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n, total[at]], pa.int64())], ["f", "n"])

    rows = docs.mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n"))
    got = rows.toArrow()                      # at most 1 + 2**bits rows
    f, count = got.column("f").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(1 << bits, np.int64)
    out[f[f >= 0]] = count[f >= 0]
    return int(count[f < 0].sum()), out


def _lowest(rows: DataFrame, n: int, most: int) -> DataFrame:
    """The ``most`` rows with the lowest hashes of id and text out of ``n``
    different ones. Hashes are uniform, so only rows below a share somewhat above
    ``most`` / ``n`` are sorted, however many there are."""
    rank = F.xxhash64("id", "th")
    share = 1.2 * (most + 100) / max(1, n)
    if share < 1:
        rows = rows.where(rank < F.lit(int(share * 2 ** 64) - 2 ** 63))
    return rows.orderBy(rank, "id", "th").limit(most)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", bits: int = HASH_BITS, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED) -> tuple[np.ndarray, float] | None:
    """Weights and intercept, or None if no document is confirmed toxic."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
                   .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id"))))
    n_labels, n_toxic = known.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n_toxic:
        return None
    prior = min(0.95, n_toxic / n_labels)
    confirmed = stored(known.where("y = 1").select("id").distinct(), "confirmed-ids")
    raw = F.col(text_col)
    text = docs.select(F.col(id_col).alias("id"), row_hash(F.coalesce(raw, F.lit(""))).alias("th"),
                       F.encode(raw, "utf-8").alias("b")).where(~held_out(F.col("id")))
    n_corpus, corpus = _document_frequencies(text.select("b"), bits)
    if not n_corpus:
        return None
    few = confirmed.count() <= BROADCAST_IDS
    toxic = text.join(F.broadcast(confirmed) if few else confirmed, "id", "left_semi")
    n_positive, counts = _document_frequencies(toxic.select("b"), bits)
    if not n_positive:
        return None
    different = stored(text.where("id is not null").select("id", "th").distinct()
                       .join(confirmed.withColumn("y", F.lit(1)), "id", "left"), "document-ids")
    n_all, n_known = different.agg(F.count(F.lit(1)), F.count("y")).first()
    # at most max_positive + max_unlabelled rows
    drawn = (_lowest(different.where("y = 1").select("id", "th"), n_known, max_positive).withColumn("group", F.lit(1))
             .unionByName(_lowest(different.select("id", "th"), n_all, max_unlabelled).withColumn("group", F.lit(0))))
    chosen = stored(drawn.withColumn("no", F.monotonically_increasing_id()), "sample-ids")
    sample = text.join(F.broadcast(chosen), ["id", "th"]).select("no", "group", "b")
    got = _feature_rows(sample, bits).toArrow()
    group, positive, unlabelled = got.column("group").to_numpy(), [], []
    at = 0
    for chunk in got.column("features").chunks:      # rows are views, nothing is copied
        flat, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        for a, b in zip(ends, ends[1:]):
            (positive if group[at] == 1 else unlabelled).append(flat[a:b])
            at += 1
    if not positive or not unlabelled:
        return None
    scales = feature_scales(counts, n_positive, corpus, n_corpus)
    return fit_nnpu(positive, unlabelled, prior, scales)


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None, text_col: str = "text",
          out_col: str = "score", bits: int = HASH_BITS) -> DataFrame:
    """The input rows with ``out_col``, 0 to 1."""
    if model is None:
        return docs.withColumn(out_col, F.lit(0.0))
    weights, bias = model[0].astype(np.float32), float(model[1])
    names = [f"c{i}" for i in range(len(docs.columns))]
    src = docs.toDF(*names).withColumn("b", F.encode(F.col(names[docs.columns.index(text_col)]), "utf-8"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            z = np.array([weights[features(b, bits)].sum(dtype=np.float64)
                          for b in batch.column("b").to_pylist()]) + bias
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(_sigmoid(z), pa.float64())], [*names, "z"])

    out = src.mapInArrow(run, schema + ", z double")
    return out.select(*[F.col(a).alias(b) for a, b in zip(names, docs.columns) if b != out_col],
                      F.col("z").alias(out_col))
