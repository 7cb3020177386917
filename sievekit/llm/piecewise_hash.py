"""Context-triggered piecewise hashes of documents and their likeness.

A rolling hash over 7 bytes cuts a text where it meets a condition that depends
on the block size, so an edit moves only the cuts near it. Every chunk gives
one of 64 symbols; the signature is kept at the block size and at twice that.
The block size is the largest (3, 6, 12, ...) that still gives ``LEAST`` cuts,
3 if none does. Two fingerprints are compared where their block sizes meet:
runs of one symbol are shortened to three, and if the signatures share
``COMMON`` consecutive symbols the likeness is one minus their edit distance
(insertions and deletions) over their joint length, else 0.

Equal texts have equal fingerprints, and equal fingerprints have likeness 1.
Null text is empty; the empty text has the fingerprint ``3::``. Whole texts are
hashed, whatever their length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import row_hash, stored

WINDOW = 7
LEAST = 32
COMMON = 4
SYMBOLS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def fingerprint(data: bytes) -> str:
    if not data:
        return "3::"
    b = np.frombuffer(data, np.uint8)
    roll = np.zeros(len(b), np.uint32)
    factor = 1
    for j in range(min(WINDOW, len(b))):         # wraps modulo 2**32
        roll[j:] += (b[:len(b) - j].astype(np.uint32) + np.uint32(1)) * np.uint32(factor)
        factor = factor * 0x01000193 & 0xFFFFFFFF
    roll ^= roll >> np.uint32(15)
    roll *= np.uint32(0x2C1B3C6D)
    roll ^= roll >> np.uint32(12)
    total = np.cumsum(roll, dtype=np.uint64)     # chunk hash: sum of its windows' hashes
    size, cuts = 3, np.flatnonzero(roll % np.uint32(3) == 2)
    while True:                                  # cuts of 2 * size are among those of size
        wider = cuts[roll[cuts] % np.uint32(2 * size) == 2 * size - 1]
        if len(wider) < LEAST:
            break
        size, cuts = 2 * size, wider
    return f"{size}:{_symbols(total, cuts)}:{_symbols(total, wider)}"


def _symbols(total: np.ndarray, cuts: np.ndarray) -> str:
    if not len(cuts) or cuts[-1] != len(total) - 1:
        cuts = np.append(cuts, len(total) - 1)
    sums = np.diff(total[cuts], prepend=np.uint64(0))
    return SYMBOLS[((sums * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.intp)].tobytes().decode()


def _shortened(sig: str) -> str:
    out = []
    for i, c in enumerate(sig):
        if i < 3 or not c == sig[i - 1] == sig[i - 2] == sig[i - 3]:
            out.append(c)
    return "".join(out)


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit per symbol of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    mask, v = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        u = v & places.get(c, 0)
        v = (v + u | v - u) & mask
    return len(a) - v.bit_count()


def _signature_likeness(a: str, b: str, common: int) -> float:
    a, b = _shortened(a), _shortened(b)
    n = min(common, len(a), len(b))
    if not n:
        return 0.0
    grams = {a[i:i + n] for i in range(len(a) - n + 1)}
    if not any(b[i:i + n] in grams for i in range(len(b) - n + 1)):
        return 0.0
    distance = len(a) + len(b) - 2 * _common_length(a, b)
    return 1.0 - distance / (len(a) + len(b))


def likeness(x: str, y: str, common: int = COMMON) -> float:
    """0 (nothing in common) to 1 (equal fingerprints)."""
    if x == y:
        return 1.0
    (sx, x1, x2), (sy, y1, y2) = x.split(":"), y.split(":")
    sx, sy = int(sx), int(sy)
    if not x1 or not y1:
        return 0.0
    if sx == sy:
        return max(_signature_likeness(x1, y1, common), _signature_likeness(x2, y2, common))
    if sx == 2 * sy:
        return _signature_likeness(x1, y2, common)
    if sy == 2 * sx:
        return _signature_likeness(x2, y1, common)
    return 0.0


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """The input rows with the text's fingerprint."""
    @F.pandas_udf("string")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t.encode()) for t in texts], dtype=object)

    return docs.withColumn(out_col, mark(F.coalesce(F.col(text_col), F.lit(""))))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the
    start of ``following``, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _result(text: str, mark: str, following: str, next_mark: str):
    import hashlib
    data = edited(text, following).encode()
    edited_mark = fingerprint(data)
    return (len(text), hashlib.sha256(data).hexdigest(), mark, edited_mark,
            likeness(mark, edited_mark), likeness(mark, next_mark))


def _columns(rows, kinds):
    return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its text edited with the next
    document in ascending id (the last is followed by the first), and their
    likenesses. Rows with equal ids follow each other in an order set by their
    texts; null ids come first.

    Texts are shuffled once, into id ranges; tasks stream them in order. Only
    the last row of every range lacks its successor: it and the range's first
    row are written with the results and joined by range number.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = (docs.select(F.col(id_col).alias("id"), text.alias("text"), row_hash(text).alias("th"))
               .repartitionByRange("id", "th").sortWithinPartitions("id", "th").select("id", "text"))
    id_type = src.schema["id"].dataType.simpleString()
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        first = before = None
        for batch in batches:
            ids, out_ids, rows = batch.column("id"), [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                mark = fingerprint(t.encode())
                if before is None:
                    first = (ids[i], t)
                else:
                    rows.append((*_result(before[1], before[2], t, mark), "", None, None))
                    out_ids.append(before[0])
                before = (ids[i], t, mark)
            if rows:
                yield _batch(ids.type, out_ids, rows, part)
        if before is not None:
            ends = [(len(first[1]), "", "", "", 0.0, 0.0, "first", first[1]),
                    (len(before[1]), "", "", "", 0.0, 0.0, "last", before[1])]
            yield _batch(first[0].type, [first[0], before[0]], ends, part)

    def _batch(id_kind, ids, rows, part):
        ids = pa.array([x.as_py() for x in ids], id_kind)
        cols = _columns([r[:8] for r in rows], [*kinds, pa.string(), pa.string()])
        return pa.RecordBatch.from_arrays(
            [ids, *cols, pa.array([part] * len(rows), pa.int32())],
            ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "role", "text", "part"])

    schema = RESULT.format(id=id_type)
    rows = stored(src.mapInArrow(run, schema + ", role string, text string, part int"), "neighbours")
    done = rows.where("role = ''").drop("role", "text", "part")
    ends = rows.where("role <> ''")
    parts = sorted(r.part for r in ends.where("role = 'first'").select("part").collect())  # one per task
    if not parts:
        return done.withColumnRenamed("id", id_col)
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    last = ends.where("role = 'last'").select("part", "id", "text").join(F.broadcast(follows), "part")
    heads = ends.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))

    def finish(batches):
        for batch in batches:
            out = []
            for t, f in zip(batch.column("text").to_pylist(), batch.column("following").to_pylist()):
                out.append(_result(t, fingerprint(t.encode()), f, fingerprint(f.encode())))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *_columns(out, kinds)],
                                             ["id", "n_chars", "edited_sha256", "fingerprint",
                                              "edited_fingerprint", "near_edited", "near_next"])

    tail = last.join(heads, "next_part").select("id", "text", "following").mapInArrow(finish, schema)
    return done.unionByName(tail).withColumnRenamed("id", id_col)
