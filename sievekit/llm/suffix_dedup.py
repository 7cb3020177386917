"""Removal of long repeated byte strings by a distributed difference-cover method.

A byte goes if some ``length``-byte string that covers it also starts anywhere
else, in another document or its own. Suffixes need be told apart only in their
first ``length`` bytes, so names (64-bit hashes of whole strings) stand for
ranks, and a name found once is never looked at again.

1. *Symbols.* The text is read as phrases between anchors: an anchor is a
   position whose 8-byte hash is the last smallest of some ``REACH``
   consecutive ones, so equal text has equal anchors and every ``REACH``
   positions hold one.
2. *Sorted sample.* Of the phrases those with a number in a difference cover
   modulo 7 are sampled; two repeats, however their phrases are numbered, share
   a sampled one among any seven. Each sampled suffix is named by its first
   triple of phrases. Names that occur once are dropped.
3. *Recursion on names.* At anchors with surviving triples all along, the
   suffix is named again, by the ``length - REACH + 1`` bytes that every string
   through the anchor holds (its core) and by all bytes that any of them holds
   (its hull). A core that occurs once ends the search; a hull that occurs twice
   settles every string through the anchor.
4. *Remaining suffixes.* A string starting between anchors belongs to the first
   anchor that is the minimum of its own beginning. Strings whose core repeats
   but whose hull doesn't are the ends of repeats; only these, and one
   representative of each repeated hull with the same core, are named one by
   one, by two 64-bit hashes of all their bytes, and equal neighbours compared.

Equality is decided by 128 bits. Everything is counted by aggregation before
the shuffle, so a passage found in a third of all documents makes no hot task; the counts are
joined back, which Spark splits where a key is hot. Texts are read by whole
pieces of at most ``PIECE`` bytes with overlap, so long ones need no more memory.

Null text is empty; a text shorter than ``length`` loses nothing. Equal texts,
also under one id, are repeats of each other. A document is known by the 64-bit
hash of its text while its positions are shuffled. An empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import in_sketch, key_sketch, row_hash, stored

LENGTH = 400
GRAM = 8
REACH = 32      # a power of two
#: difference cover modulo 7: every residue is a difference of two of them
COVER, MODULUS = (1, 2, 4), 7
PIECE = 1 << 18
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15


class Segment(NamedTuple):
    """Part of a document in a chunk: its bytes lie at ``at``, the first of them is byte ``base`` of the document,
    and positions ``own`` to ``until`` (of the document) are this segment's."""

    doc: int
    at: int
    base: int
    size: int
    total: int
    own: int
    until: int


def chunks(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[Segment]]]:
    """Documents of at least ``length`` bytes, joined into chunks of about ``PIECE`` bytes; longer ones in overlapping pieces."""
    parts, segments, at = [], [], 0
    for doc, text in enumerate(texts):
        for own in range(0, len(text) if len(text) >= length else 0, PIECE):
            base, until = max(0, own - 2 * REACH), min(own + PIECE, len(text))
            part = text[base:until + length + 4 * REACH]
            if parts and at + len(part) > 2 * PIECE:
                yield b"".join(parts), segments
                parts, segments, at = [], [], 0
            segments.append(Segment(doc, at, base, len(part), len(text), own, until))
            parts.append(part)
            at += len(part)
    if parts:
        yield b"".join(parts), segments


class Names:
    """Hashes of the strings of a chunk: prefix sums of hashed 8-byte grams, two of them."""

    def __init__(self, data: bytes):
        grams = np.array(np.ndarray(len(data) - GRAM + 1, "<u8", data, strides=(1,)))
        h = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        self.gram_hash = h ^ (h >> np.uint64(29))
        second = (self.gram_hash ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xFF51AFD7ED558CCD)
        n = len(grams) + 1
        power = np.full(n, _BASE, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        self.inverse = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        self.inverse[0] = 1
        self.inverse = np.cumprod(self.inverse)
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * power[:-1])])
                     for x in (self.gram_hash, second ^ (second >> np.uint64(31)))]

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Names of the strings from ``start`` to before ``end`` (at least 8 bytes)."""
        sums = self.sums[which]
        return (sums[end - GRAM + 1] - sums[start]) * self.inverse[start]

    def anchors(self, segments: list[Segment], last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors, the first and the last start whose anchor they are. Starts
        are all that have ``last`` more bytes in their document."""
        key = (self.gram_hash & ~_LOW) | (_LOW - np.arange(len(self.gram_hash), dtype=np.uint64))
        step = 1
        while step < REACH:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        valid = np.zeros(len(key), bool)
        for s in segments:
            valid[s.at:max(s.at, s.at + min(s.size, s.total - s.base) - last + 1)] = True
        starts = np.flatnonzero(valid)
        at = (_LOW - (key[starts] & _LOW)).astype(np.int64)
        new = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        end = np.r_[first[1:], len(at)][:len(first)] - 1
        return at[first], starts[first], starts[end]


def _located(segments: list[Segment], at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each position, its place in the document, and whether the segment owns it."""
    which = np.searchsorted([s.at for s in segments], at, "right") - 1
    place = at + np.array([s.base - s.at for s in segments], np.int64)[which]
    own = (place >= np.array([s.own for s in segments])[which]) & (place < np.array([s.until for s in segments])[which])
    return which, place, own


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _map(df: DataFrame, schema: str, make, length: int) -> DataFrame:
    """``make(batch, data, segments, state)`` -> (documents' numbers, columns)
    for every chunk of every batch of ``df`` (``th``, ``b``, ...)."""
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches):
        for batch in batches:
            state = {}
            for data, segments in chunks(batch.column("b").to_pylist(), length):
                doc, columns = make(batch, data, segments, state)
                yield pa.RecordBatch.from_arrays([batch.column("th").take(pa.array(doc)), *columns], names)

    return df.mapInArrow(run, schema)


def sampled_triples(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``th``, ``q``, ``name`` of every sampled suffix: its place and its first three phrases."""
    cover = np.zeros(MODULUS, bool)
    cover[list(COVER)] = True

    def make(batch, data, segments, state):
        names = Names(data)
        at, _, _ = names.anchors(segments, GRAM + REACH - 1)
        which, place, own = _located(segments, at)
        mine = place >= np.array([s.own for s in segments])[which]
        at, which, place, own = at[mine], which[mine], place[mine], own[mine]
        begin = np.searchsorted(which, np.arange(len(segments)))
        count = np.bincount(which[own], minlength=len(segments))
        number = np.arange(len(at)) - begin[which]
        for i, s in enumerate(segments):        # phrases are numbered through the pieces of a long document
            before = state.get(s.doc, 0)
            state[s.doc] = before + int(count[i])
            if before:
                number[which == i] += before
        t = np.flatnonzero(own[:-3] & cover[number[:-3] % MODULUS] & (which[3:] == which[:-3])) if len(at) > 3 else np.zeros(0, int)
        name = names.of(at[t], at[t + 3] + GRAM, 0)
        return np.array([segments[i].doc for i in which[t]], np.int64), [pa.array(place[t].astype(np.int32)), _long(name)]

    return _map(docs, "th long, q int, name long", make, length)


def _flat(lists: pa.ListArray, segments: list[Segment]) -> Iterator[tuple[Segment, np.ndarray]]:
    """The segments with their document's list."""
    offsets, values = lists.offsets.to_numpy(), lists.values
    for s in segments:
        yield s, values.slice(offsets[s.doc], offsets[s.doc + 1] - offsets[s.doc])


def self_similar(names: Names, segments: list[Segment], survivors: pa.ListArray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether a string through each anchor can repeat. Whatever its start, the
    phrases between ``REACH`` bytes behind the anchor and ``REACH`` before the
    least end of the string are those of its repeat too; so among any seven of
    them one sampled triple survives."""
    phrases, _, _ = names.anchors(segments, GRAM + REACH - 1)
    alive = np.concatenate([q[(q >= s.base) & (q < s.base + s.size)] + (s.at - s.base) for s, q in (
        (s, v.to_numpy().astype(np.int64)) for s, v in _flat(survivors, segments))])
    known = np.flatnonzero(np.isin(phrases, alive))
    number = np.arange(len(phrases))
    after = np.r_[known, 1 << 60][np.searchsorted(known, number)]
    lonely = np.r_[0, np.cumsum(after - number >= MODULUS)]
    first = np.searchsorted(phrases, at + REACH - 1)
    last = np.searchsorted(phrases, at + length - 2 * REACH - GRAM + 2, "right") - 3 - MODULUS
    return lonely[np.maximum(last + 1, first)] == lonely[first]


def cores_and_hulls(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with a list ``q`` of surviving samples and a ``weight``: per anchor
    that can be in a repeat its place ``p``, its strings' first and last start
    ``lo``, ``hi``, ``core``, ``hull`` and the weight."""
    def make(batch, data, segments, state):
        names = Names(data)
        at, lo, hi = names.anchors(segments, length)
        which, place, own = _located(segments, at)
        end = np.array([s.at + s.size for s in segments], np.int64)
        keep = own & self_similar(names, segments, batch.column("q"), at, length)
        at, lo, hi, which, place = at[keep], lo[keep], hi[keep], which[keep], place[keep]
        begin = np.array([s.at for s in segments], np.int64)
        left, right = np.maximum(at - REACH + 1, begin[which]), np.minimum(at + length, end[which])
        core = names.of(at, at + length - REACH + 1, 0)
        clip = ((at - left) * 4096 + (right - at)).astype(np.uint64)
        hull = names.of(left, right, 1) ^ (clip * np.uint64(0xC2B2AE3D27D4EB4F))
        shift = place - at
        return np.array([segments[i].doc for i in which], np.int64), [
            *(pa.array((x + y).astype(np.int32)) for x, y in ((place, 0), (lo, shift), (hi, shift))), _long(core), _long(hull),
            batch.column("weight").take(pa.array([segments[i].doc for i in which], pa.int64()))]

    return _map(docs, "th long, p int, lo int, hi int, core long, hull long, weight int", make, length)


def single_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with a list ``a`` of ranges of starts (``lo``, ``hi``, ``weight``): ``start``, names ``k1``, ``k2``
    and ``weight`` of each string in them."""
    def make(batch, data, segments, state):
        names, out = Names(data), []
        for i, (s, v) in enumerate(_flat(batch.column("a"), segments)):
            lo, hi, weight = (v.field(n).to_numpy().astype(np.int64) for n in ("lo", "hi", "weight"))
            hi = np.minimum(hi, s.total - length)
            n = np.maximum(hi - lo + 1, 0)
            first = np.cumsum(n) - n
            start = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(lo, n)
            code = np.unique(start * 4 + np.repeat(weight, n))
            start, weight = code >> 2, code & 3
            mine = (start >= s.own) & (start < s.until)
            out.append((np.full(mine.sum(), s.doc), start[mine], start[mine] - s.base + s.at, weight[mine]))
        doc, start, at, weight = (np.concatenate(x) for x in zip(*out))
        return doc, [pa.array(start.astype(np.int32)), _long(names.of(at, at + length, 0)), _long(names.of(at, at + length, 1)),
                     pa.array(weight.astype(np.int32))]

    return _map(docs, "th long, start int, k1 long, k2 long, weight int", make, length)


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (``id``, ``th``, ``b``): per ``th`` the list ``ranges`` of first
    and last starts (``lo``, ``hi``) of strings that repeat. Equal texts repeat
    whole; one of them stands for all, with weight two. Tables that a hot key
    meets are stored first, so that Spark can split it."""
    copies = stored(docs.select("id", "th", F.octet_length("b").alias("size")).where(F.col("size") >= length).groupBy("th").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("size").alias("size")).where("n > 1"), "copies")
    sample = stored(sampled_triples(docs, length), "triples")
    twice = stored(sample.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "twice")
    sample = in_sketch(sample, "name", stored(key_sketch(twice, "name"), "sketch"))
    found = stored(sample.join(twice, "name").groupBy("th").agg(F.collect_set("q").alias("q"))
                         .join(copies.select("th", "n", "least"), "th", "left")
                         .select("th", "q", "least", F.when(F.col("n") > 1, 2).otherwise(1).alias("weight")), "found")

    one = in_sketch(docs, "th", stored(key_sketch(found, "th"), "sketch")).join(found, "th").where("weight = 1 OR id <=> least").drop("id", "least")
    named = stored(cores_and_hulls(one, length), "cores")
    hulls = stored(named.groupBy("core", "hull").agg(F.sum("weight").alias("n"), F.min(F.struct("th", "p", "lo", "hi")).alias("at")),
                   "hulls")
    cores = stored(hulls.groupBy("core").agg(F.sum("n").alias("total"), F.max((F.col("n") == 1).cast("int")).alias("loose"))
                        .where("total > 1 AND loose = 1").select("core"), "mixed")
    ends = hulls.join(cores, "core").select("at.th", F.when(F.col("n") == 1, F.struct(
        "at.lo", "at.hi", F.lit(1).alias("weight"))).otherwise(F.struct(
            F.greatest(F.col("at.p") - REACH + 1, F.lit(0)).alias("lo"), F.col("at.p").alias("hi"), F.lit(2).alias("weight"))).alias("a"))
    ends = stored(ends.groupBy("th").agg(F.collect_set("a").alias("a")), "ends")

    some = in_sketch(docs, "th", stored(key_sketch(ends, "th"), "sketch"))
    single = stored(single_strings(some.join(ends, "th"), length), "strings")
    again = stored(single.groupBy("k1", "k2").agg(F.sum("weight").alias("n"), F.min("weight").alias("least"))
                         .where("n > 1 AND least = 1").select("k1", "k2"), "again")
    edges = single.where("weight = 1").join(again, ["k1", "k2"]).select(
        "th", F.struct(F.col("start").alias("lo"), F.col("start").alias("hi")).alias("range"))
    whole = named.where("weight = 1").join(hulls.where("n > 1").select("core", "hull"), ["core", "hull"]).select(
        "th", F.struct("lo", "hi").alias("range"))
    equal = copies.select("th", F.struct(F.lit(0).alias("lo"), (F.col("size") - length).alias("hi")).alias("range"))
    return whole.unionByName(edges).unionByName(equal).groupBy("th").agg(F.collect_set("range").alias("ranges"))


def removed_spans(lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings whose starts lie in the ranges."""
    order = np.argsort(lo, kind="stable")
    if not len(order):
        return order, order
    begin, end = lo[order], np.maximum.accumulate(hi[order] + length)
    new = np.r_[True, begin[1:] > end[:-1]]
    return begin[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``
    and the bytes that stay, ``kept``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), row_hash(text).alias("th"), F.encode(text, "utf-8").alias("b"))
    ranges = stored(repeated_ranges(keyed, length), "ranges")
    id_type = keyed.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists, out = batch.column("ranges"), []
            offsets, lo, hi = lists.offsets.to_numpy(), *(lists.values.field(n).to_numpy().astype(np.int64) for n in ("lo", "hi"))
            for i, text in enumerate(batch.column("b").to_pylist()):
                begin, end = removed_spans(lo[offsets[i]:offsets[i + 1]], hi[offsets[i]:offsets[i + 1]], length)
                kept = b"".join(text[x:y] for x, y in zip([0, *end.tolist()], [*begin.tolist(), len(text)]))
                out.append((len(text), len(text) - len(kept), len(begin), kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([r[j] for r in out], t) for j, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    sketch = stored(key_sketch(ranges, "th"), "sketch")
    cut = (in_sketch(keyed, "th", sketch).join(ranges, "th", "left")
           .select("id", "b", F.coalesce("ranges", F.array().cast(ranges.schema["ranges"].dataType)).alias("ranges"))
           .mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary"))
    zero = F.lit(0).cast("long")
    same = in_sketch(keyed, "th", sketch, "left_anti").select(
        "id", F.octet_length("b").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("b").alias("kept"))
    return same.unionByName(cut).withColumnRenamed("id", id_col)
