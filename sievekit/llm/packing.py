"""Packing of tokenised documents into windows by multiway differencing.

Documents become token ids (with an end token). Whole windows are cut off
first; what remains of a document is cut into near-equal pieces of at most
``max_piece`` tokens. Pieces are dealt into blocks of about ``block_windows``
windows by a hash of the piece's number, so no source, size or repeated
document makes a block large. In a block the Karmarkar-Karp multiway method
starts from one partial partition per piece and keeps merging the two with the
largest imbalances, the largest window of one with the smallest of the other;
the windows come out nearly equal. If one exceeds the capacity the block gets
one window more and is partitioned again.

Ids never leave the task that made them: what is shuffled is (document, start,
length, checksum). Null text is empty and has the end token alone. Every input
row is packed, repeats included. ``sequence_id`` is unique, not consecutive.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import sys
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import stored

CAPACITY = 2048
MAX_PIECE = 1024
LEAST_PIECE = 64
BLOCK_WINDOWS = 128
#: words, and units of words, whose ids a Python worker remembers, twice
REMEMBERED_WORDS = 500_000
#: text whose unknown words are encoded together
SLICE_BYTES = 1 << 21


def balanced_windows(sizes: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp multiway differencing: the window (0 to k - 1) of each
    size. A partial partition lists its filled windows only, by falling sum:
    until it has k, the next size is put in its place among them."""
    n = len(sizes)
    if k == 1:
        return np.zeros(n, np.int64)
    left, right = [], []                    # children of merged sets; ids from n on
    heap = [(-s, i, [-s], [i]) for i, s in enumerate(sizes.tolist())]       # sums are negative
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, a, a_sets = heapq.heappop(heap)
        _, _, b, b_sets = heapq.heappop(heap)
        if 1 < min(len(a), len(b)) and len(a) + len(b) > k:
            a, b = (np.array(x + [0] * (k - len(x))) for x in (a, b))
            a_sets, b_sets = (np.array(x + [-1] * (k - len(x))) for x in (a_sets, b_sets))
            sums, b_sets = a + b[::-1], b_sets[::-1]
            sets = np.maximum(a_sets, b_sets)   # right wherever one of the two is empty
            both = np.flatnonzero((a_sets >= 0) & (b_sets >= 0))
            sets[both] = np.arange(n + len(left), n + len(left) + len(both))
            left.extend(a_sets[both].tolist())
            right.extend(b_sets[both].tolist())
            order = np.argsort(sums, kind="stable")
            a, a_sets = sums[order].tolist(), sets[order].tolist()
        else:
            if len(a) + len(b) > k:         # one size more in the smallest window of a whole partition
                x, y = (a, b) if len(b) == 1 else (b, a)
                x_sets, y_sets = (a_sets, b_sets) if len(b) == 1 else (b_sets, a_sets)
                y[0] += x.pop()
                left.append(x_sets.pop())
                right.append(y_sets[0])
                y_sets[0] = n + len(left) - 1
            if len(b) == 1:
                at = bisect_right(a, b[0])
                a.insert(at, b[0])
                a_sets.insert(at, b_sets[0])
            else:
                a, a_sets = a + b[::-1], a_sets + b_sets[::-1]
                order = sorted(range(len(a)), key=a.__getitem__)
                a, a_sets = [a[i] for i in order], [a_sets[i] for i in order]
        least = a[-1] if len(a) == k else 0
        heapq.heappush(heap, (a[0] - least, tick, a, a_sets))
        tick += 1
    window = np.zeros(n, np.int64)
    for w, top in enumerate(heap[0][3] if heap else []):
        todo = [top]
        while todo:
            x = todo.pop()
            if x < n:
                window[x] = w
            else:
                todo += (left[x - n], right[x - n])
    return window


def pack_block(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each size; no window exceeds ``capacity``."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = balanced_windows(sizes, k)
        if np.bincount(window, sizes, k).max(initial=0) <= capacity:
            break
        k += 1
    order = np.argsort(window, kind="stable")
    ends = np.cumsum(sizes[order])
    starts = ends - sizes[order]
    first = np.r_[True, window[order][1:] != window[order][:-1]]
    offset = np.empty(len(sizes), np.int64)
    offset[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
    return window, offset


def cut(n_tokens: int, capacity: int = CAPACITY, max_piece: int = MAX_PIECE,
        least_piece: int = LEAST_PIECE) -> list[tuple[int, int]]:
    """(start, length) pieces of a document: whole windows, then half of the
    rest (at most ``max_piece``), half of what is left, and so on."""
    whole, rest = divmod(n_tokens, capacity)
    out = [(i * capacity, capacity) for i in range(whole)]
    at = whole * capacity
    while rest:
        size = rest if rest <= least_piece else min(max_piece, (rest + 1) // 2)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


# The word borders of the tokeniser's specification, and the same borders for words of
# ASCII and precomposed Latin letters in lower case.
BORDERS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "a-z\u00df-\u00f6\u00f8-\u024f"
UNITS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
# capitals among them whose lower case is no single letter of these have to stay out
PLAIN = re.compile("[\x21-\x7e" + "".join(c for c in map(chr, range(0xc0, 0x250)) if re.fullmatch(f"[{LETTERS}]", c.lower())) + "]+")


class WordIds(dict):
    """Ids of white-space-separated words as little-endian bytes. Tokenisers
    that drop white space treat words independently, so a text's ids are its
    words' ids in order. A slice's unknown words are cut at the tokeniser's own
    borders and their new units encoded together, each once; a unit ends with
    the one token that has the end-of-word suffix."""

    def __init__(self, spec: str, most: int):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer, self.most = Tokenizer.from_str(spec), most
        self.units, self.older, self.older_units = {}, {}, {}
        told = json.loads(spec)
        steps = told.get("pre_tokenizer") or {}
        first = (steps.get("pretokenizers") or [steps])[0]
        pattern = first.get("pattern", {}).get("Regex", "")
        removed = (first.get("type"), first.get("behavior"), first.get("invert")) == ("Split", "Removed", True)
        if not (first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or removed and "\\s" in pattern):
            raise ValueError("the tokeniser must drop white space and keep words apart")
        suffix = told["model"].get("end_of_word_suffix")
        lower = any(n.get("type") == "Lowercase" for n in (told.get("normalizer") or {}).get("normalizers", []))
        self.cuts = bool(removed and pattern == BORDERS and suffix and lower and "pretokenizers" in steps)
        self.marks = tuple({t["content"].encode()[:2] for t in told.get("added_tokens", [])})
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.cuts:                       # units need no normalising and no search for borders
            ready = [{"type": "WhitespaceSplit"}, *steps["pretokenizers"][1:]]
            self.of_units = Tokenizer.from_str(json.dumps(told | {
                "normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": ready}}))
            self.ends[[i for token, i in self.tokenizer.get_vocab(False).items() if token.endswith(suffix)]] = True

    def split(self, raw: bytes) -> list[bytes]:
        """Words of a text; ASCII case is dropped where the tokeniser does so anyway."""
        plain = self.cuts and not any(m in raw for m in self.marks)
        return (raw.lower() if plain else raw).split()

    def _encode(self, units: list[str]):
        for i in range(0, len(units), 4096):
            part = units[i:i + 4096]
            ids = np.array(self.of_units.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(part):
                data, at = ids.tobytes(), [0, *(4 * last).tolist()]
                self.units.update((u, data[x:y]) for u, x, y in zip(part, at, at[1:]))
            else:
                self.units.update((u, self._whole(u)) for u in part)

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, texts: list[list[bytes]]):
        """Makes the words of ``texts`` known. When the memo is full it becomes
        the older one; what is met again moves back, the rest goes next time."""
        for memo, older in ((self, self.older), (self.units, self.older_units)):
            if len(memo) > self.most:
                older.clear()
                older.update(memo)
                memo.clear()
        new = set().union(*texts).difference(self)
        self.update((w, self.older[w]) for w in new.intersection(self.older))
        new = list(new.difference(self.older))
        words = list(map(bytes.decode, new))
        if self.cuts:
            marked = {w for m in map(bytes.decode, self.marks) for w in words if m in w}
            whole = [w in marked or not p for w, p in zip(words, map(PLAIN.fullmatch, words))]
        else:
            whole = [True] * len(words)
        cut = [(b, w.lower()) for b, w, x in zip(new, words, whole) if not x]
        units = list(map(UNITS.findall, (w for _, w in cut)))
        unknown = set().union(*units).difference(self.units)
        self.units.update((u, self.older_units[u]) for u in unknown.intersection(self.older_units))
        self._encode(list(unknown.difference(self.older_units)))
        self.update((b, w) for (b, _), w in zip(cut, map(b"".join, (map(self.units.__getitem__, u) for u in units))))
        self.update((b, self._whole(w)) for b, w, x in zip(new, words, whole) if x)


def worker_memo(key, make):
    """``make()``, once per Python worker and key."""
    memo = sys.__dict__.setdefault("_sievekit_memo", {})
    if key not in memo:
        memo[key] = make()
    return memo[key]


def known_words(words: WordIds, texts: list[bytes]):
    """The words of each text, known to ``words`` when they are returned."""
    slice_, size = [], 0
    for text in [*texts, None]:
        if slice_ and (text is None or size + len(text) > SLICE_BYTES):
            gc.disable()                    # a million small objects without cycles
            words.learn(slice_)
            gc.enable()
            yield from slice_
            slice_, size = [], 0
        if text is not None:
            slice_.append(words.split(text))
            size += len(text)


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text", capacity: int = CAPACITY, max_piece: int = MAX_PIECE,
           least_piece: int = LEAST_PIECE) -> DataFrame:
    """Per piece: ``uid`` (unique), ``id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``. The tokeniser must be one that drops white
    space and keeps words apart."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    key = ("word ids", zlib.crc32(spec.encode()), REMEMBERED_WORDS)
    end = np.array([end_id], "<u4").tobytes()
    most = REMEMBERED_WORDS
    src = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("b"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext
        words = worker_memo(key, lambda: WordIds(spec, most))
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            row, out = [], []
            for i, split in enumerate(known_words(words, batch.column("b").to_pylist())):
                ids = memoryview(b"".join(map(words.__getitem__, split)) + end)
                n = len(ids) // 4
                for start, length in cut(n, capacity, max_piece, least_piece):
                    row.append(i)
                    out.append((uid, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n))
                    uid += 1
            cols = [pa.array([r[j] for r in out], pa.int64()) for j in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row, pa.int64())), *cols],
                ["id", "uid", "start", "length", "ids_crc32", "doc_tokens"])

    return src.mapInArrow(run, f"id {id_type}, uid long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, max_piece: int = MAX_PIECE, least_piece: int = LEAST_PIECE,
         block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``."""
    made = stored(pieces(docs, tokenizer_path, end_id, id_col, text_col, capacity, max_piece, least_piece), "pieces")
    whole, rest = made.where(F.col("length") == capacity), made.where(F.col("length") < capacity)
    total = rest.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, round(total / (capacity * block_windows)))
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in columns)

    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")        # the same result in every attempt
        window, offset = pack_block(table.column("length").to_numpy().astype(np.int64), capacity)
        number = table.column("block").to_numpy().astype(np.int64)
        return (table.select(columns)
                .append_column("sequence_id", pa.array(2 * ((number << 24) + window), pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    packed = (rest.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
                  .groupBy("block").applyInArrow(block, schema + ", sequence_id long, offset long"))
    alone = whole.select(*columns, (2 * F.col("uid") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).withColumnRenamed("id", id_col)
