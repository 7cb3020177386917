"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie. Every node has a failure link and the number of
pieces that greedy longest-match has finished when the link is taken, so one
pass over a word's bytes gives the number of its pieces; no piece is built and
no byte is read twice.

Words are runs of bytes other than ASCII white space. With a byte-level
vocabulary a word is matched with its leading space, as that vocabulary stores
it. A word that cannot be covered counts as one (unknown) piece. Null or empty
text has no words and no tokens. Row order, repeats and further columns don't
matter; every input row gives one output row.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: words whose counts a task remembers; the rest are counted again when they recur
REMEMBERED_WORDS = 400_000


class LongestMatch:
    """The automaton. ``first`` are pieces that may start a word, ``later``
    (default: the same) those that may continue one."""

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes] | None = None):
        self.edges: dict[int, int] = {}       # node * 256 + byte -> node
        self.fail: list[int] = [-1]
        self.pops: list[int] = [0]
        self._final: list[bool] = [False]
        self.cont = self.start = 0
        for piece in (first if later is None else later):
            self._add(0, piece)
        if later is not None:
            self.start = self._node()
            for piece in first:
                self._add(self.start, piece)
        self._link()

    def _node(self) -> int:
        self.fail.append(-1)
        self.pops.append(0)
        self._final.append(False)
        return len(self.fail) - 1

    def _add(self, root: int, piece: bytes) -> None:
        at = root
        for b in piece:
            nxt = self.edges.get(at * 256 + b)
            if nxt is None:
                nxt = self.edges[at * 256 + b] = self._node()
            at = nxt
        if piece:
            self._final[at] = True

    def _link(self) -> None:
        children: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.edges.items():
            children.setdefault(key // 256, []).append((key % 256, child))
        queue = deque([self.cont] if self.start == self.cont else [self.cont, self.start])
        while queue:                          # parents before children, the later-trie level by level
            parent = queue.popleft()
            for byte, node in children.get(parent, ()):
                if self._final[node]:
                    self.fail[node], self.pops[node] = self.cont, 1
                else:
                    at, popped = self.fail[parent], self.pops[parent]
                    while at >= 0 and at * 256 + byte not in self.edges:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.pops[node] = self.edges[at * 256 + byte], popped
                queue.append(node)

    def count(self, word: bytes) -> int:
        """Pieces of ``word`` under greedy longest-match; 1 if it can't be covered."""
        if not word:
            return 0
        edges, fail, pops = self.edges, self.fail, self.pops
        at, total = self.start, 0
        for b in word:
            nxt = edges.get(at * 256 + b)
            while nxt is None:
                total += pops[at]
                at = fail[at]
                if at < 0:
                    return 1
                nxt = edges.get(at * 256 + b)
            at = nxt
        while at != self.cont:
            total += pops[at]
            at = fail[at]
            if at < 0:
                return 1
        return total


def byte_level_vocabulary(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file as raw bytes. Such files write
    each byte as a printable character: printable Latin-1 bytes as themselves,
    the others as the code points from 256 on, in order."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return [bytes(back[c] for c in piece) for piece in spec["model"]["vocab"] if piece not in special]


class _Counts(dict):
    def __init__(self, automaton: LongestMatch, prefix: bytes, most: int):
        super().__init__()
        self.automaton, self.prefix, self.most = automaton, prefix, most

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.prefix + word)
        if len(self) < self.most and len(word) <= 64:
            self[word] = n
        return n


def token_counts(docs: DataFrame, pieces: Iterable[bytes], later: Iterable[bytes] | None = None,
                 prefix: bytes = b" ", id_col: str = "doc_id", text_col: str = "text",
                 remembered: int = REMEMBERED_WORDS) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_words``, ``n_tokens`` (longs).

    The automaton is built once on the driver from the bounded vocabulary and
    shipped with the task code.
    """
    pieces = sorted(set(pieces))
    automaton = LongestMatch(pieces, None if later is None else sorted(set(later)))
    src = docs.select(F.col(id_col).alias("id"), F.encode(F.col(text_col), "utf-8").alias("b"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        counts = _Counts(automaton, prefix, remembered)
        for batch in batches:
            out = []
            for raw in batch.column("b").to_pylist():
                found = raw.split() if raw else []
                out.append((len(raw or b""), len(found), sum(map(counts.__getitem__, found))))
            cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *cols],
                                             ["id", "n_bytes", "n_words", "n_tokens"])

    return (src.mapInArrow(run, f"id {id_type}, n_bytes long, n_words long, n_tokens long")
               .withColumnRenamed("id", id_col))
