import heapq
import zlib

import numpy as np
from tokenizers import Tokenizer

from sievekit.llm import packing as P
from sievekit.llm.queries import vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")


def check(rows, got, capacity=2048):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    want = {}
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for start, length in P.cut(len(ids)):
            want.setdefault(i, []).append((start, length, zlib.crc32(ids[start:start + length].tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        ends = 0
        for offset, length in sorted(w):
            assert offset == ends
            ends += length
        assert ends <= capacity
    return [sum(n for _, n in w) for w in windows.values()]


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(20, "a\x0bb\x1cc <|endoftext|>   d's 12"), (21, "İX ΣΣ é")]
    check(rows, P.pack(make(rows), PATH).collect())


def test_capitals_whose_lower_case_is_another_block_s(make):
    check([(1, "gÖLÇÜK Əliyev aƆb ȺÞ sƏƏs")], P.pack(make([(1, "gÖLÇÜK Əliyev aƆb ȺÞ sƏƏs")]), PATH).collect())


def test_little_padding(make):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, rng.integers(1, 900)))) for i in range(500)]
    used = check(rows, P.pack(make(rows), PATH, block_windows=32).collect())
    assert 1 - sum(used) / 2048 / len(used) < 0.03


def test_empty_table(make):
    assert P.pack(make([]), PATH).count() == 0


def test_differencing():
    rng = np.random.default_rng(2)
    sizes = np.concatenate([[n for _, n in P.cut(int(x))] for x in rng.integers(1, 2048, 150)])
    k = -(-int(sizes.sum()) // 2048)
    totals = np.bincount(P.balanced_windows(sizes, k), sizes, k)
    assert totals.sum() == sizes.sum() and totals.max() - totals.min() <= 64
    assert np.bincount(P.balanced_windows(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4]).tolist() in ([16, 14], [14, 16])


def differenced(sizes, k):
    """The same with all k sums of every partial partition."""
    heap = sorted((-s, i, [(s, (i,))] + [(0, ())] * (k - 1)) for i, s in enumerate(sizes))
    tick = len(heap)
    while len(heap) > 1:
        (*_, a), (*_, b) = heapq.heappop(heap), heapq.heappop(heap)
        c = sorted(((x + y, m + n) for (x, m), (y, n) in zip(a, b[::-1])), key=lambda w: -w[0])
        heapq.heappush(heap, (c[-1][0] - c[0][0], tick, c))
        tick += 1
    return {i: w for w, (_, members) in enumerate(heap[0][2]) for i in members}


def test_differencing_puts_single_sizes_in_their_place(monkeypatch):
    rng = np.random.default_rng(3)
    for n, k, top in ((1, 2, 9), (5, 8, 9), (60, 7, 4), (90, 40, 2), (200, 20, 1000), (41, 20, 100)):
        sizes = rng.integers(1, top + 1, n)
        assert P.balanced_windows(sizes, k).tolist() == [w for _, w in sorted(differenced(sizes.tolist(), k).items())]
    whole, merged = np.argsort, []
    monkeypatch.setattr(P.np, "argsort", lambda *a, **b: merged.append(1) or whole(*a, **b))
    P.balanced_windows(rng.integers(1, 1024, 2000), 500)        # one at a time, not all 500 sums for each
    assert len(merged) < 200


def test_windows_are_added_beyond_capacity():
    window, offset = P.pack_block(np.array([1500, 1500, 1000]), 2048)
    assert len(set(window.tolist())) == 3 and offset.tolist() == [0, 0, 0]
    assert P.pack_block(np.empty(0, np.int64))[0].size == 0


def test_cut():
    for n in (1, 63, 64, 65, 2047, 2048, 2049, 10_000):
        pieces = P.cut(n)
        assert [s for s, _ in pieces] == np.cumsum([0, *[m for _, m in pieces]])[:-1].tolist()
        assert sum(m for _, m in pieces) == n and all(1 <= m <= 2048 for _, m in pieces)
