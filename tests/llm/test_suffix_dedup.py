"""Removal of repeated byte strings against a dictionary of all strings."""

import random

import numpy as np
import pytest

from sievekit.llm import suffix_dedup
from sievekit.llm.queries import QUERIES
from tests.conftest import SF0001


def brute(rows, length):
    texts, seen = [(i, (t or "").encode()) for i, t in rows], {}
    for _, b in texts:
        for s in range(len(b) - length + 1):
            seen[b[s:s + length]] = seen.get(b[s:s + length], 0) + 1
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s] += 1
                gone[s + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        out.append((i, len(b), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0,
                    bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[4]))


def removed(df, length):
    return sorted(((i, n, r, s, bytes(kept)) for i, n, r, s, kept in suffix_dedup.remove_repeats(df, length=length).collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[4]))


def test_query(spark):
    import hashlib
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_suffix_dedup"](spark, SF0001).collect()))
    assert got == sorted((i, n, r, s, hashlib.sha256(kept).hexdigest()) for i, n, r, s, kept in brute(rows, 400))


@pytest.mark.parametrize("piece", [1 << 18, 700])
def test_shared_passages(spark, make, monkeypatch, piece):
    """Passages at any offset, around the least length, at both ends, overlapping, with edits, in a long text; a constant run."""
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))[:n]

    passage, other = prose(1500), prose(900)
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (None, prose(800)), (4, passage), (4, passage), (None, passage)]
    for i, n in enumerate([380, 398, 399, 400, 401, 402, 420, 431, 432, 433, 500, 800, 1500]):
        cut = rng.randint(0, 1500 - n)
        rows.append((10 + i, prose(rng.randint(0, 300)) + "#" + passage[cut:cut + n] + "#" + prose(rng.randint(0, 300))))
        rows.append((30 + i, other[:n] + "@" + prose(i)))
        rows.append((50 + i, prose(i) + "@" + other[-n:]))
    for i in range(12):                                     # near copies
        at = rng.randint(0, len(passage))
        rows.append((70 + i, passage[:at] + "!" * (i % 3) + passage[at + i % 2:]))
    rows += [(90, "z" * 900), (91, "ab" * 450), (92, prose(20_000) + passage + prose(20_000) + other + prose(3_000) + passage)]
    assert removed(make(rows), 400) == brute(rows, 400)


def test_odd_rows(spark, make, odd_rows):
    df = make([r for r in odd_rows if r[0] != 8])
    assert removed(df, 400) == brute([(r[0], r[1]) for r in df.collect()], 400)
    assert removed(make(odd_rows).where("false"), 400) == []
    assert sum(r[2] for r in removed(make([(1, "x" * 399), (2, "x" * 399)]), 400)) == 0


def test_spans():
    begin, end = suffix_dedup.removed_spans(np.array([5, 0, 30]), np.array([6, 0, 31]), 10)
    assert (begin.tolist(), end.tolist()) == ([0, 30], [16, 41])


def test_cover_has_every_difference():
    cover, n = suffix_dedup.COVER, suffix_dedup.MODULUS
    assert {(a - b) % n for a in cover for b in cover} == set(range(n))
