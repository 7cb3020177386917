"""The prefix trie against one built in plain Python."""

import hashlib
import zlib

import pytest

from sievekit.llm import prefix_trie
from sievekit.llm.queries import QUERIES
from tests.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string, c string, pos int, k int"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - c % 100, [])[:h]) + tuple(own[c][h:])
    nodes, below = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    for path in nodes:
        if path:
            below.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1]) if path else 0
            leaves[path[:d]] += path not in below
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(below.get(p, ())), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if paths[c] == p))).encode()).hexdigest())
                  for p, m in nodes.items())


def trie(df):
    return sorted(map(tuple, prefix_trie.prefix_trie(*prefix_trie.rebuilt(prefix_trie.turns(df))).collect()))


def build(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def test_query(spark):
    df = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted(map(tuple, QUERIES["op11_prefix_trie"](spark, SF001).collect()))
    assert got == brute(map(tuple, df.collect()))


@pytest.mark.parametrize("block, chunk", [(4, 4096), (1, 2), (3, 2)])
def test_odd_rows(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = [(None, 0, "user", "no conversation"), (100, None, "user", "first"), (100, 0, None, None), (100, 1, "user", ""),
            (100, 1, "user", ""), (7, 0, "system", "alone without a lead")]
    rows += [(101 + i, t, "ua"[t % 2], f"text {t}") for i in range(6) for t in range(3 + i % 3)]       # copies, ties at the end
    rows += [(200, t, "ua"[t % 2], f"long {t}") for t in range(40)]
    rows += [(201 + i, t, "ua"[t % 2], f"long {t}" if t != 9 + i else "other") for i in range(4) for t in range(40)]
    rows += [(300 + i, 0, "user", "one turn") for i in range(30)]
    assert trie(build(spark, rows)) == brute(rows)


def test_turnless_and_empty(spark):
    rows = [(100 + i, 0, "user", "hello") for i in range(8)] + [(c, 0, "user", "x") for c in range(1, 30)]
    got = trie(build(spark, rows))
    assert got == brute(rows)
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in got)      # some lost their only turn
    assert trie(build(spark, [])) == [] == trie(build(spark, [(None, 1, "user", "x")]))


def test_few_nodes_are_opened_twice(spark):
    """Equal conversations are one group of blocks: nothing is grouped by turn below their common prefix."""
    rows = [(c, t, "user", f"turn {t}") for c in range(101, 140) for t in range(12)]
    made = prefix_trie.blocks(prefix_trie.turns(build(spark, rows)))
    assert made.select("k", "p1", "p2", "q1", "q2").distinct().count() == 3
