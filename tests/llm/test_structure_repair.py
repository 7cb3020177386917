"""Conversation repair against a shortest-path search per conversation."""

import hashlib
import heapq
import itertools
import re
import zlib

import pytest

from sievekit.llm import structure_repair
from sievekit.llm.queries import QUERIES
from tests.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string, c string, t int, symbol int"
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(rows):
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, out
        role, after = NEXT[state]
        heapq.heappush(heap, (cost + 2, audit + "I", i, after, (*out, f"{role}:")))
        if i < len(rows):
            r, x, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, after, (*out, f"{role}:{x}")))
                if (state, r[:1]) in KEEP:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, KEEP[state, r[:1]], (*out, f"{r}:{x}")))


def brute(rows):
    conversations, out = {}, []
    for c, turn, role, text in rows:
        own = conversations.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [((turn is not None, turn or 0), "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for c, own in conversations.items():
        seen, turns = set(), []
        for _, r, x in sorted(own, key=lambda v: v[:2]):
            bare = x.rstrip(" \t\n\x0b\x0c\r")
            turns.append((r, x, "blank" if not bare else "duplicate" if (r, x) in seen else
                          "truncated" if bare[-1] not in ".!?" else ""))
            seen.add((r, x))
        known = [t for (there, t), _, _ in own if there]
        cost, audit, lines = cheapest(turns)
        faults = [f for _, _, f in turns]
        out.append((c, max(known) - min(known) + 1 - len(set(known)) if known else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns)),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def repaired(df):
    got = structure_repair.repair(structure_repair.damage(df), df.select(df.conv_id.alias("c")))
    return sorted(map(tuple, got.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_query(spark):
    df = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted(map(tuple, QUERIES["op12_structure_repair"](spark, SF001).collect()))
    assert got == brute(map(tuple, df.collect()))


def test_odd_rows(spark):
    roles = ["system", "user", "assistant", "tool", None, "", "Us"]
    texts = ["Done.", "open end", "", None, " \t\n", "same.", "same.", "Why?\n", "naïve …", "ends. "]
    rows = [(c, None if i == 3 and c % 5 == 0 else i, roles[(c * 7 + i * i) % 7], texts[(c + 3 * i) % 10])
            for c in range(60) for i in range(c % 9)]
    rows += [(None, i, "user", f"none {i}.") for i in range(4)] + [(500, None, None, None)]
    rows += [(600, i, "user", "again.") for i in range(6)] + [(601, i, "ua"[i % 2], f"turn {i}") for i in range(300)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    assert repaired(df) == brute(rows)
    assert repaired(df.where("false")) == []


def test_repeated_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, 1, "assistant", "b."), (1, 1, "assistant", "b.")]
    assert repaired(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)) == brute(rows)


@pytest.mark.parametrize("order", [sorted, lambda s: sorted(s, reverse=True)])
def test_every_short_signature(order):
    """All signatures of up to four turns, through one automaton whose nodes are reused."""
    role = dict(zip("abcdefgh", ["s", "u", "a", "o"] * 2)) | {"x": "u"}
    fault = {c: "truncated" if c in "efgh" else "blank" if c == "x" else "" for c in role}
    automaton = structure_repair.SuffixAutomaton()
    signatures = ["".join(s) for n in range(5) for s in itertools.product("abcdefgx", repeat=n)]
    for backwards in order(signatures):
        rows = [(role[c], "t", fault[c]) for c in reversed(backwards)]
        assert automaton.repair(backwards) == cheapest(rows)[:2]


def test_suffixes_are_made_once():
    made = []

    class Counting(structure_repair.SuffixAutomaton):
        def node(self, symbol, rest):
            made.append(symbol)
            return super().node(symbol, rest)

    automaton = Counting()
    for s in ["a" * 100, "a" * 100 + "b", "a" * 100 + "c"]:
        automaton.repair(s)
    assert len(made) == 102
