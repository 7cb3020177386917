import random
import zlib

import pytest

from sievekit.llm import sharding as S


def brute_capacity(sizes, parts):
    def needed(c):
        n, room = 1, c
        for s in sizes:
            if s > c:
                return parts + 1
            if s > room:
                n, room = n + 1, c
            room -= s
        return n
    return next(c for c in range(1, sum(sizes) + 1) if needed(c) <= parts) if sizes else 0


@pytest.mark.parametrize("seed", range(6))
def test_smallest_capacity_and_cuts(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 60))]
    parts = rng.randint(1, 9)
    order = S.Prefixes([(i, s, 1, 64) for i, s in enumerate(sizes)])
    best = brute_capacity(sizes, parts)
    assert order.capacity(parts) == best
    cuts = [0, *order.cuts(parts), len(sizes)]
    assert cuts == sorted(cuts) and max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) <= best


def test_prefixes_lead_to_the_groups_optimum(spark):
    rng = random.Random(9)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.randint(1, 400)) for _ in range(20_000)]
    large, least, cuts = S.plan(spark.createDataFrame(rows, "g long, size long"), 24)
    rows.sort()
    totals = [0] * 24
    for g, s in rows:
        totals[sum(g >= c for c in cuts)] += s
    low, high = -(-sum(s for _, s in rows) // 24), sum(s for _, s in rows)
    order = S.Prefixes([(g, s, 1, 64) for g, s in rows])
    assert not large and not least and max(totals) == order.capacity(24) and low <= max(totals) < high
    assert min(totals) > 0.97 * max(totals)


@pytest.mark.parametrize("seed", range(5))
def test_one_search_over_the_documented_order(spark, seed):
    """Large groups first by falling size, then the others by hash: the smallest capacity of exactly that order."""
    rng = random.Random(seed)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.randint(1, 40)) for _ in range(rng.randint(4, 300))]
    rows += [(rng.getrandbits(64) - (1 << 63), rng.choice([400, 400, 900, 3000])) for _ in range(seed)]
    shards = rng.randint(2, 7)
    large, least, cuts = S.plan(spark.createDataFrame(rows, "g long, size long"), shards)
    total = sum(s for _, s in rows)
    order = sorted((r for r in rows if r[1] * shards > total), key=lambda r: (-r[1], r[0])) + sorted(
        r for r in rows if r[1] * shards <= total)
    place = [large[g] if g in large else least + sum(g >= c for c in cuts) for g, _ in order]
    assert place == sorted(place) and set(place) <= set(range(shards))         # contiguous
    totals = [sum(s for (_, s), p in zip(order, place) if p == k) for k in range(shards)]
    assert max(totals) == brute_capacity([s for _, s in order], shards)
    assert len(set(place)) == min(shards, len(order))


def check(rows, got, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    where = {}
    for r in got:
        where.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(v) == 1 for v in where.values())


def test_odd_rows(make, odd_rows):
    check(odd_rows, S.shard(make(odd_rows), 5).collect(), 5)
    assert S.shard(make([]), 5).count() == 0
    check([(1, "a")], S.shard(make([(1, "a")]), 24).collect(), 24)


def test_hot_group_has_its_own_shard(make):
    rng = random.Random(4)
    rows = [(i, "hot " * 50) for i in range(300)] + [(1000 + i, "z" * rng.randint(10, 90)) for i in range(800)]
    got = S.shard(make(rows), 8).collect()
    check(rows, got, 8)
    totals = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert sorted(totals)[-1] == 300 * 208 and min(totals) > 0.9 * sorted(totals)[-2]
