import random
from collections import Counter

from sievekit.llm import near_dup as N
from sievekit.llm.components import connected_components


def shingle_set(t):
    w = (t or "").encode().lower().split()
    return frozenset([b" ".join(w)]) if 0 < len(w) < 5 else frozenset(b" ".join(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders.get(x, ()))
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
        for x in s:
            holders.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                   N.near_duplicate_groups(df, **kw).collect()), key=str)


def variant(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_odd_rows(make, odd_rows):
    assert run(make(odd_rows)) == brute(odd_rows)


def test_empty_table(make):
    assert run(make([])) == []


def test_families_and_chains(make):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 300))]
        for _ in range(rng.randint(1, 14)):
            rows.append((n, variant(rng, base, rng.randint(0, 3))))
            n += 1
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for _ in range(8):                       # linked step by step only
        chain = variant(rng, chain, 2).split()
        rows.append((n, " ".join(chain)))
        n += 1
    rng.shuffle(rows)
    assert run(make(rows)) == brute(rows)


def test_large_nodes_branch_and_meet_in_blocks(make):
    """A small node size forces deep branching, and blocks at the last level."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = [(i, variant(rng, base, rng.randint(0, 8))) for i in range(120)]
    rows += [(200 + i, " ".join(base[:100] + [f"x{i}_{j}" for j in range(60)])) for i in range(60)]
    assert run(make(rows), node_size=8, levels=4) == brute(rows)
    assert run(make(rows), node_size=8, levels=2, trees=20) == brute(rows)


def test_large_family_keeps_its_links(make):
    """Production parameters on a family far above 256 / s^8 of texts about 0.78
    alike, of which 200 pairs are at 0.859: every pair is found, nothing else."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]             # 396 shingles, an edit takes 5

    def edited(words, n_edits, name):
        words = list(words)
        free = [i for i in range(5, 395, 5) if words[i] == base[i]]
        at = tuple(sorted(rng.sample(free, n_edits)))
        for i in at:
            words[i] = f"{name}_{i}"
        return words, at

    rows, seen = [], set()
    while len(rows) < 2300:                          # four shared places would link
        words, at = edited(base, 5, f"a{len(rows)}")
        fours = {at[:i] + at[i + 1:] for i in range(5)}
        if not fours & seen:
            seen |= fours
            rows.append((len(rows), words))
    pairs = {10_000 + i: i for i in range(200)}
    rows += [(new, edited(rows[old][1], 6, f"b{old}")[0]) for new, old in pairs.items()]
    got = run(make([(i, " ".join(w)) for i, w in rows]))
    wrong = [(i, c) for i, _, c in got if c != pairs.get(i, i)]
    assert len(got) == 2500 and not wrong


def test_levels_follow_the_miss_rate():
    assert N.compared_levels(85, 10, 8, 1e-5) == 2 and N.compared_levels(85, 40, 8, 1e-5) == 8
    assert N.compared_levels(50, 1, 8, 1e-5) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
