"""Near-duplicate groups by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles; two are linked if the
Jaccard similarity of their sets reaches ``percent``. Equal sets are one class,
and everything below works on classes.

``trees`` independent trees branch the classes: a class goes to the child named
by its minwise token (the shingle smallest under a random order of its own for
each tree and level), so two classes of similarity s stay together with
probability s a level. A node of at most ``node_size`` classes is compared
exhaustively, a larger one branches on. Unrelated documents part at the first
level, so a linked pair is missed with probability (1 - s)^trees there (6e-9 at
0.85), and (1 - s^d)^trees in groups that stay large down to level d. Branching
for comparison therefore stops at the last level where that is at most ``miss``
(with 10 trees d = 2 at 0.85, 3e-6); nodes still large there are compared in
blocks, every block with every other.

Groups of copies never part, and need not: only components are asked for. Every
node links its members to its smallest class first; the confirmed links are
contracted, and nodes all of whose classes are in one component are done.
Exhaustive comparison is left for nodes that hold several components, and only
between them.

Minwise sketches decide what is compared (agreement of ``likely`` or more, five
standard deviations below the threshold); every link is confirmed on the full
sets. A group of classes yields classes worth comparing and links that join
something new, never its pairs. Whole texts are read; nothing is capped or
sampled.

Words are runs of non-ASCII-white-space with A-Z lower-cased. A text of fewer
than five words is one shingle; a null or empty text has none and is linked
with nothing. Rows that repeat an id are classed by their own texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import row_hash, stored
from sievekit.llm.components import connected_components

SHINGLE = 5
TREES = 10
LEVELS = 8
STAR_LEVELS = 3                 # levels whose nodes link to their smallest class first
NODE_SIZE = 256
MISS = 1e-5                     # the most a linked pair may be missed with
LIKELY = 0.65


def shingles(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Ascending distinct 64-bit shingle hashes."""
    import xxhash
    words = (raw or b"").lower().split()         # bytes: ASCII case and white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    s = np.zeros(n - size + 1, np.uint64)
    for j in range(size):                        # wraps modulo 2**64
        s = (s ^ h[j:n - size + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        s ^= s >> np.uint64(29)
    return np.unique(s)


def sketch(found: np.ndarray, factors: np.ndarray, block: int = 1024) -> np.ndarray:
    """The smallest token under each factor's order, as 32-bit values."""
    best = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), block):
        np.minimum(best, (found[None, i:i + block] * factors[:, None]).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, n_tokens: int) -> DataFrame:
    """``id``, ``th``, ``n`` (set size), ``key`` (of the set; null if empty), ``sketch``."""
    factors = _factors(n_tokens)
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), row_hash(text).alias("th"), F.encode(text, "utf-8").alias("b"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, keys, marks = [], [], []
            for raw in batch.column("b").to_pylist():
                found = shingles(raw, size)
                n.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                marks.append(sketch(found, factors) if len(found) else np.empty(0, np.int32))
            ends = np.cumsum([0, *map(len, marks)])
            flat = np.concatenate([*marks, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))],
                ["id", "th", "n", "key", "sketch"])

    return src.mapInArrow(run, f"id {id_type}, th long, n long, key binary, sketch array<int>")


def compared_levels(percent: int, trees: int, levels: int, miss: float) -> int:
    """The last level, 1 to ``levels``, at which a pair at ``percent`` shares no
    node in any tree with probability ``miss`` at most."""
    missed = [(1 - (percent / 100) ** d) ** trees for d in range(1, levels + 1)]
    return max(1, sum(m <= miss for m in missed))


def _with_nodes(rows: DataFrame, name: str) -> DataFrame:
    """Adds each node's size ``n`` and smallest class ``pivot``; nodes of one class go."""
    nodes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("pivot")).where("n > 1")
    return stored(rows.join(nodes, "path"), name)


def _children(rows: DataFrame, classes: DataFrame, level: int, trees: int, levels: int) -> DataFrame:
    token = F.get(F.col("sketch"), F.col("tree") * levels + level)
    return (rows.select("path", "tree", "cid").join(classes.select("cid", "sketch"), "cid")
                .select(F.xxhash64("path", token).alias("path"), "tree", "cid"))


def _agreeing(pairs: DataFrame, classes: DataFrame, n_tokens: int, likely: float) -> DataFrame:
    """Pairs whose sketches agree in at least ``likely`` of the tokens."""
    a = classes.select(F.col("cid").alias("a"), F.col("sketch").alias("sa"))
    b = classes.select(F.col("cid").alias("b"), F.col("sketch").alias("sb"))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(b, "b").join(a, "a").where(same >= int(likely * n_tokens)).select("a", "b")


def _full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
               size: int) -> DataFrame:
    """``cid``, ``items`` (the class's shingles) for the classes ``cid`` of ``wanted``."""
    reps = wanted.select("cid").distinct().join(classes.select("cid", "rep", "rep_th"), "cid")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("t")).withColumn("th", row_hash(F.col("t")))
    src = (texts.join(reps, texts["id"].eqNullSafe(reps["rep"]) & (texts["th"] == reps["rep_th"]))
                .select("cid", F.encode("t", "utf-8").alias("b")))

    def sets(batches):
        for batch in batches:
            found = [shingles(b, size).tobytes() for b in batch.column("b").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(found, pa.binary())], ["cid", "items"])

    # a repeated row would double its class
    return stored(src.mapInArrow(sets, "cid long, items binary").dropDuplicates(["cid"]), "sets")


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    # the side with the popular classes first, while rows are small
    joined = (pairs.join(full.select(F.col("cid").alias("b"), F.col("items").alias("ib")), "b")
                   .join(full.select(F.col("cid").alias("a"), F.col("items").alias("ia")), "a")
                   .select("a", "b", "ia", "ib"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ia").to_pylist(), batch.column("ib").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(joined.mapInArrow(check, "a long, b long"), "confirmed")


def _promising(rows: DataFrame, key: list[str], n_tokens: int, likely: float) -> DataFrame:
    """Of each group ``key`` the classes whose sketch agrees with that of a
    class of another component. Classes, not pairs: no group makes more rows
    than it has."""
    names = [*key, "cid", "comp"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)

    def compare(table: pa.Table) -> pa.Table:
        comp = table.column("comp").to_numpy()
        marks = np.vstack([np.asarray(x, np.int32) for x in table.column("sketch").to_pylist()])
        keep = np.zeros(len(comp), bool)
        for i in range(len(comp)):
            at = np.flatnonzero(comp[i + 1:] != comp[i]) + i + 1
            at = at[(marks[at] == marks[i]).sum(axis=1) >= int(likely * n_tokens)]
            keep[at] = True
            keep[i] |= len(at) > 0
        return table.select(names).filter(pa.array(keep))

    return rows.groupBy(*key).applyInArrow(compare, schema)


def common_items(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all pairwise intersections: products of the 0/1 matrix of sets
    and the items that occur twice, some columns at a time."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, item, times = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True,
                               return_counts=True)
    shared = np.cumsum(times > 1) - 1
    use = times[item] > 1
    rows, item = rows[use], shared[item[use]]
    order = np.argsort(item, kind="stable")
    rows, item = rows[order], item[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for first in range(0, int(item[-1]) + 1 if len(item) else 0, columns):
        a, b = np.searchsorted(item, (first, first + columns))
        block = np.zeros((len(sets), columns), np.float32)
        block[rows[a:b], item[a:b] - first] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _links_within(rows: DataFrame, key: list[str], percent: int) -> DataFrame:
    """Exhaustive comparison of the groups ``key`` on full sets. Of the links
    between components those that join something new are returned: they connect
    what all links connect, and are fewer than the group's classes."""
    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        cid, comp = (table.column(c).to_numpy() for c in ("cid", "comp"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        both = common_items(sets)
        size = np.array([len(x) for x in sets])
        linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        linked &= comp[:, None] != comp[None, :]
        parent: dict[int, int] = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for i, j in zip(*np.nonzero(np.triu(linked, 1))):
            a, b = find(int(comp[i])), find(int(comp[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(cid[i]), int(cid[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()),
                         "b": pa.array([y for _, y in out], pa.int64())})

    return rows.groupBy(*key).applyInArrow(compare, "a long, b long")


def _mixed(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows (path, tree, cid, n, pivot) of nodes with several components, with ``comp``."""
    c = comps.select(F.col("node").alias("cid"), "component")
    rows = rows.join(c, "cid", "left").withColumn("comp", F.coalesce("component", "cid")).drop("component")
    mixed = (rows.groupBy("path").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .where("lo < hi").select("path"))
    return rows.join(mixed, "path")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                          shingle: int = SHINGLE, trees: int = TREES, levels: int = LEVELS,
                          node_size: int = NODE_SIZE, likely: float = LIKELY, miss: float = MISS) -> DataFrame:
    """Per row: ``id_col``, ``th`` (text hash), ``n_shingles``,
    ``component_id`` (smallest id reachable over links, itself included),
    ``component`` (the component's own number; null without words)."""
    n_tokens = trees * levels
    rows = stored(sketches(docs, id_col, text_col, shingle, n_tokens), "sketches")
    classes = stored(
        rows.where("n > 0").groupBy("key")
            .agg(F.min(F.struct("id", "th")).alias("r"), F.first("sketch").alias("sketch"))
            .select(F.monotonically_increasing_id().alias("cid"), "key", F.col("r.id").alias("rep"),
                    F.col("r.th").alias("rep_th"), "sketch"), "classes")

    # 1. branch; every node links its members to its smallest class
    root = classes.select("cid", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.xxhash64(t, F.get(F.col("sketch"), t * levels)))).alias("tree", "path"))
    nodes = [_with_nodes(root, "nodes")]
    while len(nodes) < min(STAR_LEVELS, levels):
        large = nodes[-1].where(F.col("n") > node_size)
        if large.isEmpty():
            break
        nodes.append(_with_nodes(_children(large, classes, len(nodes), trees, levels), "nodes"))
    stars = None
    for level in nodes:
        own = level.where("cid <> pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b"))
        stars = own if stars is None else stars.union(own)
    pairs = stored(_agreeing(stars.distinct(), classes, n_tokens, likely), "pairs")
    full = _full_sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")), classes, docs,
                      id_col, text_col, shingle)
    comps = stored(connected_components(_confirmed(pairs, full, percent)), "components")

    # 2. nodes that hold several components are compared exhaustively
    marks = classes.select("cid", "sketch")
    whole = F.lit(0).cast("long")

    def promising(mixed: DataFrame) -> DataFrame:
        small = mixed.where(F.col("n") <= node_size).join(marks, "cid")
        return _promising(small.select("path", whole.alias("x"), whole.alias("y"), "cid", "comp", "sketch"),
                          ["path", "x", "y"], n_tokens, likely)

    found, large, depth = None, None, 0
    deepest = compared_levels(percent, trees, levels, miss)
    while depth < min(len(nodes), deepest) or depth < deepest and not large.isEmpty():
        if depth == len(nodes):
            nodes.append(_with_nodes(_children(large, classes, depth, trees, levels), "nodes"))
        mixed = stored(_mixed(nodes[depth], comps), "mixed")
        found = promising(mixed) if found is None else found.union(promising(mixed))
        large = mixed.where(F.col("n") > node_size)
        depth += 1
    # still large at the last level: every block of classes with every other
    blocks = F.ceil(F.col("n") / (2 * node_size))
    own, other = F.pmod(F.xxhash64("cid"), blocks), F.col("other")
    dealt = (large.join(marks, "cid")
                  .select("path", "cid", "comp", "sketch", own.alias("own"),
                          F.explode(F.sequence(whole, blocks - 1)).alias("other"))
                  .select("path", F.least("own", other).alias("x"), F.greatest("own", other).alias("y"),
                          "cid", "comp", "sketch"))
    found = stored(found.union(_promising(dealt, ["path", "x", "y"], n_tokens, likely)), "promising")
    missing = found.select("cid").distinct().join(full.select("cid"), "cid", "left_anti")
    full = full.union(_full_sets(missing, classes, docs, id_col, text_col, shingle))
    more = stored(_links_within(found.join(full, "cid"), ["path", "x", "y"], percent).distinct(), "links")
    if not more.isEmpty():
        comps = stored(connected_components(
            more.union(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))), "components")

    # 3. smallest id of each component, for classes and then rows
    named = (classes.select("cid", "key", "rep").join(comps.withColumnRenamed("node", "cid"), "cid", "left")
                    .withColumn("c", F.coalesce("component", "cid")))
    least = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    by_key = named.join(least, "c").select("key", "component_id", F.col("c").alias("component"))
    return (rows.select("id", "th", "n", "key").join(by_key, "key", "left")
                .select(F.col("id").alias(id_col), "th", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                        "component"))
