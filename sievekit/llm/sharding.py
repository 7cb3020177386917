"""Balanced shards of atomic groups by minimax contiguous partition.

Rows with equal texts form a group that stays together. The order of the groups:
first those larger than a shard's fair share, fewer than there are shards, by
falling size; then the others by the hash of their text. The smallest capacity for which a greedy left-to-right
fill needs no more than the wanted shards is found by binary search, and the
order is cut there. The driver never sees the groups: it holds sums over hash
prefixes, finds in which prefixes a cut can still lie, and splits only those,
until each holds one group; a few thousand sums a round, at any input size. The
result is exactly the minimax partition of the ordered groups.

Among all cuts that keep the optimal capacity those nearest to even shares are
taken, so no shard is left short.

Null and empty texts are one group of rows without bytes. Fewer groups than
shards leave shards empty. An empty table gives an empty result. Rows that
repeat are rows like any other.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import stored

FIRST_BITS = 12                 # hash prefix of the first round: 4096 sums
MORE_BITS = 4                   # further bits of the prefixes split in a round
SLOT_BUCKETS = 1024             # per shard, for numbering rows without one task a shard


class Prefixes:
    """Ordered (start key, size, groups, bits) atoms and their running sums."""

    def __init__(self, atoms):
        self.atoms = sorted(atoms)
        self.cum = [0, *accumulate(a[1] for a in self.atoms)]

    def greedy(self, capacity: int, parts: int) -> list[int] | None:
        """End positions of a left-to-right fill, or None if it needs more
        than ``parts``."""
        at, ends = 0, []
        for _ in range(parts):
            at = bisect_right(self.cum, self.cum[at] + capacity) - 1
            ends.append(at)
        return ends if at == len(self.atoms) else None

    def capacity(self, parts: int) -> int:
        """Smallest feasible capacity."""
        low, high = -(-self.cum[-1] // parts), self.cum[-1]
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, parts) is None:
                low = mid + 1
            else:
                high = mid
        return low

    def undecided(self, parts: int) -> list[tuple]:
        """Atoms of several groups in which a cut can lie."""
        most, total = self.capacity(parts), self.cum[-1]
        found = set()
        for j in range(1, parts):
            low, high = max(0, total - (parts - j) * most), min(total, j * most)
            first = max(0, bisect_left(self.cum, low) - 1)
            last = min(len(self.atoms) - 1, bisect_right(self.cum, high))
            found.update(i for i in range(first, last + 1) if self.atoms[i][2] > 1 and self.atoms[i][3] < 64)
        return [self.atoms[i] for i in sorted(found)]

    def cuts(self, parts: int) -> list[int]:
        """Positions of the parts - 1 cuts: feasible at the optimal capacity,
        each as near as possible to an even share of what is left."""
        most, n, total = self.capacity(parts), len(self.atoms), self.cum[-1]
        earliest, at = [n], n           # from the right: where the last j parts may begin at the earliest
        for _ in range(parts):
            at = bisect_left(self.cum, max(0, self.cum[at] - most))
            earliest.append(at)
        out, at = [], 0
        for j in range(1, parts):
            low = max(min(at + 1, n), earliest[parts - j])      # no empty shard while there are groups
            high = bisect_right(self.cum, self.cum[at] + most) - 1
            want = self.cum[at] + (total - self.cum[at]) / (parts - j + 1)
            near = bisect_left(self.cum, want)
            if near > 0 and (near > n or want - self.cum[near - 1] <= self.cum[near] - want):
                near -= 1
            at = min(max(near, low), high)
            out.append(at)
        return out


def _sums(groups: DataFrame, bits: int) -> list[tuple]:
    prefix = F.shiftright("g", 64 - bits)
    rows = groups.groupBy(prefix.alias("p")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return [(r.p << (64 - bits), int(r["size"]), r.n, bits) for r in rows.collect()]


def plan(groups: DataFrame, shards: int) -> tuple[dict[int, int], int, list[int]]:
    """``groups`` has ``g`` (long key) and ``size``. Returns the shard of each
    group larger than the fair share, and the others' first shard and the
    ascending first keys of the shards after it."""
    total = groups.agg(F.sum("size")).first()[0]
    if not total:
        return {}, 0, []
    large = [(r.g, int(r["size"])) for r in groups.orderBy(F.desc("size"), "g").limit(shards).collect()
             if int(r["size"]) * shards > int(total)]
    rest = groups.where(~F.col("g").isin([g for g, _ in large])) if large else groups
    # keys below those of any hash put the large ones first
    first = [(i - len(large) - (1 << 63), size, 1, 64) for i, (_, size) in enumerate(large)]
    order = Prefixes(first + _sums(rest, FIRST_BITS))
    while todo := order.undecided(shards):
        out = set(todo)
        fresh = []
        for bits in sorted({a[3] for a in todo}):
            prefixes = [a[0] >> (64 - bits) for a in todo if a[3] == bits]
            inside = rest.where(F.shiftright("g", 64 - bits).isin(prefixes))
            fresh += _sums(inside, min(64, bits + MORE_BITS))
        order = Prefixes([a for a in order.atoms if a not in out] + fresh)
    cuts, n, end = order.cuts(shards), len(large), (1 << 63) - 1
    keys = [a[0] for a in order.atoms] + [end]
    return ({g: sum(c <= i for c in cuts) for i, (g, _) in enumerate(large)}, sum(c <= n for c in cuts),
            [keys[c] for c in cuts if c > n])


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          row_bytes: int = 8) -> DataFrame:
    """Per row: ``id_col``, ``size``, ``text_crc32``, ``shard``, ``slot``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(F.col(id_col).alias("id"),
                              (F.octet_length(text) + row_bytes).cast("long").alias("size"),
                              F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("g")), "sized")
    groups = stored(rows.groupBy("g").agg(F.sum("size").alias("size")), "groups")
    large, least, cuts = plan(groups, shards)
    number = sum([(F.col("g") >= c).cast("int") for c in cuts], F.lit(least))
    for key, own in large.items():
        number = F.when(F.col("g") == key, own).otherwise(number)
    placed = (rows.withColumn("shard", number.cast("int"))
                  .withColumn("bucket", F.pmod(F.xxhash64("id", "g"), F.lit(SLOT_BUCKETS)).cast("int")))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most shards * SLOT_BUCKETS rows
    offsets = (placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
                     .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "g", "crc")
    return (placed.withColumn("n", F.row_number().over(inside) - 1)
                  .join(F.broadcast(offsets), ["shard", "bucket"])
                  .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                          (F.col("offset") + F.col("n")).cast("long").alias("slot")))
