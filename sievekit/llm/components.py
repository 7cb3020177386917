"""Connected components by alternating large and small stars.

Every round links each node's larger neighbours to the smallest node it sees,
then its smaller ones; the edges of a component shrink to a star around its
smallest node in a logarithmic number of rounds. Edges are written to the
shared work folder each round. A node with very many neighbours is aggregated
before the shuffle and split by the join's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = (edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large
            else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node that is not
    its component's smallest. ``edges`` has long columns ``a``, ``b``."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = stored(_star(_star(now, True), False), "links")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
