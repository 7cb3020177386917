"""Prefix trie of conversations by fixed-length block hashing.

A conversation is a sequence of turns; a turn is known by two 64-bit hashes of
(role, text) and the code points of its text, so no text is shuffled. The
identity of a prefix is the XOR of hash(position, turn) over its turns: it can
be summed in any order, so prefixes are running sums in chunks and a
conversation of any length is never one task's.

1. Turns are collected in blocks of ``BLOCK`` consecutive ones. Conversations
   are grouped by successive blocks: one row per (prefix before, block), with
   the members' number, smallest id and total length, aggregated before the
   shuffle.
2. Where one block alone follows a prefix all its members share every turn
   boundary inside it: the turns are its nodes as they are. Only where siblings
   diverge are the distinct blocks opened and their turn prefixes grouped.
3. Sums over subtrees need no walk. A node belongs to its smallest member; the
   nodes of one member are a tail of its path. So the text of the distinct nodes
   below a node is the sum of its members' tails, the text of all members' turns
   below it the sum of their lengths less the common prefix, and the leaves are
   the members that own one. Each is a sum over block groups.

Rows with the same conversation and turn are ordered by role, then by hash; a
null turn comes first; null role or text is empty. Rows without a conversation
id belong to none and are left out. Repeated rows are turns like any other. An
empty table has no nodes, not even a root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import stored

BLOCK = 4
#: turns (by number) or blocks of one conversation that a window task orders at once
CHUNK = 4096
HEAD = 5        # a conversation starts with at most so many turns of another


def _running(rows: DataFrame, chunk: Column, order: list[Column], measures: dict[str, tuple]) -> DataFrame:
    """Adds running aggregates along each conversation ``c``, current row
    included. ``measures``: name -> (aggregate of a column, its column, how two
    results combine). Chunks are summed first, so a conversation with very many
    rows is ordered by many tasks."""
    rows = rows.withColumn("_chunk", chunk)
    inside = Window.partitionBy("c", "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("c").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("c", "_chunk").agg(*[agg(v).alias(n) for n, (agg, v, _) in measures.items()])
    earlier = totals.select("c", "_chunk", *[F.coalesce(agg(F.col(n)).over(before), F.lit(0)).alias("_b_" + n)
                                             for n, (agg, _, _) in measures.items()])
    out = rows.withColumns({n: agg(v).over(inside) for n, (agg, v, _) in measures.items()}).join(earlier, ["c", "_chunk"])
    return (out.withColumns({n: join(F.col(n), F.col("_b_" + n)) for n, (_, _, join) in measures.items()})
               .drop("_chunk", *["_b_" + n for n in measures]))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Per row: ``c``, ``pos`` (from 0), the turn's hashes ``d1``, ``d2`` and ``chars``."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).alias("t"), role.alias("r"),
        F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit("second"), text, role).alias("d2"),
        F.char_length(text).cast("long").alias("chars"))
    chunk = F.coalesce(F.floor(F.col("t") / CHUNK).cast("long"), F.lit(-(1 << 62)))
    order = [F.col("t").asc_nulls_first(), F.col("r"), F.col("d1"), F.col("d2")]
    numbered = _running(rows, chunk, order, {"pos": (F.sum, F.lit(1).cast("long"), _plus)})
    return numbered.select("c", (F.col("pos") - 1).alias("pos"), "d1", "d2", "chars")


def head_length(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary")) % (HEAD + 1)


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (as ``turns``), and all ids ``c``: the
    first h turns of conversation c - c % 100, then c's own after its first h."""
    lead = F.col("c") - F.col("c") % 100
    rows = stored(rows, "turns")
    heads = (rows.where((F.col("c") % 100 == 0) & (F.col("pos") < HEAD)).groupBy(F.col("c").alias("lead"))
                 .agg(F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "chars"))).alias("head")))
    taken = F.least(F.coalesce(F.size("head"), F.lit(0)), head_length(F.col("c"))).cast("long")
    ids = rows.select("c").distinct()
    own = (rows.where(F.col("pos") >= head_length(F.col("c"))).withColumn("lead", lead)
               .join(heads.select("lead", F.expr("transform(head, x -> 0)").alias("head")), "lead", "left")
               .select("c", (F.col("pos") - head_length(F.col("c")) + taken).alias("pos"), "d1", "d2", "chars"))
    given = (ids.withColumn("lead", lead).join(heads, "lead")
                .select("c", F.explode(F.slice("head", F.lit(1), taken.cast("int"))).alias("x")).select("c", "x.*"))
    return own.unionByName(given), ids


def blocks(rows: DataFrame) -> DataFrame:
    """Per conversation and block ``k``: prefix identity before (``p1``, ``p2``)
    and after it (``q1``, ``q2``), code points before it (``pre``) and the
    block's turns (``y1``, ``y2``, ``chars``)."""
    made = (rows.select("c", (F.col("pos") / BLOCK).cast("long").alias("k"), F.struct(
                "pos", F.xxhash64("pos", "d1").alias("y1"), F.xxhash64("pos", "d2").alias("y2"), "chars").alias("y"))
            .groupBy("c", "k").agg(F.sort_array(F.collect_list("y")).alias("turns"), F.bit_xor("y.y1").alias("b1"),
                                   F.bit_xor("y.y2").alias("b2"), F.sum("y.chars").alias("bc")))
    run = _running(made, (F.col("k") / CHUNK).cast("long"), [F.col("k")],
                   {"q1": (F.bit_xor, F.col("b1"), _xor), "q2": (F.bit_xor, F.col("b2"), _xor),
                    "upto": (F.sum, F.col("bc"), _plus)})
    return run.select("c", "k", F.col("q1").bitwiseXOR(F.col("b1")).alias("p1"),
                      F.col("q2").bitwiseXOR(F.col("b2")).alias("p2"), "q1", "q2",
                      (F.col("upto") - F.col("bc")).alias("pre"), "upto", "turns")


def _opened(groups: DataFrame) -> DataFrame:
    """Block groups with one row per turn: the turn prefix's ``depth`` and
    identity (``x1``, ``x2``), its parent's, ``chars`` and code points before."""
    at = groups.select("*", F.posexplode("turns").alias("j", "y"))
    upto = F.slice("turns", F.lit(1), F.col("j") + 1)
    x1 = F.aggregate(upto, F.col("p1"), lambda a, t: a.bitwiseXOR(t["y1"]))
    x2 = F.aggregate(upto, F.col("p2"), lambda a, t: a.bitwiseXOR(t["y2"]))
    before = F.aggregate(F.slice("turns", F.lit(1), F.col("j")), F.col("pre"), lambda a, t: a + t["chars"])
    return (at.withColumns({"x1": x1, "x2": x2, "before": before, "depth": F.col("k") * BLOCK + F.col("j") + 1,
                            "chars": F.col("y.chars")})
              .withColumns({"u1": F.col("x1").bitwiseXOR(F.col("y.y1")), "u2": F.col("x2").bitwiseXOR(F.col("y.y2"))})
              .drop("turns", "y", "j"))


def _ends(paths: DataFrame) -> DataFrame:
    """Per node the SHA-256 of the ids ending there, in order, comma-joined.
    The ids are sorted and streamed into the hash, whatever their number."""
    def run(batches):
        now, state = None, None
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for depth, x1, x2, c in zip(*columns):
                if (depth, x1, x2) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (depth, x1, x2), hashlib.sha256(str(c).encode())
                else:
                    state.update(f",{c}".encode())
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(
                (("depth", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64()), ("ends_sha256", pa.string())))})
        if now is not None:
            yield pa.RecordBatch.from_pydict({"depth": [now[0]], "x1": [now[1]], "x2": [now[2]],
                                              "ends_sha256": [state.hexdigest()]})

    ordered = paths.select("depth", "x1", "x2", "c").repartition("depth", "x1", "x2").sortWithinPartitions(
        "depth", "x1", "x2", "c")
    return ordered.mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie of conversations given as ``turns`` (``c``, ``pos``, ``d1``,
    ``d2``, ``chars``) and of all their ``ids``, turnless ones too. Per node:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    made = stored(blocks(rows), "blocks")
    last = made.groupBy("c").agg(F.max(F.struct("k", F.size("turns").alias("n"), "q1", "q2", "upto")).alias("e"))
    paths = stored(ids.distinct().join(last, "c", "left").select(
        "c", F.coalesce(F.col("e.k") * BLOCK + F.col("e.n"), F.lit(0)).alias("depth"),
        F.coalesce("e.q1", F.lit(0)).alias("x1"), F.coalesce("e.q2", F.lit(0)).alias("x2"),
        F.coalesce("e.upto", F.lit(0)).alias("total")), "paths")

    # conversations by successive blocks, members summed up
    members = made.join(paths.select("c", "total"), "c")
    groups = stored(members.groupBy("k", "p1", "p2", "q1", "q2").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("least"), F.sum("total").alias("total"),
        F.any_value("pre").alias("pre"), F.any_value("turns").alias("turns")), "groups")
    fields = [c for c in groups.columns if c not in ("k", "p1", "p2")]
    alone = (groups.groupBy("k", "p1", "p2").agg(F.count(F.lit(1)).alias("siblings"),
                                                 F.any_value(F.struct(*fields)).alias("g"))
                   .where("siblings = 1").select("k", "p1", "p2", "g.*"))
    diverging = groups.join(alone.select("k", "p1", "p2"), ["k", "p1", "p2"], "left_anti")
    opened = stored(_opened(alone).withColumn("shared", F.lit(True)).unionByName(
        _opened(diverging).withColumn("shared", F.lit(False))), "opened")
    node = ["depth", "x1", "x2"]
    measures = ["n", "least", "total", "before", "chars", "u1", "u2"]
    refined = opened.where("NOT shared").groupBy(*node).agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("total").alias("total"),
        *[F.any_value(c).alias(c) for c in measures[3:]])
    nodes = stored(opened.where("shared").select(*node, *measures).unionByName(refined), "nodes")

    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("x1"), F.col("u2").alias("x2")
                             ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                   "nodes")

    # each member's own tail: text from its first own node on, and its leaf
    own = (nodes.groupBy(F.col("least").alias("c"))
                .agg(F.min(F.struct("depth", "before")).alias("o"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
                .join(paths.select("c", "total"), "c")
                .select("c", (F.col("total") - F.col("o.before")).alias("tail"), "leaf", F.col("total").alias("whole")))
    own = stored(own, "tails")
    tails = made.select("c", "k", "q1", "q2").join(own, "c").groupBy("k", "q1", "q2").agg(
        F.sum("tail").alias("tails"), F.sum("leaf").alias("leaves"))
    below = opened.select(*node, "k", "q1", "q2").join(tails, ["k", "q1", "q2"]).groupBy(*node).agg(
        F.sum("tails").alias("tails"), F.sum("leaves").alias("n_leaves"))
    distinct = F.col("tails") - F.col("tail") + F.col("whole") - F.col("before")
    saved = F.col("total") - F.col("n") * F.col("before") - distinct

    first, n, total = paths.agg(F.min("c"), F.count(F.lit(1)), F.sum("total")).first()
    all_tails, all_leaves = own.agg(F.sum("tail"), F.sum("leaf")).first()
    tops = nodes.where("depth = 1").count()
    top = rows.sparkSession.createDataFrame(
        [(0, 0, 0, first, None, n, tops, all_leaves or 1, total - (all_tails or 0))] if n else [],
        "depth long, x1 long, x2 long, conv_id long, parent_conv_id long, n_convs long, n_children long,"
        " n_leaves long, saved_tokens long")

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("u1"), F.col("x2").alias("u2"),
                           F.col("least").alias("parent"))
    rest = (nodes.join(below, node).join(own.select(F.col("c").alias("least"), "tail", "whole"), "least")
                 .withColumns({"saved_tokens": saved})
                 .join(parents, ["depth", "u1", "u2"], "left")
                 .select(*node, F.col("least").alias("conv_id"),
                         F.when(F.col("depth") == 1, F.lit(first).cast("long")).otherwise(F.col("parent")).alias("parent_conv_id"),
                         F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens"))
    out = top.unionByName(rest).join(_ends(paths), node, "left")
    return out.select("conv_id", "depth", "parent_conv_id", *[F.col(c).cast("long").alias(c) for c in (
        "n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
