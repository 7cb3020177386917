"""Conversation structure repair on a suffix-shared automaton.

Every turn is one symbol: its role's initial and its first fault (blank,
duplicate, truncated). For the cheapest repair only some of that counts (a blank
or repeated turn must go whatever its role), so a conversation becomes a short
signature, and equal signatures are one row from then on.

Distinct signatures, reversed, are range-partitioned and sorted: neighbours
share their longest common beginning, that is, conversations share their ends.
Each node of the automaton is a suffix; it is made once, when the first
signature with that suffix passes, and holds for every grammar state the cost to
go and the edit of the least audit. A signature that follows reuses the nodes of
the common suffix and adds only its own. Suffixes are shared across all
conversations; only at a border between two partitions a node is made twice.

The repaired text is hashed as a stream of the conversation's rows in order, so
no conversation is held in memory.

Edits: K keep (0), R rerole to user or assistant (2), D delete (3), I insert an
empty user or assistant turn (2); a truncated turn that stays adds 1. The result
must be an optional system turn and then user-assistant pairs, or nothing; the
grammar fixes whom R and I name. Among the cheapest the audit that is least in
ASCII order (D < I < K < R).

Null role or text is one space, so a null text is blank. Rows with the same turn
are ordered by role, then by a hash of the text; a null turn comes first. A null conversation id is
a conversation of its own. An empty table gives no rows. Further columns are
ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import stored

SPACE = r"[\x20\x09-\x0D]"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: symbols: first fault (none, truncated, duplicate, blank) by role initial (s, u, a, other)
FAULTS, INITIALS = "otdb", "sua"
#: grammar states: nothing yet, after the system turn, after a user turn, after a pair
START, SYSTEM, USER, PAIR = range(4)
MUST_GO = "x"


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``c``, ``t``, ``r``, ``x`` of the rows after the seeded damage: of
    crc32(``conv:turn``) % 20, 0 drops a row, 1 empties its text, 2 removes its
    ``.!?``, 3 repeats it, 4 makes its role user."""
    space = F.lit(" ")
    rows = conversations.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"),
                                F.coalesce(F.col(role_col), space).alias("r"), F.coalesce(F.col(text_col), space).alias("x"))
    key = F.concat_ws(":", F.coalesce(F.col("c").cast("string"), space), F.coalesce(F.col("t").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    return (rows.withColumn("kind", kind).where("kind <> 0")
                .withColumn("x", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("x", "[.!?]", ""))
                            .otherwise(F.col("x")))
                .withColumn("r", F.when(F.col("kind") == 4, "user").otherwise(F.col("r")))
                .withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("kind") == 3, 1).otherwise(0))))
                .drop("kind"))


def symbols(rows: DataFrame) -> DataFrame:
    """Per row ``c``, ``t``, ``r``, its hash ``h``, ``copy`` and ``symbol``: what the repair looks at, without the text."""
    bare = F.regexp_replace("x", SPACE + "+$", "")
    slim = rows.select("c", "t", "r", "copy", F.xxhash64("x").alias("h"), F.xxhash64(F.lit("second"), "x").alias("h2"),
                       (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    same = Window.partitionBy("c", "r", "h", "h2").orderBy(F.col("t").asc_nulls_first(), "copy")
    fault = (F.when(F.col("blank"), 3).when(F.row_number().over(same) > 1, 2).when(F.col("cut"), 1).otherwise(0))
    initial = F.substring("r", 1, 1)
    who = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return slim.select("c", "t", "r", "h", "copy", F.chr(F.lit(97) + 4 * fault + who).alias("symbol"))


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation ``c``: ``signature`` (a symbol per turn, in order) and ``gaps``."""
    gaps = F.coalesce(F.max("t") - F.min("t") + 1 - F.count_distinct("t"), F.lit(0))
    first = F.col("t").isNotNull().alias("known")
    turn = F.struct(first, "t", "r", "h", "copy", "symbol")
    out = rows.groupBy("c").agg(F.sort_array(F.collect_list(turn)).alias("turns"), gaps.cast("long").alias("gaps"))
    return out.select("c", F.array_join(F.col("turns.symbol"), "").alias("signature"), "gaps")


def core(signature: Column) -> Column:
    """The signature as the repair sees it: turns that must go are one symbol."""
    return F.regexp_replace(signature, "[i-p]", MUST_GO)


class SuffixAutomaton:
    """Nodes of the suffixes of the signature last seen, first the empty one.
    A node is, per grammar state, (cost to go, edit)."""

    def __init__(self):
        end = self.with_inserts([(0, ""), None, None, (0, "")])
        self.nodes, self.symbols = [end], ""

    @staticmethod
    def target(state: int) -> int:
        return PAIR if state == USER else USER

    def with_inserts(self, best: list) -> list:
        """Costs to go when turns may be inserted first: two rounds reach every state from the others."""
        for _ in range(3):
            for state in range(4):
                via = best[self.target(state)]
                if via is not None:
                    offer = (via[0] + 2, "I")
                    if best[state] is None or offer < best[state]:
                        best[state] = offer
        return best

    def node(self, symbol: str, rest: list) -> list:
        best = []
        for state in range(4):
            offers = [(3 + rest[state][0], "D")]
            if symbol != MUST_GO:
                cut, who = divmod(ord(symbol) - 97, 4)
                after = {0: SYSTEM if state == START else None, 1: USER if state != USER else None,
                         2: PAIR if state == USER else None}.get(who)
                if after is not None:
                    offers.append((cut + rest[after][0], "K"))
                offers.append((2 + cut + rest[self.target(state)][0], "R"))
            best.append(min(offers))
        return self.with_inserts(best)

    def repair(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of a reversed signature; nodes of the suffix that it shares with the one before are reused."""
        shared, most = 0, min(len(backwards), len(self.symbols))
        while shared < most and backwards[shared] == self.symbols[shared]:
            shared += 1
        del self.nodes[shared + 1:]
        for symbol in backwards[shared:]:
            self.nodes.append(self.node(symbol, self.nodes[-1]))
        self.symbols = backwards
        state, at, audit = START, len(backwards), []
        while True:
            edit = self.nodes[at][state][1]
            if not edit:
                break
            audit.append(edit)
            if edit == "K":
                state = {0: SYSTEM, 1: USER, 2: PAIR}[(ord(backwards[at - 1]) - 97) % 4]
            elif edit != "D":
                state = self.target(state)
            at -= edit != "I"
        return self.nodes[len(backwards)][START][0], "".join(audit)


def audits(distinct: DataFrame) -> DataFrame:
    """``core``, ``cost`` and ``audit`` of every row of ``distinct`` (``core``)."""
    def run(batches):
        automaton = SuffixAutomaton()
        for batch in batches:
            found = [automaton.repair(s) for s in batch.column("backwards").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("core"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                ["core", "cost", "audit"])

    ordered = (distinct.withColumn("backwards", F.reverse("core")).repartitionByRange("backwards")
                       .sortWithinPartitions("backwards"))
    return ordered.mapInArrow(run, "core string, cost long, audit string")


def repaired_hashes(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """``c`` and the SHA-256 of its repaired ``role:text`` lines. ``audit``: ``c``, ``audit``."""
    c = audit.schema["c"].dataType.simpleString()

    def run(batches):
        out, state = [], {}

        def emit(kind):         # the inserts due, then the edit of the row at hand
            audit, at = state["audit"], state["at"]
            while at < len(audit) and audit[at] == "I":
                line("", True)
                at += 1
            state["at"] = at + 1
            return audit[at] if kind == "row" and at < len(audit) else ""

        def line(text, named, role=None):
            if named:
                role = "assistant" if state["last"] == "u" else "user"
            state["sha"].update(("\n" if state["any"] else "").encode() + f"{role}:{text}".encode())
            state["any"], state["last"] = True, role[:1]

        def close():
            if state:
                emit("end")
                out.append((state["c"], state["sha"].hexdigest()))

        def rows_out():
            batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], kind), pa.array([r[1] for r in out], pa.string())],
                                               ["c", "sha"])
            out.clear()
            return batch

        kind = None
        for batch in batches:
            kind = batch.schema.field("c").type
            for c, audit, role, text in zip(*(batch.column(n).to_pylist() for n in ("c", "audit", "r", "x"))):
                if audit is not None:
                    close()
                    state.update(c=c, audit=audit, at=0, any=False, last="", sha=hashlib.sha256())
                    continue
                edit = emit("row")
                if edit == "K":
                    line(text, False, role)
                elif edit == "R":
                    line(text, True)
            yield rows_out()
        close()
        if out:
            yield rows_out()

    heads = audit.select("c", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("t"), F.lit(0).alias("copy"),
                         F.lit(0).cast("long").alias("h"), "audit", F.lit("").alias("r"), F.lit("").alias("x"))
    body = rows.select("c", F.lit(1).alias("kind"), "t", "copy", F.xxhash64("x").alias("h"),
                       F.lit(None).cast("string").alias("audit"), "r", "x")
    ordered = heads.unionByName(body).repartition("c").sortWithinPartitions(
        "c", "kind", F.col("t").asc_nulls_first(), "r", "h", "copy").select("c", "audit", "r", "x")
    return ordered.mapInArrow(run, f"c {c}, sha string")


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Audit of conversations given as rows (``c``, ``t``, ``r``, ``x``, ``copy``) and all their ids ``c``."""
    signed = stored(signatures(symbols(rows)).withColumn("core", core(F.col("signature"))), "signatures")
    found = signed.join(audits(signed.select("core").distinct()), "core")
    found = stored(found.select("c", "signature", "gaps", "cost", "audit"), "audits")
    hashes = repaired_hashes(rows, found.select("c", "audit"))
    who = F.translate("signature", "abcdefghijklmnop", "suao" * 4)

    def count(first: str) -> Column:
        return F.char_length(F.regexp_replace("signature", f"[^{first}]", "")).cast("long")

    pairs = F.aggregate(F.sequence(F.lit(2), F.greatest(F.char_length(who), F.lit(2))), F.lit(0).cast("long"), lambda n, i: n + F.when(
        F.substring(who, i - 1, F.lit(2)).isin("su", "ua", "au"), 0).otherwise(1))
    out = ids.distinct().join(
        found.select(F.col("c").alias("c_"), "gaps", count("m-p").alias("blank"), count("i-l").alias("duplicate"),
                     count("e-h").alias("truncated"),
                     F.when(F.char_length(who) > 1, pairs).otherwise(0).alias("illegal"), "cost", "audit"),
        F.col("c").eqNullSafe(F.col("c_")), "left").drop("c_")
    out = out.join(hashes.select(F.col("c").alias("c_"), "sha"), F.col("c").eqNullSafe(F.col("c_")), "left")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("c").alias("conv_id"), *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in longs],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(EMPTY_SHA)).alias("repaired_sha256"))
