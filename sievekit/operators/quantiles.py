"""Exact and approximate quantiles without one task holding a column.

``percentile`` (exact) keeps a value->count map of the whole group in one
task, which does not scale for a global aggregate. The exact mode here is a
distributed selection:

The columns are stacked into a long (ci, v) stream inside the scan stage, so
every pass has the same small plan however many columns are asked for.

1. one pass: per column ``count`` and a ``percentile_approx`` sketch bracket
   around each wanted rank (rank error <= n/accuracy, bounded memory);
2. one pass: the bracket table (one literal row per wanted quantile) gives
   exact counts below / inside each bracket and an estimate of the distinct
   values inside; a bracket that is still wide is re-sketched on its own rows
   with a fixed grid (each round shrinks it ~1000x);
3. one pass: the rows inside the brackets become a (target, value) -> count
   histogram; a window per target over that small histogram finds the values
   at the wanted ranks.

Only per-target scalars reach the driver. Interpolation is linear between the
order statistics at floor/ceil of (n-1)q (pandas' default), written as
lo*(1-d) + hi*d.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievekit.functions.names import col

DEFAULT_ACCURACY = 10_000
FINAL_MAX_DISTINCT = 1_000_000


def clean_double(c) -> Column:
    """Numeric column as double with NaN folded to null (pandas 'missing')."""
    x = (col(c) if isinstance(c, str) else c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              method: str = "exact", accuracy: int = DEFAULT_ACCURACY,
              final_max_distinct: int = FINAL_MAX_DISTINCT) -> dict[str, list[float | None]]:
    """{col: [q(p) for p in probs]} over non-null values of each column."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    long = _long(df, cols)
    if method == "approx":
        rows = long.groupBy("ci").agg(F.percentile_approx("v", probs, accuracy).alias("q")).collect()
        out = {c: [None] * len(probs) for c in cols}
        for r in rows:
            out[cols[r["ci"]]] = list(r["q"])
        return out
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")
    return _exact(df.sparkSession, long, cols, probs, accuracy, final_max_distinct)


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(ci, v) rows for the non-null values of every column (narrow, in-stage)."""
    arr = F.array(*[F.struct(F.lit(i).alias("ci"), clean_double(c).alias("v"))
                    for i, c in enumerate(cols)])
    return df.select(F.inline(arr)).where(F.col("v").isNotNull())


GRID = 1000


def _exact(spark, long, cols, probs, accuracy, final_max_distinct):
    delta = 2.0 / accuracy
    br = []
    for q in probs:
        br += [max(0.0, q - delta), min(1.0, q + delta)]
    first = {r["ci"]: r for r in long.groupBy("ci").agg(
        F.count("v").alias("n"), F.percentile_approx("v", br, accuracy).alias("b")).collect()}

    targets = []
    for ci in range(len(cols)):
        r = first.get(ci)
        if r is None or not r["n"]:
            continue
        n = r["n"]
        # the bracket q +- 2/accuracy spans >= 4 ranks only when n >= 2*accuracy
        small = n < 2 * accuracy and n <= final_max_distinct
        for j, q in enumerate(probs):
            pos = (n - 1) * q
            k0 = int(math.floor(pos))
            frac = pos - k0
            # a small column's whole histogram is small: no bracket needed
            # (a sketch bracket narrower than one rank could miss)
            lo, hi = (-math.inf, math.inf) if small else (r["b"][2 * j], r["b"][2 * j + 1])
            targets.append({"ci": ci, "j": j, "k0": k0, "k1": min(k0 + 1, n - 1) if frac else k0,
                            "frac": frac, "lo": lo, "hi": hi, "below": 0, "inside": n})
    if not targets:
        return {c: [None] * len(probs) for c in cols}

    # A sketch bracket holds at most ~6n/accuracy rows, so when that is small
    # enough the exact counts and the selection run as one job.
    max_n = max(r["n"] for r in first.values())
    if 6.0 * max_n / accuracy <= final_max_distinct:
        values = _select_in_brackets(spark, long, targets, fused=True)
        if all((t, 0) in values and (t, 1) in values for t in range(len(targets))):
            return _interpolate(cols, probs, targets, values)

    while True:             # every round narrows each wide bracket about a thousandfold
        j = _with_targets(long, targets)
        inb = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
        st = {r["t"]: r for r in j.groupBy("t").agg(
            F.count_if(F.col("v") < F.col("lo")).alias("below"),
            F.count_if(inb).alias("inside"),
            F.approx_count_distinct(F.when(inb, F.col("v"))).alias("d")).collect()}
        wide = []
        for t, g in enumerate(targets):
            r = st.get(t)
            g["below"], g["inside"] = (r["below"], r["inside"]) if r else (0, 0)
            if g["below"] > g["k0"] or g["below"] + g["inside"] < g["k1"] + 1:
                g["lo"], g["hi"] = -math.inf, math.inf      # sketch missed: whole range
                wide.append(t)
            elif r["d"] > final_max_distinct:
                wide.append(t)
        if not wide:
            break
        # re-sketch the wide brackets on their own rows with a fixed grid
        grid = [i / GRID for i in range(GRID + 1)]
        js = _with_targets(long, [targets[t] for t in wide], ids=wide).where(
            (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        sk = {r["t"]: r["g"] for r in js.groupBy("t").agg(
            F.percentile_approx("v", grid, accuracy).alias("g")).collect()}
        for t in wide:
            g, gv = targets[t], sk.get(t)
            if gv is None:
                continue
            n_in = max(1, g["inside"] if g["lo"] != -math.inf else g["inside"])
            p0 = (g["k0"] - g["below"]) / n_in - delta
            p1 = (g["k1"] - g["below"] + 1) / n_in + delta
            i0 = max(0, int(math.floor(p0 * GRID)) - 1)
            i1 = min(GRID, int(math.ceil(p1 * GRID)) + 1)
            if (gv[i0], gv[i1]) == (g["lo"], g["hi"]):
                raise RuntimeError("a quantile's bracket can't be narrowed; raise final_max_distinct")
            g["lo"], g["hi"] = gv[i0], gv[i1]

    values = _select_in_brackets(spark, long, targets)
    return _interpolate(cols, probs, targets, values)


def _interpolate(cols, probs, targets, values):
    out = {c: [None] * len(probs) for c in cols}
    for t, g in enumerate(targets):
        v0, v1 = values.get((t, 0)), values.get((t, 1))
        out[cols[g["ci"]]][g["j"]] = v0 * (1.0 - g["frac"]) + v1 * g["frac"] if g["frac"] else v0
    return out


def _with_targets(long: DataFrame, targets, ids=None) -> DataFrame:
    """(ci, v) rows joined with their column's brackets (t, lo, hi, r0, r1).

    The bracket table is a handful of scalars per wanted quantile, so it is a
    literal map ci -> array<struct> expanded by ``inline``: a narrow generate,
    no join and no broadcast job."""
    ids = list(ids) if ids is not None else list(range(len(targets)))
    by_ci: dict[int, list] = {}
    for t, g in zip(ids, targets):
        by_ci.setdefault(g["ci"], []).append(F.struct(
            F.lit(t).cast("int").alias("t"), F.lit(float(g["lo"])).cast("double").alias("lo"),
            F.lit(float(g["hi"])).cast("double").alias("hi"),
            F.lit(g["k0"] - g["below"]).cast("long").alias("r0"),
            F.lit(g["k1"] - g["below"]).cast("long").alias("r1")))
    m = F.create_map(*[x for ci, lst in by_ci.items() for x in (F.lit(ci), F.array(*lst))])
    return long.select("v", F.inline(F.try_element_at(m, F.col("ci"))))


def _select_in_brackets(spark, long, targets, fused: bool = False):
    """Values at ranks r0, r1 inside each (small) bracket: histogram + window.

    ``fused``: the counts below each bracket are not known yet. Rows below a
    bracket collapse (map-side) into one 'below' bucket per target that sorts
    first, so the window's running count is the absolute rank."""
    j = _with_targets(long, targets)
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    if fused:
        below = v < lo
        keep = below | (v <= hi)
        j = j.where(keep).select("t", "r0", "r1", below.alias("b"),
                                 F.when(below, F.lit(None)).otherwise(v).alias("v"))
    else:
        j = j.where((v >= lo) & (v <= hi)).select("t", "r0", "r1", F.lit(False).alias("b"), "v")
    hist = j.groupBy("t", "r0", "r1", "b", "v").count()
    w = (Window.partitionBy("t").orderBy(F.desc("b"), F.asc("v"))
               .rowsBetween(Window.unboundedPreceding, 0))
    hist = hist.withColumn("cum", F.sum("count").over(w))
    start = F.col("cum") - F.col("count")
    hit0 = ~F.col("b") & (start <= F.col("r0")) & (F.col("r0") < F.col("cum"))
    hit1 = ~F.col("b") & (start <= F.col("r1")) & (F.col("r1") < F.col("cum"))
    out = {}
    for row in hist.where(hit0 | hit1).select("t", "v", hit0.alias("h0"), hit1.alias("h1")).collect():
        if row["h0"]:
            out[(row["t"], 0)] = row["v"]
        if row["h1"]:
            out[(row["t"], 1)] = row["v"]
    return out
