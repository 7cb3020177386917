"""Cleaning (C1-C8): imputation, IQR outliers, duplicates, rules, completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.functions.names import col
from sievekit.operators.profile import numeric_columns
from sievekit.operators.quantiles import clean_double, quantiles


def normalise_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and null are both 'missing' -> null, for numeric columns."""
    cols = list(cols or numeric_columns(df))
    return df.withColumns({c: F.nanvl(col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in cols if df.schema[c].dataType.typeName() in ("double", "float")})


def impute_median(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact"
                  ) -> tuple[DataFrame, dict[str, float]]:
    """Fill nulls of each column that has any with its median (label included).

    One scan finds the columns with nulls; medians come from the distributed
    exact selection (or the sketch with ``method='approx'``). An integer column
    that is filled becomes double: its median may lie between two integers."""
    cols = list(cols or numeric_columns(df))
    row = df.agg(*[F.count_if(clean_double(c).isNull()).alias(f"m{i}")
                   for i, c in enumerate(cols)]).first()
    need = [c for i, c in enumerate(cols) if row[f"m{i}"] > 0]
    med = {c: v[0] for c, v in quantiles(df, need, [0.5], method=method).items()}
    fills = {}
    for c in need:
        if med[c] is None:
            continue
        dt = df.schema[c].dataType
        fills[c] = F.coalesce(clean_double(c), F.lit(med[c])).cast("float" if dt.typeName() == "float" else "double")
    return df.withColumns(fills), med


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact"
               ) -> dict[str, tuple[float, float, float, float]]:
    """{col: (q1, q3, lower, upper)} with lower = q1 - k*IQR, upper = q3 + k*IQR."""
    qs = quantiles(df, cols, [0.25, 0.75], method=method)
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = (None, None, None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


def outlier_condition(c: str, lower: float, upper: float) -> Column:
    """Strictly outside the bounds (null and NaN are not outliers)."""
    x = clean_double(c)
    return (x < F.lit(lower)) | (x > F.lit(upper))


def keep_condition(c: str, lower: float, upper: float) -> Column:
    """lower <= v <= upper on the raw column, so Parquet gets the range as a
    pushed filter. Null fails both sides; NaN (ordered above every number in
    Spark) fails ``<= upper``: both are dropped, as the reference's filter does."""
    x = col(c)
    return (x >= F.lit(lower)) & (x <= F.lit(upper))


def filter_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5,
                    mode: str = "sequential", method: str = "exact",
                    label: str | None = None, count_outliers: bool = True,
                    checkpoint: bool = False) -> tuple[DataFrame, list[dict]]:
    """C3 + C4: drop IQR outliers; returns the filtered frame and a per-column report.

    ``sequential`` (reference): bounds of column i are computed on rows kept by
    columns 1..i-1, so the result depends on the column order.
    ``simultaneous``: all bounds from the input in one pass, one combined filter.
    Bounds are literals in the filter, so they reach the Parquet scan.
    ``count_outliers=False`` skips the C4 count pass (n_outliers is then None).
    ``checkpoint=True`` writes ``df`` once as Parquet to the shared folder of
    ``spark.checkpoint.dir`` first: columns derived by costly expressions (e.g.
    word counts of long texts) are not recomputed by every pass, and the bounds
    still reach the scan; pass only the columns needed.
    """
    cols = [c for c in cols if c != label]
    if checkpoint:
        from sievekit.session import work_dir
        path = work_dir(df.sparkSession, "outliers")
        df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    report = []
    if mode == "simultaneous":
        bounds = iqr_bounds(df, cols, k, method)
        counts = df.agg(*[F.count_if(outlier_condition(c, *bounds[c][2:])).alias(f"o{i}")
                          for i, c in enumerate(cols)]).first() if count_outliers else {}
        cond = F.lit(True)
        for i, c in enumerate(cols):
            q1, q3, lo, hi = bounds[c]
            report.append({"column_name": c, "q1": q1, "q3": q3, "lower": lo, "upper": hi,
                           "n_outliers": counts[f"o{i}"] if count_outliers else None})
            cond = cond & keep_condition(c, lo, hi)
        return df.where(cond), report
    if mode != "sequential":
        raise ValueError("mode must be 'sequential' or 'simultaneous'")
    # No cache: each pass reads only its column (pruned) with the earlier
    # bounds pushed into the Parquet scan, cheaper than caching every column.
    cur = df
    for c in cols:
        q1, q3, lo, hi = iqr_bounds(cur, [c], k, method)[c]
        if lo is None:
            cur = cur.where(F.lit(False))
            report.append({"column_name": c, "q1": None, "q3": None, "lower": None,
                           "upper": None, "n_outliers": 0})
            continue
        n_out = (cur.agg(F.count_if(outlier_condition(c, lo, hi))).first()[0]
                 if count_outliers else None)
        report.append({"column_name": c, "q1": q1, "q3": q3, "lower": lo, "upper": hi,
                       "n_outliers": n_out})
        cur = cur.where(keep_condition(c, lo, hi))
    return cur, report


def drop_exact_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                          order_by: str | None = None, id_col: str | None = None) -> DataFrame:
    """Keep one row per identical row (or per key subset, the first by ``order_by``).

    Whole-row: hash-first (``dedup``): rows with a unique row hash skip the
    shuffle; repeating hash groups are de-duplicated exactly. ``id_col``: rows
    that agree in all other columns are repeats; the one with the lowest id
    stays.
    Key subset: the first row's order value per key, found on a 128-bit hash of
    the key so that long keys are neither sorted nor shuffled twice.
    """
    if id_col is not None:
        subset, order_by = [c for c in df.columns if c != id_col], id_col
    if subset is None:
        from sievekit.operators.dedup import drop_duplicates
        return drop_duplicates(df)
    if order_by is None:
        return df.dropDuplicates(list(subset))
    from sievekit.operators.dedup import first_per_key
    return first_per_key(df, list(subset), order_by)


def validate_ranges(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Per-field inclusive [min, max]; adds ``violations`` array<string> and ``is_valid``.

    ``rules`` holds (field, min, max[, default]). A null value is not a range
    violation here (completeness is C8's job); a rule for a column that is not
    there is an error."""
    _require_columns(df, [r[0] for r in rules])
    flags = [F.when(~col(r[0]).cast("double").between(F.lit(r[1]), F.lit(r[2])), F.lit(r[0])) for r in rules]
    v = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    return df.withColumn("violations", v).withColumn("is_valid", F.size("violations") == 0)


def _require_columns(df: DataFrame, names) -> None:
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")


def split_valid(df: DataFrame, rules: Sequence[tuple]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations)."""
    checked = validate_ranges(df, rules)
    return (checked.where("is_valid").drop("violations", "is_valid"),
            checked.where(~F.col("is_valid")))


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Missing (null or NaN) -> per-field default; an absent column is added
    with its default."""
    out = {}
    for c, v in defaults.items():
        if c not in df.columns:
            out[c] = F.lit(v)
            continue
        dt = df.schema[c].dataType
        x = clean_double(c) if dt.typeName() in ("double", "float") else col(c)
        out[c] = F.coalesce(x, F.lit(v)).cast(dt)
    return df.withColumns(out)


def require_complete(df: DataFrame, fields: Sequence[str], to_type: str = "double") -> DataFrame:
    """Every field must parse as ``to_type``; adds parsed columns, ``missing_fields``
    (names that are absent or unparsable) and ``accepted``."""
    parsed = {f: col(f).cast("string").try_cast(to_type) for f in fields}
    if to_type in ("double", "float"):
        parsed = {f: F.nanvl(p, F.lit(None).cast(to_type)) for f, p in parsed.items()}
    df = df.withColumns(parsed)
    miss = F.filter(F.array(*[F.when(col(f).isNull(), F.lit(f)) for f in fields]),
                    lambda x: x.isNotNull())
    return df.withColumn("missing_fields", miss).withColumn(
        "accepted", F.size("missing_fields") == 0)
