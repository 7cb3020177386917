"""Scalar feature expressions.

Everything here returns a ``Column`` (or a projected DataFrame) built from
built-in functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the raw (dotted) feature
# names in model-input order, and the canonical snake_case names, by position.
RAW_FEATURES = [
    "fixed.acidity", "volatile.acidity", "citric.acid", "residual.sugar", "chlorides",
    "free.sulfur.dioxide", "total.sulfur.dioxide", "density", "pH", "sulphates", "alcohol",
]
CANONICAL_FEATURES = [
    "fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides",
    "free_sulfur_dioxide", "total_sulfur_dioxide", "density", "ph", "sulphates", "alcohol",
]
RAW_TO_CANONICAL = dict(zip(RAW_FEATURES, CANONICAL_FEATURES))

# Per-field form limits and defaults (name, min, max, default).
FEATURE_RULES = [
    ("fixed_acidity", 0.0, 20.0, 7.0),
    ("volatile_acidity", 0.0, 2.0, 0.3),
    ("citric_acid", 0.0, 1.0, 0.3),
    ("residual_sugar", 0.0, 20.0, 2.0),
    ("chlorides", 0.0, 1.0, 0.05),
    ("free_sulfur_dioxide", 0.0, 100.0, 15.0),
    ("total_sulfur_dioxide", 0.0, 300.0, 50.0),
    ("density", 0.9, 1.1, 0.997),
    ("ph", 2.0, 5.0, 3.2),
    ("sulphates", 0.0, 2.0, 0.6),
    ("alcohol", 8.0, 15.0, 10.5),
]

# Alcohol category edges/labels and the quality tiers.
ALCOHOL_EDGES = [0.0, 10.0, 12.0, 15.0]
ALCOHOL_LEVELS = ["low", "medium", "high"]
TIER_EXCELLENT_MIN = 7
TIER_GOOD_MIN = 5
TIER_LABELS = ("excellent", "good", "needs improvement")
RATIO_EPSILON = 1e-8


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rename_features(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """rename by name->name map (safe) or positionally after an arity check."""
    if isinstance(mapping, Mapping):
        present = {k: v for k, v in mapping.items() if k in df.columns}
        return df.withColumnsRenamed(present)
    names = list(mapping)
    if len(names) != len(df.columns):
        raise ValueError(f"positional rename needs {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def split_label(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """feature projection without the label; the label stays addressable by name.

    Spark has no row order, so X and y are not two aligned tables: callers keep
    one table and use the returned feature-only projection where needed.
    """
    return df.drop(label), label


def ratio(a, b, eps: float | None = None) -> Column:
    """a / (b + eps). A zero divisor yields null (pandas gives inf)."""
    den = _c(b) if eps is None else _c(b) + F.lit(eps)
    return F.try_divide(_c(a).cast("double"), den.cast("double"))


def log1p(c) -> Column:
    """ln(1 + c); null for c <= -1."""
    return F.log1p(_c(c).cast("double"))


def square(c) -> Column:
    """F6."""
    x = _c(c).cast("double")
    return x * x


def bin_right_closed(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """right-closed bins (e0,e1], (e1,e2], ...; outside or null -> null.

    ``Bucketizer`` is left-closed and therefore not used.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    x = _c(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def one_hot(df: DataFrame, c: str, levels: Sequence[str], prefix: str | None = None,
            drop: bool = True) -> DataFrame:
    """F8: one 0/1 column per fixed level; null category -> all zeros."""
    p = prefix or c
    x = F.col(c)
    df = df.withColumns({f"{p}_{lv}": F.coalesce(x == F.lit(lv), F.lit(False)).cast("int")
                         for lv in levels})
    return df.drop(c) if drop else df


def assemble_columns(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """fixed-order feature vector for model input."""
    from sievekit.plans.stages import AssembleColumns
    return AssembleColumns.of(cols, out).transform(df)


def quality_tier(pred) -> Column:
    """>=7 excellent, >=5 good, else needs improvement."""
    p = _c(pred)
    return (F.when(p >= TIER_EXCELLENT_MIN, F.lit(TIER_LABELS[0]))
             .when(p >= TIER_GOOD_MIN, F.lit(TIER_LABELS[1]))
             .when(p.isNotNull(), F.lit(TIER_LABELS[2])))


def confidence_pct(conf) -> Column:
    """confidence x 100 with one decimal."""
    return F.round(_c(conf).cast("double") * 100.0, 1)


def engineered_features(df: DataFrame) -> DataFrame:
    """The 7 derived doubles and 3 alcohol flags on a canonical table (21 features)."""
    df = df.withColumns({
        "acid_ratio": ratio("fixed_acidity", "volatile_acidity", RATIO_EPSILON),
        "sulfur_ratio": ratio("free_sulfur_dioxide", "total_sulfur_dioxide", RATIO_EPSILON),
        "alcohol_density_ratio": ratio("alcohol", "density"),
        "log_residual_sugar": log1p("residual_sugar"),
        "log_chlorides": log1p("chlorides"),
        "alcohol_squared": square("alcohol"),
        "ph_squared": square("ph"),
        "alcohol_category": bin_right_closed("alcohol", ALCOHOL_EDGES, ALCOHOL_LEVELS),
    })
    return one_hot(df, "alcohol_category", ALCOHOL_LEVELS, prefix="alcohol")
