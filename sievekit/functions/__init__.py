from sievekit.functions.features import (  # noqa: F401
    FEATURE_RULES, RAW_TO_CANONICAL, assemble_columns, bin_right_closed, confidence_pct,
    log1p, one_hot, quality_tier, ratio, rename_features, split_label, square,
)
from sievekit.functions.vectors import argmax_first, prob_array  # noqa: F401
