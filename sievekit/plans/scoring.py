"""Batch scoring (I1, I2): probabilities -> argmax -> decoded label, confidence, tier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sievekit.functions.features import confidence_pct, quality_tier
from sievekit.functions.vectors import argmax_first, prob_array


def score(df: DataFrame, model, label_map=None, prob_col: str = "probability",
          keep: tuple = ()) -> DataFrame:
    """One transform over the whole table (no per-row loop).

    Output: prediction (decoded label), confidence (max probability, first max
    on ties), tier (null unless the label is a number) and confidence_pct."""
    scored = model.transform(df)
    arr = prob_array(prob_col) if prob_col in scored.columns else F.col("probability_arr")
    scored = scored.withColumn("_probs", arr)
    idx, mx = argmax_first("_probs")
    scored = scored.withColumn("_idx", idx).withColumn("confidence", mx)
    if label_map is not None:
        scored = label_map.decode(scored, "_idx", "prediction_label")
    else:
        scored = scored.withColumn("prediction_label", F.col("_idx"))
    kind = scored.schema["prediction_label"].dataType
    tier = (quality_tier("prediction_label") if isinstance(kind, NumericType)
            else F.lit(None).cast("string"))
    return scored.select(*keep, F.col("prediction_label").alias("prediction"), "confidence",
                         tier.alias("tier"),
                         confidence_pct("confidence").alias("confidence_pct"))
