"""Probability-array helpers (argmax with first-max tie rule)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prob_array(c) -> Column:
    """ML ``probability`` vector (or an array) -> array<double>."""
    from pyspark.ml.functions import vector_to_array
    x = F.col(c) if isinstance(c, str) else c
    return vector_to_array(x)


def argmax_first(arr) -> tuple[Column, Column]:
    """(0-based index of the first maximum, maximum) of an array<double>."""
    a = F.col(arr) if isinstance(arr, str) else arr
    mx = F.array_max(a)
    return (F.array_position(a, mx) - 1).cast("int"), mx
