"""Column names as given: dots, spaces and quotes are part of the name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def text_literal(value: str) -> str:
    """SQL text literal, for names or values inside an expression string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
