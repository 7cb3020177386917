"""sievekit: Spark-native tabular preparation, scoring and evaluation.

Operators are column-parametric DataFrame transformations; every scalar
decision (quantile bounds, class allocations, label maps) is a bounded
aggregate, never a whole table on the driver.
"""

from sievekit.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
