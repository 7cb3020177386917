import duckdb
import pytest

from sievekit.operators.quantiles import quantiles
from tests.conftest import SF001


def test_micro_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert quantiles(df, ["x"], [0.25, 0.5, 0.75]) == {"x": [1.75, 2.5, 4.75]}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert quantiles(df, ["x"], [0.5]) == {"x": [2.0]}


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.5]}


@pytest.mark.parametrize("accuracy,final_max", [(10_000, 1_000_000), (50, 20)])
def test_exact_matches_duckdb(spark, accuracy, final_max):
    """Both the fused path and the bracket-refinement loop are exact."""
    p = f"{SF001}/lineitem.parquet"
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = quantiles(spark.read.parquet(p), cols, probs, accuracy=accuracy,
                    final_max_distinct=final_max)
    for c in cols:
        want = duckdb.execute(f"select quantile_cont({c}::double, {probs}) from '{p}'").fetchall()[0][0]
        assert got[c] == list(want), c


def test_hot_value_third_of_rows(spark):
    """One value holding a third of the rows: selection works on value counts."""
    from pyspark.sql import functions as F
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("x"))
    got = quantiles(df, ["x"], [0.25, 0.5, 0.75], accuracy=100, final_max_distinct=50)["x"]
    vals = sorted(r[0] for r in df.collect())
    import numpy as np
    assert got == [float(v) for v in np.quantile(vals, [0.25, 0.5, 0.75])]


def test_approx_mode(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert quantiles(df, ["x"], [0.5], method="approx") == {"x": [50.0]}
