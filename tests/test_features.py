import math

from pyspark.sql import functions as F

from sievekit.functions import features as fx
from sievekit.functions.vectors import argmax_first
from sievekit.plans.training import fit_label_map


def test_right_closed_bins(spark):
    vals = [0.0, 10.0, 10.5, 12.0, 15.0, 15.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(fx.bin_right_closed("x", fx.ALCOHOL_EDGES, fx.ALCOHOL_LEVELS)).collect()]
    assert got == [None, "low", "medium", "medium", "high", None, None]


def test_one_hot_null_is_all_zero(spark):
    df = spark.createDataFrame([("low",), (None,)], "c string")
    rows = fx.one_hot(df, "c", fx.ALCOHOL_LEVELS, prefix="alcohol").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0), (0, 0, 0)]


def test_ratio_log_square(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.5), (2.0, 4.0, -1.0), (3.0, 1.0, -2.0)], "a double, b double, c double")
    rows = df.select(fx.ratio("a", "b").alias("r"), fx.ratio("a", "b", 1e-8).alias("re"),
                     fx.log1p("c").alias("l"), fx.square("a").alias("s")).collect()
    assert rows[0].r is None and math.isclose(rows[0].re, 1e8)
    assert math.isclose(rows[0].l, 0.4054651081081644) and rows[1].l is None and rows[2].l is None
    assert [r.s for r in rows] == [1.0, 4.0, 9.0]


def test_label_map_numeric_order(spark):
    df = spark.createDataFrame([(10,), (3,), (9,)], "q int")
    lm = fit_label_map(df, "q", "i")
    assert lm.labels == [3, 9, 10]
    enc = {r.q: r.i for r in lm.encode(df).collect()}
    assert enc == {3: 0, 9: 1, 10: 2}
    dec = lm.decode(lm.encode(df), "i", "back").collect()
    assert all(r.back == r.q for r in dec)


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    idx, mx = argmax_first("p")
    r = df.select(idx.alias("i"), mx.alias("m")).first()
    assert (r.i, r.m) == (1, 0.4)


def test_tiers_and_pct(spark):
    df = spark.createDataFrame([(7, 0.1234), (6, 0.5), (5, 0.99), (4, 1.0)], "p int, c double")
    rows = df.select(fx.quality_tier("p").alias("t"), fx.confidence_pct("c").alias("pc")).collect()
    assert [r.t for r in rows] == ["excellent", "good", "good", "needs improvement"]
    assert [r.pc for r in rows] == [12.3, 50.0, 99.0, 100.0]


def test_engineered_features_shape(spark):
    cols = fx.CANONICAL_FEATURES
    df = spark.createDataFrame([tuple(r[3] for r in fx.FEATURE_RULES)], ", ".join(f"{c} double" for c in cols))
    out = fx.engineered_features(df)
    assert len(out.columns) == 21
    r = out.first()
    assert r.alcohol_medium == 1 and r.alcohol_low == 0
