import os

from pyspark.sql import functions as F

from sievekit.operators import cleaning, profile
from sievekit.plans import catalog
from sievekit.session import work_dir
from sievekit.sources.tables import load_table
from tests.conftest import SF001


def test_csv_nan_and_empty_are_null(spark):
    path = work_dir(spark, "csv")
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(local)
    with open(os.path.join(local, "a.csv"), "w") as f:
        f.write("a,b\n1.0,\nNaN,2.0\n")
    df = load_table(spark, path, "a double, b double", fmt="csv")
    rows = sorted(df.collect(), key=lambda r: (r.a is None, r.a or 0))
    assert rows[0].a == 1.0 and rows[0].b is None
    assert rows[1].a is None and rows[1].b == 2.0


def test_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1)], "a int, b int")
    assert profile.duplicate_count(df).first()[0] == 1
    assert cleaning.drop_exact_duplicates(df).count() == 2


def test_first_per_key_keeps_lowest_order(spark):
    df = spark.createDataFrame([("x", 3, "c"), ("x", 1, "a"), ("y", 2, "b")], "k string, id int, v string")
    out = {r.k: (r.id, r.v) for r in cleaning.drop_exact_duplicates(df, ["k"], "id").collect()}
    assert out == {"x": (1, "a"), "y": (2, "b")}


def test_impute_median_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 3.0), (None, 10.0)], "a double, b double")
    filled, med = cleaning.impute_median(df)
    assert med == {"a": 2.0, "b": 3.0}
    assert sorted(r.a for r in filled.collect()) == [1.0, 2.0, 2.0, 3.0]


def test_sequential_iqr_is_order_dependent(spark):
    d = catalog.docs_words(spark, SF001)
    a, rep_a = cleaning.filter_outliers(d, ["n_chars", "words"])
    b, _ = cleaning.filter_outliers(d, ["words", "n_chars"])
    assert a.count() == 872 and b.count() == 875
    assert rep_a[0]["n_outliers"] == 95


def test_simultaneous_uses_input_bounds(spark):
    d = catalog.docs_words(spark, SF001)
    s, rep = cleaning.filter_outliers(d, ["n_chars", "words"], mode="simultaneous")
    b = cleaning.iqr_bounds(d, ["n_chars", "words"])
    assert [r["lower"] for r in rep] == [b["n_chars"][2], b["words"][2]]
    inside = d.where(F.col("n_chars").between(b["n_chars"][2], b["n_chars"][3])
                     & F.col("words").between(b["words"][2], b["words"][3]))
    assert s.count() == inside.count()


def test_filter_reaches_parquet_scan(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    kept, _ = cleaning.filter_outliers(ev, ["value"], count_outliers=False)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value" in plan


def test_validate_ranges_and_defaults(spark):
    df = spark.createDataFrame([(3.2, 1.0), (6.0, None), (None, 20.0)], "ph double, density double")
    rules = [("ph", 2.0, 5.0, 3.2), ("density", 0.9, 1.1, 0.997)]
    v = {tuple(r.violations): r.is_valid for r in cleaning.validate_ranges(df, rules).collect()}
    assert v == {(): True, ("ph",): False, ("density",): False}
    filled = cleaning.apply_defaults(df, {"ph": 3.2, "density": 0.997}).collect()
    assert [r.ph for r in filled] == [3.2, 6.0, 3.2] and filled[1].density == 0.997


def test_require_complete(spark):
    df = spark.createDataFrame([("1.5", "2"), ("n/a", "3"), ("NaN", None)], "a string, b string")
    out = cleaning.require_complete(df, ["a", "b"]).collect()
    assert [r.accepted for r in out] == [True, False, False]
    assert list(out[2].missing_fields) == ["a", "b"]


def test_missing_profile(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None)], "a double, s string")
    got = {r.column_name: r.n_missing for r in profile.missing_per_column(df).collect()}
    assert got == {"a": 1, "s": 1}
    assert profile.missing_total(df).first()[0] == 2
    assert profile.numeric_columns(df) == ["a"]


def test_hash_first_dedup_is_exact_under_collisions(spark):
    # Spark's row hashes skip nulls, so these two different rows collide
    df = spark.createDataFrame([(1, None), (None, 1), (2, 2), (2, 2)], "a int, b int")
    assert profile.duplicate_count(df).first()[0] == 1
    assert sorted(map(tuple, cleaning.drop_exact_duplicates(df).collect()),
                  key=str) == sorted([(1, None), (None, 1), (2, 2)], key=str)


def test_hash_first_dedup_matches_groupby_semantics_for_floats(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,)], "x double")
    assert profile.duplicate_count(df).first()[0] == df.count() - df.distinct().count() == 2
    assert cleaning.drop_exact_duplicates(df).count() == 3


def test_integer_median_between_integers(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (None, 7)], "a int, b int")
    filled, med = cleaning.impute_median(df)
    assert med == {"a": 1.5} and sorted(r.a for r in filled.collect()) == [1.0, 1.5, 2.0]
    assert dict(filled.dtypes) == {"a": "double", "b": "int"}


def test_dotted_names_through_the_data_stage(spark):
    """Raw names are cleaned before they are renamed."""
    from sievekit.plans.experiment import prepare_data
    from sievekit.sources.tables import read_split
    rows = [(i, float(i % 20) if i % 9 else None, 500.0 if i == 50 else float(i % 7), i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, `fixed.acidity` double, `p H` double, quality int")
    out = work_dir(spark, "dotted")
    info = prepare_data(df, "quality", "id", out, rename={"fixed.acidity": "fixed_acidity", "p H": "ph"})
    got = read_split(spark, out)
    assert set(got.columns) == {"id", "fixed_acidity", "ph", "quality", "split"}
    assert got.count() == 199 and info["outliers"][1]["n_outliers"] == 1
    assert got.where("fixed_acidity IS NULL").count() == 0
    simultaneous, _ = cleaning.filter_outliers(df, ["fixed.acidity", "p H"], mode="simultaneous")
    assert simultaneous.count() == 200 - 1 - sum(1 for r in rows if r[1] is None)
    assert cleaning.apply_defaults(df, {"fixed.acidity": 1.0}).where("`fixed.acidity` IS NULL").count() == 0


def test_repeats_under_unique_ids(spark):
    rows = [(i, f"t{i % 10}", i % 10) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t string, n int")
    assert sorted(r.id for r in cleaning.drop_exact_duplicates(df, id_col="id").collect()) == list(range(10))


def test_first_per_key_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(1, None, 5, "a"), (None, 1, 4, "b"), (1, None, 5, "a"), (2, 2, None, "c"),
                                (2, 2, 9, "d")], "k1 int, k2 int, o int, v string")
    got = sorted(((r.k1, r.k2, r.o, r.v) for r in cleaning.drop_exact_duplicates(df, ["k1", "k2"], "o").collect()), key=str)
    assert got == sorted([(1, None, 5, "a"), (None, 1, 4, "b"), (2, 2, 9, "d")], key=str)


def test_rules_for_absent_fields(spark):
    import pytest
    df = spark.createDataFrame([(3.2,)], "ph double")
    with pytest.raises(ValueError):
        cleaning.validate_ranges(df, [("density", 0.9, 1.1)])
    assert cleaning.apply_defaults(df, {"density": 0.997}).first().density == 0.997


def test_bad_csv_fields(spark):
    import pytest
    path = work_dir(spark, "bad")
    spark.createDataFrame([("1.5",), ("x",)], "a string").write.option("header", True).csv(path)
    assert sorted(str(r.a) for r in load_table(spark, path, "a double", fmt="csv").collect()) == ["1.5", "None"]
    with pytest.raises(Exception):
        load_table(spark, path, "a double", fmt="csv", bad_fields="error").collect()


def test_valid_and_quarantined_rows(spark):
    df = spark.createDataFrame([(3.2,), (6.0,), (None,)], "ph double")
    good, bad = cleaning.split_valid(df, [("ph", 2.0, 5.0)])
    assert sorted(str(r.ph) for r in good.collect()) == ["3.2", "None"]
    assert [(r.ph, r.violations) for r in bad.collect()] == [(6.0, ["ph"])]


def test_profile(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (None, 1)], "`x.y` double, `l.m` int")
    got = profile.profile(df, "l.m")
    assert (got["n_rows"], got["missing"], got["duplicates"]) == (3, 1, 1)
    assert [tuple(r) for r in got["label_counts"].collect()] == [(0, 2), (1, 1)]


def test_missing_counts_with_quotes_in_names(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (None, 3)], "`it's` int, `a\\b.c` int")
    got = {r.column_name: r.n_missing for r in profile.missing_per_column(df).collect()}
    assert got == {"it's": 2, "a\\b.c": 1}


def test_first_per_key_with_ties(spark):
    """Rows that tie in the order value: the smallest by the other columns, however they lie."""
    from pyspark.sql import functions as F
    from sievekit.operators.dedup import first_per_key
    rows = [("a", 1, "z", 2.0), ("a", 1, "b", float("nan")), ("a", 1, "b", 3.0), ("a", 2, "a", 0.0),
            (None, None, "q", None), (None, None, None, 1.0), ("c", 5, "x", 1.0), ("c", 5, "x", 1.0)]
    df = spark.createDataFrame(rows, "k string, o int, `v w` string, x double").withColumn("m", F.create_map(F.lit("n"), "v w"))
    for n in (1, 5):
        got = sorted(map(tuple, first_per_key(df.repartition(n), ["k"], "o").collect()), key=str)
        assert got == sorted([("a", 1, "b", 3.0, {"n": "b"}), (None, None, None, 1.0, {"n": None}),
                              ("c", 5, "x", 1.0, {"n": "x"})], key=str)
