import pytest
from pyspark.sql import functions as F

from sievekit.operators import splitting
from sievekit.operators.ranking import stratified_rank


def counts(df, label="y"):
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def allocation(spark, table, test_size=0.2):
    df = spark.createDataFrame(list(table.items()), "y int, n long")
    return {r.y: r.t for r in splitting.allocate_test(df, "y", test_size).collect()}


def test_allocation_exact_sizes(spark):
    table = {3: 10, 4: 53, 5: 681, 6: 638, 7: 199, 8: 18}
    alloc = allocation(spark, table)
    assert sum(alloc.values()) == -(-sum(table.values()) // 5)
    for c, n in table.items():
        assert abs(alloc[c] - n * 0.2) < 1


def test_allocation_ties_go_to_the_lower_class_and_large_counts_stay_exact(spark):
    assert allocation(spark, {1: 6, 2: 6, 3: 6}, 0.25) == {1: 2, 2: 2, 3: 1}
    big = 10 ** 12 + 1
    assert sum(allocation(spark, {1: big, 2: big, 3: 7}).values()) == -(-(2 * big + 7) // 5)


def test_allocation_errors(spark):
    with pytest.raises(ValueError):
        allocation(spark, {0: 10, 1: 1})
    with pytest.raises(ValueError):
        allocation(spark, {0: 2, 1: 2, 2: 2, 3: 2})   # 2 test rows < 4 classes
    with pytest.raises(ValueError):
        allocation(spark, {})


def test_holdout_and_folds_with_hot_class(spark):
    """A class holding a third of the rows is ranked across many sub-buckets."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0))
                                  .otherwise(F.col("id") % 7 + 1).cast("int").alias("y"))
    sp = splitting.stratified_holdout(df, "y", "id")
    table = {r.y: r.n for r in counts(df).collect()}
    got = {r.y: r.n for r in sp.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == allocation(spark, table)
    assert sp.count() == 3000
    fo = splitting.stratified_kfold(df, "y", "id", 5)
    sizes = {(r.y, r.fold): r.n for r in fo.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
    for c, n in table.items():
        per = [sizes.get((c, f), 0) for f in range(5)]
        assert max(per) - min(per) <= 1 and sum(per) == n
    with pytest.raises(ValueError):
        splitting.stratified_kfold(df.limit(3), "y", "id", 5)


def test_holdout_repeatable_and_seeded(spark):
    df = spark.range(500).select("id", (F.col("id") % 4).alias("y"))
    a = {r.id for r in splitting.stratified_holdout(df, "y", "id", seed=42).where("split='test'").collect()}
    b = {r.id for r in splitting.stratified_holdout(df, "y", "id", seed=42).where("split='test'").collect()}
    c = {r.id for r in splitting.stratified_holdout(df, "y", "id", seed=7).where("split='test'").collect()}
    assert a == b and a != c and len(a) == 100


@pytest.mark.parametrize("target", [10**6, 3])
def test_holdout_takes_the_first_rows_in_rank_order(spark, target):
    """With and without refinement of the boundary sub-buckets; null labels go
    to train, and a dotted label and id are names like any other."""
    df = spark.range(4000).select(F.col("id").alias("row.id"), F.when(F.col("id") % 3 == 0, F.lit(0))
                                  .when(F.col("id") % 97 == 0, F.lit(None))
                                  .otherwise(F.col("id") % 5 + 1).cast("int").alias("y.z"), F.lit(1).alias("v"))
    sp = splitting.stratified_holdout(df, "y.z", "row.id", target_rows=target)
    assert sp.columns == ["row.id", "y.z", "v", "split"]
    plain = df.toDF("id", "y", "v")
    alloc = allocation(spark, {r.y: r.n for r in counts(plain).collect()})
    rk = stratified_rank(plain.where("y IS NOT NULL"), "y", "id")
    want = {r.id for r in rk.collect() if r._rank < alloc[r.y]}
    rows = sp.toDF("id", "y", "v", "split")
    assert {r.id for r in rows.where("split = 'test'").collect()} == want
    assert rows.count() == 4000
    assert rows.where("y IS NULL AND split = 'train'").count() == plain.where("y IS NULL").count()


def test_holdout_string_labels_and_zero_allocation(spark):
    """A class whose test share rounds to 0 has no boundary: all its rows train."""
    df = spark.range(1002).select("id", F.when(F.col("id") < 1000, F.lit("big")).otherwise(F.lit("tiny")).alias("y"))
    sp = splitting.stratified_holdout(df, "y", "id", target_rows=20)
    got = {r.y: r.n for r in sp.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {"big": 201} and sp.count() == 1002


def test_holdout_of_thousands_of_classes(spark):
    """Class values are joined: there is no largest number of classes."""
    df = spark.range(30_000).select("id", (F.col("id") % 3000).alias("y"))
    sp = splitting.stratified_holdout(df, "y", "id")
    per = sp.where("split = 'test'").groupBy("y").count().groupBy("count").count().collect()
    assert {r[0]: r[1] for r in per} == {2: 3000}
