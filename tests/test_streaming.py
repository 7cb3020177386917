"""Stream result = batch result; a rerun without new files processes nothing."""

from pyspark.sql import functions as F

from sievekit.plans import ml_catalog
from sievekit.streaming import changed_inputs, score_stream
from tests.conftest import SF0001


def test_stream_equals_batch_and_no_rescoring(spark):
    base, inbox, later, transform, schema = ml_catalog._stream_fixture(spark, SF0001)
    out, ck = f"{base}/out", f"{base}/ck"
    score_stream(spark, inbox, schema, transform, out, ck)
    n1 = spark.read.parquet(out).count()
    score_stream(spark, inbox, schema, transform, out, ck)        # nothing new
    assert spark.read.parquet(out).count() == n1
    later.write.mode("append").parquet(inbox)
    score_stream(spark, inbox, schema, transform, out, ck)
    streamed = {tuple(r) for r in spark.read.parquet(out).select("vec_id", "prediction", "confidence").collect()}
    batch = {tuple(r) for r in transform(spark.read.schema(schema).parquet(inbox))
             .select("vec_id", "prediction", "confidence").collect()}
    assert streamed == batch and len(batch) == 100


def test_changed_inputs_counts(spark):
    df = ml_catalog.q_s10(spark, SF0001)
    runs = df.select("rows_per_run").first()[0].split(",")
    assert int(runs[1]) == 0 and int(runs[0]) + int(runs[2]) == df.count() == 100
    assert df.where("as_in_batch").count() == 100


def test_rewritten_files_are_seen(spark):
    import datetime as dt
    from sievekit.streaming.scoring_stream import changed_files
    t = dt.datetime(2026, 1, 1)
    schema = "file_path string, size_bytes long, modified timestamp"
    last = spark.createDataFrame([("a", 1, t), ("b", 2, t), ("c", 3, t)], schema)
    now = spark.createDataFrame([("a", 1, t), ("b", 2, t + dt.timedelta(1)), ("d", 4, t)], schema)
    assert {(r.file_path, r.change) for r in changed_files(now, last).collect()} == {
        ("b", "changed"), ("c", "removed"), ("d", "new")}
