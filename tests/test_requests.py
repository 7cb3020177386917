"""Requests that come twice or late, and a restart in mid-batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sievekit.streaming import requests as R

SCHEMA = "id long, at timestamp, x double, y string"
START = dt.datetime(2026, 1, 1, 12)


def row(i, minute, x=None):
    return (i, None if minute is None else START + dt.timedelta(minutes=minute), float(i if x is None else x), "odd" if i % 2 else "even")


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def scored(df):
    return df.select("id", "y", F.when(F.col("x") % 2 == 1, "odd").otherwise("even").alias("prediction"))


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    R.serve(spark, str(tmp_path / "in"), SCHEMA, scored, str(tmp_path / "out"), "id", "at", "10 minutes", "y")


def test_twice_late_and_restart(spark, tmp_path):
    inbox, base = str(tmp_path / "in"), str(tmp_path / "out")
    failing = []

    def before_commit(batch):
        if failing:
            raise RuntimeError(failing.pop())

    def go():
        R.serve(spark, inbox, SCHEMA, scored, base, "id", "at", "10 minutes", "y", before_commit=before_commit)

    def ids(name):
        return sorted(r.id for r in spark.read.parquet(f"{base}/{name}").collect())

    first = [row(i, i) for i in range(6)] + [row(3, 3), row(6, 6, 7)]       # 3 twice; 6 is scored wrongly
    arrive(spark, inbox, first)
    go()
    assert ids("scored") == list(range(7)) and ids("late") == []
    arrive(spark, inbox, first)                                              # the same file again
    arrive(spark, inbox, [row(20, 60)])
    failing.append("stopped in mid-batch")
    with pytest.raises(Exception, match="stopped in mid-batch"):
        go()
    go()
    assert ids("scored") == [*range(7), 20]
    # 21 is 20 minutes behind 20; 23 has no time; 24 is just late
    arrive(spark, inbox, [row(21, 40), row(22, 61), row(23, None), row(24, 50)])
    go()
    assert ids("late") == [21, 23, 24] and ids("scored") == [*range(7), 20, 22]
    n = R.running_accuracy(spark, base).first()
    assert n.n == 9 and n.accuracy == pytest.approx(8 / 9)
    want = spark.read.parquet(f"{base}/scored").groupBy("y", "prediction").count()
    assert sorted(map(tuple, R.running_counts(spark, base).collect())) == sorted(map(tuple, want.collect()))
    go()                                                                     # nothing new
    assert ids("scored") == [*range(7), 20, 22]
    # the first stream gets ahead of the second by a failure; no row is lost between them
    arrive(spark, inbox, [row(30, 90)])
    failing.append("stopped before the scores")
    with pytest.raises(Exception, match="stopped before the scores"):
        go()
    arrive(spark, inbox, [row(31, 85), row(32, 70), row(30, 90), row(25, 81)])
    go()
    assert ids("scored") == [*range(7), 20, 22, 25, 30, 31] and 32 in ids("late")
