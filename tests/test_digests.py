"""Stages rerun on changed content only."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from sievekit.sources import digests as D


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_manifest_and_changes(spark, tmp_path):
    for name, text in (("a.csv", "x"), ("sub/b.csv", "yy"), ("sub/it's.csv", "é"), ("none.csv", "")):
        write(tmp_path / "in" / name, text)
    path = str(tmp_path / "in")
    rows = {short(r.file): (r.size_bytes, r.md5) for r in D.manifest(spark, path).collect()}
    assert rows == {n: (len(t.encode()), hashlib.md5(t.encode()).hexdigest()) for n, t in
                    (("a.csv", "x"), ("sub/b.csv", "yy"), ("sub/it's.csv", "é"))}
    assert [short(r.file) for r in D.manifest(spark, path + "/a.csv").collect()] == ["a.csv"]
    assert D.manifest(spark, str(tmp_path / "none")).count() == 0
    last = spark.createDataFrame(D.manifest(spark, path).collect())
    was = os.stat(tmp_path / "in" / "sub" / "b.csv")
    write(tmp_path / "in" / "sub" / "b.csv", "zz")              # same length
    os.utime(tmp_path / "in" / "sub" / "b.csv", ns=(was.st_atime_ns, was.st_mtime_ns))
    write(tmp_path / "in" / "c.csv", "n")
    os.remove(tmp_path / "in" / "a.csv")
    got = {(short(r.file), r.change) for r in D.changes(D.manifest(spark, path), last).collect()}
    assert got == {("sub/b.csv", "changed"), ("c.csv", "new"), ("a.csv", "removed")}


def short(file):
    return file.split("/in/")[-1]


def stages(base, runs, factor=2):
    def csv(spark, inputs):
        runs.append("load")
        return spark.read.schema("k int, v int").csv(inputs["raw"]).coalesce(1)

    def big(spark, inputs):
        runs.append("big")
        return spark.read.parquet(inputs["rows"]).where("v > 10").select("k", (F.col("v") * factor).alias("v")).orderBy("k").coalesce(1)

    def count(spark, inputs):
        runs.append("count")
        return spark.read.parquet(inputs["big"]).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).coalesce(1)

    return [D.Stage("count", {"big": f"{base}/big"}, f"{base}/count", count),
            D.Stage("big", {"rows": f"{base}/rows"}, f"{base}/big", big, {"factor": factor}),
            D.Stage("load", {"raw": f"{base}/raw"}, f"{base}/rows", csv)]


def test_only_what_changed_runs(spark, tmp_path):
    base, runs = str(tmp_path), []
    write(tmp_path / "raw" / "a.csv", "1,20\n2,5\n")

    def go(factor=2):
        runs.clear()
        told = D.run_stages(spark, stages(base, runs, factor), f"{base}/state")
        assert [n for n, ran in told.items() if ran] == runs and list(told) == ["load", "big", "count"]
        return list(runs), tuple(spark.read.parquet(f"{base}/count").first())

    assert go() == (["load", "big", "count"], (1, 40))
    assert go() == ([], (1, 40))
    was = os.stat(tmp_path / "raw" / "a.csv")
    write(tmp_path / "raw" / "a.csv", "1,30\n2,5\n")             # same length, same time
    os.utime(tmp_path / "raw" / "a.csv", ns=(was.st_atime_ns, was.st_mtime_ns))
    assert go() == (["load", "big", "count"], (1, 60))
    write(tmp_path / "raw" / "a.csv", "1,30\n2,6\n")             # 'big' comes out the same
    assert go()[0][:2] == ["load", "big"]
    assert go(3) == (["big", "count"], (1, 90))
    for f in (tmp_path / "count").glob("*.parquet"):
        os.remove(f)                                              # its output is gone
    assert go(3) == (["count"], (1, 90))


def test_order(tmp_path):
    a = D.Stage("a", {"x": "two"}, "one", None)
    with pytest.raises(ValueError, match="ring"):
        D.in_order([a, D.Stage("b", {"x": "one"}, "two", None)])
    with pytest.raises(ValueError, match="same output"):
        D.in_order([a, D.Stage("b", {}, "one", None)])
    with pytest.raises(ValueError, match="same name"):
        D.in_order([a, D.Stage("a", {}, "three", None)])
