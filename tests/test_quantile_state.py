"""Merged sketches: rank error, new files only, files that go or change."""

import os
import shutil

import numpy as np
import pytest

from sievekit.operators import quantile_state as Q

SCHEMA = "a double, `b c` long"


def add(spark, path, a, b):
    rows = [(None if x is None else float(x), None if y is None else int(y)) for x, y in zip(a, b)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def ranks_hold(values, found, probs, k):
    values = np.sort(values)
    for p, v in zip(probs, found):
        below, upto = np.searchsorted(values, v, "left") / len(values), np.searchsorted(values, v, "right") / len(values)
        assert below - Q.rank_error(k) <= p <= upto + Q.rank_error(k)


def test_grows_by_new_files_only(spark, tmp_path):
    rng = np.random.default_rng(1)
    inbox, state, probs, k = str(tmp_path / "in"), str(tmp_path / "state"), [0.01, 0.25, 0.5, 0.75, 0.99], 200
    parts = [(rng.normal(i, 1 + i, 4000), rng.integers(0, 50, 4000)) for i in range(4)]
    for a, b in parts[:2]:
        add(spark, inbox, a, b)
    assert Q.update_state(spark, inbox, SCHEMA, ["a", "b c"], state, k) == 2
    for a, b in parts[2:]:
        add(spark, inbox, a, b)
    # the files of the first run are unreadable now: the second mustn't touch them
    with pytest.raises(ValueError, match="2 files"):
        Q.state_quantiles(spark, inbox, state, ["a"], probs)
    old = [f for f in (tmp_path / "in").glob("*.parquet") if any(
        f.name in r.file for r in spark.read.parquet(state + "/files").collect())]
    kept = {f: (f.read_bytes(), os.stat(f)) for f in old}
    for f, (text, stat) in kept.items():
        f.write_bytes(b"x" * len(text))
        os.utime(f, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert len(old) == 2 and Q.update_state(spark, inbox, SCHEMA, ["a", "b c"], state, k) == 2
    assert Q.update_state(spark, inbox, SCHEMA, ["a", "b c"], state, k) == 0
    found, n = Q.state_quantiles(spark, inbox, state, ["a", "b c"], probs)
    assert n == {"a": 16000, "b c": 16000}
    for i, c in enumerate(("a", "b c")):
        ranks_hold(np.concatenate([p[i] for p in parts]), found[c], probs, k)
    q1, q3, low, high = Q.state_iqr_bounds(spark, inbox, state, ["a"])["a"]
    ranks_hold(np.concatenate([p[0] for p in parts]), [q1, q3], [0.25, 0.75], k)
    assert low == q1 - 1.5 * (q3 - q1) and high == q3 + 1.5 * (q3 - q1)


def test_removed_and_rewritten_files(spark, tmp_path):
    inbox, state = tmp_path / "in", str(tmp_path / "state")
    add(spark, str(inbox / "x"), [1, 2, 3], [1, 1, None])
    add(spark, str(inbox / "y"), [10, None, float("nan")], [None] * 3)
    run = lambda: Q.update_state(spark, str(inbox), SCHEMA, ["a", "b c"], state)
    assert run() == 2
    assert Q.state_quantiles(spark, str(inbox), state, ["a", "b c"], [0.0, 1.0]) == (
        {"a": [1.0, 10.0], "b c": [1.0, 1.0]}, {"a": 4, "b c": 2})
    shutil.rmtree(inbox / "y")
    assert run() == 0 and Q.state_quantiles(spark, str(inbox), state, ["a"], [1.0]) == ({"a": [3.0]}, {"a": 3})
    shutil.rmtree(inbox / "x")
    add(spark, str(inbox / "x"), [7], [None])
    assert run() == 1 and Q.state_quantiles(spark, str(inbox), state, ["a", "b c"], [0.5]) == (
        {"a": [7.0], "b c": [None]}, {"a": 1, "b c": 0})
    assert Q.state_iqr_bounds(spark, str(inbox), state, ["b c"]) == {"b c": (None, None, None, None)}
