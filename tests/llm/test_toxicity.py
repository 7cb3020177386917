import random
import zlib

import numpy as np

from sievekit.llm import toxicity as X

SCHEMA = "doc_id long, text string, lang string, b int"


def corpus(n=900):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(300)]
    bad = ["vilest", "horrid", "nastyfied", "nastyness", "scorn"]
    rows, truth = [], {}
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        truth[i] = rng.random() < 0.15
        if truth[i]:
            for _ in range(rng.randint(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), "xx", 1))
    return rows, truth


def test_learns_from_positives_and_unlabelled(spark):
    rows, truth = corpus()
    labels = [(i, int(truth[i])) for i in range(len(rows)) if i % 2] + [(None, 1), (3, None), (3, int(truth[3]))]
    df = spark.createDataFrame(rows, SCHEMA)
    model = X.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = X.score(df, model).collect()
    assert list(got[0].asDict()) == ["doc_id", "text", "lang", "b", "score"]
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100
    right = sum((r.score >= 0.5) == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.97


def test_held_out_labels_do_not_matter(spark):
    rows, truth = corpus(300)
    df = spark.createDataFrame(rows, SCHEMA)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = {i: int(truth[i]) for i in truth}
    flipped = labels | {i: 1 - labels[i] for i in held}
    a, b = (X.train(df, spark.createDataFrame(list(x.items()), "doc_id long, toxic int")) for x in (labels, flipped))
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]
    flags = df.select("doc_id", X.held_out(df.doc_id).alias("h")).collect()
    assert {r.doc_id for r in flags if r.h} == set(held)


def test_frequencies_cover_all_rows_and_samples_are_full(spark, monkeypatch):
    """A word in 6 of 200 confirmed documents keeps its scale though the sample
    holds ten; repeated labels, rows and null ids take no places in the sample."""
    rows = [(i, f"plain{i % 7} " + ("slur rare" if i % 40 == 2 else "slur" if i % 2 else "calm"), "xx", 1)
            for i in range(480)]
    rows += [(7, rows[7][1], "xx", 1)] * 200 + [(None, "no id", "xx", 1)] * 200
    confirmed = [i for i in range(480) if i % 2 or i % 40 == 2]
    labels = [(i, 1) for i in confirmed] + [(confirmed[0], 1)] * 500 + [(i, 0) for i in range(0, 480, 8)]
    seen = {}
    monkeypatch.setattr(X, "fit_nnpu", lambda p, u, prior, scales, **kw: seen.update(p=p, u=u, scales=scales))
    frames = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    scales = []
    for most in (200_000, 0):                # ids broadcast, ids joined by a shuffle
        monkeypatch.setattr(X, "BROADCAST_IDS", most)
        X.train(*frames, max_positive=10, max_unlabelled=20)
        assert (len(seen["p"]), len(seen["u"])) == (10, 20)
        scales.append(seen["scales"])
    at = X.features(b"rare")[0]
    assert sum(at in x for x in seen["p"]) < 2 and scales[0][at] > 0
    assert np.array_equal(*scales)


def test_odd_rows_and_no_labels(spark, make, odd_rows):
    df = make(odd_rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.train(df, none) is None
    assert {r.score for r in X.score(df, None).collect()} == {0.0}
    model = X.train(df, spark.createDataFrame([(4, 1), (7, 1), (8, 0), (1, 0)], "doc_id long, toxic int"))
    got = X.score(df, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert X.score(make([]), model).count() == 0
    assert X.train(make([]), spark.createDataFrame([(4, 1)], "doc_id long, toxic int")) is None


def test_risk_estimate_stays_non_negative():
    """Few positives and many epochs: the corrected part is not driven far below zero."""
    rng = np.random.default_rng(0)
    p = [np.array(sorted({*rng.integers(0, 50, 5).tolist(), 60})) for _ in range(40)]
    u = [np.array(sorted({*rng.integers(0, 50, 5).tolist(), *([60] if rng.random() < .2 else [])})) for _ in range(400)]
    w, bias = X.fit_nnpu(p, u, 0.2, np.ones(64), epochs=60)
    z = lambda rows: 1 / (1 + np.exp(-X._scores(rows, w, bias)))
    assert z(u).mean() - 0.2 * z(p).mean() > -0.05
    assert w[60] > 2 * np.abs(w[:50]).mean()


def test_features():
    assert len(X.features(None)) == len(X.features(b"")) == 0
    assert np.array_equal(X.features("Été-ABC abc".encode()), X.features("abc Été".encode()))
