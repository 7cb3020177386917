"""Proposals on a known surface; halving with resumed boosters."""

import math
import random
from statistics import mean

import pytest
from pyspark.sql import functions as F

from sievekit.plans import search as S
from sievekit.plans import softmax_boost as B
from tests.test_softmax_boost import frame, rings

SPACE = {"rate": S.Range(0.02, 0.2, log=True), "depth": S.Range(4, 12, step=1), "subsample": S.Range(0.6, 1.0),
         "rounds": S.Range(400, 1400, step=200)}


def surface(p):
    return -(math.log(p["rate"] / 0.05) ** 2 + ((p["depth"] - 7) / 4) ** 2 + (5 * (p["subsample"] - 0.85)) ** 2
             + ((p["rounds"] - 1000) / 600) ** 2)


def test_ranges():
    space = S.booster_space()
    assert set(space) == {"rate", "depth", "min_child", "subsample", "columns", "min_gain", "rounds", "l1", "l2"}
    for r in space.values():
        for share in (0.0, 0.37, 0.999, 1.0):
            assert r.low <= r.value(share) <= r.high
        assert r.value(r.share(r.value(0.37))) == pytest.approx(r.value(0.37))
    rng = random.Random(1)
    assert {space["rounds"].value(rng.random()) for _ in range(500)} == {400, 600, 800, 1000, 1200, 1400}
    assert {space["depth"].value(rng.random()) for _ in range(500)} == set(range(4, 13))


def best_found(seed, adaptive):
    p = S.Proposals(SPACE, seed, startup=8 if adaptive else 10**9)
    for _ in range(40):
        params = p.ask()
        p.tell(params, surface(params))
    return max(v for _, v in p.seen)


def test_proposals_beat_random_search():
    adaptive, plain = ([best_found(seed, a) for seed in range(30)] for a in (True, False))
    assert mean(adaptive) > mean(plain) / 2                     # both are below 0
    assert sum(a > b for a, b in zip(adaptive, plain)) >= 20
    assert best_found(3, True) == best_found(3, True)


def test_resumed_is_the_same(spark):
    x, y = rings(150, 7)
    df = frame(spark, x, y)
    s = B.Settings(rounds=11, depth=2, max_bins=8, subsample=0.8, columns=0.7)
    fit = B._Fit(df.withColumn("v", F.col("id") % 5 == 0), 3, "label_idx", "features", "id", "v", s)
    for n in (1, 2, 8):
        fit.advance(n)
    whole, _ = B.fit_softmax(df.where("id % 5 <> 0"), 3, "id", **s.__dict__)
    assert fit.done + fit.since == whole.rounds()
    scores = fit.validation()
    assert scores["log_loss"] == pytest.approx(whole.prefix_log_loss(df.where("id % 5 = 0"), "label_idx")[-1], abs=1e-6)


def test_halving(spark):
    x, y = rings(150, 8)
    df = frame(spark, x, y).withColumn("fold", (F.col("id") % 2).cast("int"))
    space = {"rate": S.Range(0.001, 1.0, log=True), "depth": S.Range(1, 3, step=1), "rounds": S.Range(4, 6, step=2)}
    trials = S.halving_search(df, 3, "id", space=space, brackets=1, width=4, eta=2, folds=2, seed=3)
    assert sorted(len(t.rungs) for t in trials) == [1, 1, 2, 3]
    best = S.best_trial(trials)
    assert best.rungs[-1][0] == best.params["rounds"]
    worst = min(trials, key=lambda t: t.rungs[0][1])
    assert len(worst.rungs) == 1
    table = S.trial_table(spark, trials)
    assert table.count() == 7 and table.where("rung = 0").count() == 4
    model = S.refit(df, best, 3, "id", seed=3)
    assert len(model.rounds()) == best.params["rounds"]
