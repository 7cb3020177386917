"""Adaptive and budgeted search over the booster's parameters.

Only the table of trials is on the driver. *Proposals*: finished trials are
split into the best third and the rest; each parameter's values in either part
give a density (a mixture of normals on the parameter's own scale, and a uniform
one); of some settings drawn from the first the one with the largest ratio is tried.
*Budget*: successive halving. A bracket of trials runs a small share of its
rounds on every fold, the best ``1 / eta`` of them go on, resumed from the
margins they have, until one has run in full. Trials of a bracket are proposed
from the values that all earlier ones had after the same share.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from sievekit.functions.names import col
from sievekit.plans.softmax_boost import Settings, SoftmaxBoost, _Fit, fit_softmax
from sievekit.plans.training import BOOSTER_SPACE


@dataclass(frozen=True)
class Range:
    """A parameter's values: ``low`` to ``high``, on a logarithmic scale, or whole steps."""

    low: float
    high: float
    log: bool = False
    step: int = 0

    def value(self, share: float) -> float:
        """The value at ``share`` (0 to 1) of the range."""
        if self.log:
            return min(self.high, math.exp(math.log(self.low) + share * (math.log(self.high) - math.log(self.low))))
        if self.step:
            n = int((self.high - self.low) // self.step) + 1
            return int(self.low + self.step * min(int(share * n), n - 1))
        return self.low + share * (self.high - self.low)

    def share(self, value: float) -> float:
        if self.log:
            return (math.log(value) - math.log(self.low)) / (math.log(self.high) - math.log(self.low))
        if self.step:
            n = int((self.high - self.low) // self.step) + 1
            return ((value - self.low) / self.step + 0.5) / n
        return (value - self.low) / (self.high - self.low)


def booster_space() -> dict[str, Range]:
    """The whole booster space with its L1 and L2 penalties (0 to 5)."""
    out = {}
    for name, bounds in BOOSTER_SPACE.items():
        out[name] = Range(*bounds[:2], log=name == "rate", step=bounds[2] if len(bounds) > 2 else int(name == "depth"))
    return out | {"l1": Range(0.0, 5.0), "l2": Range(0.0, 5.0)}


class Proposals:
    """Density-ratio proposals; larger values are better."""

    def __init__(self, space: dict[str, Range], seed: int = 42, startup: int = 8, draws: int = 8):
        self.space, self.rng, self.startup, self.draws = space, random.Random(seed), startup, draws
        self.seen: list[tuple[dict, float]] = []

    def tell(self, params: dict, value: float):
        self.seen.append((params, value))

    @staticmethod
    def _density(x: float, centres: Sequence[float], width: float) -> float:
        """Mixture of normals cut to 0..1 and one uniform part."""
        total = 1.0
        for c in centres:
            inside = 0.5 * (math.erf((1 - c) / width / math.sqrt(2)) - math.erf(-c / width / math.sqrt(2)))
            total += math.exp(-0.5 * ((x - c) / width) ** 2) / (width * math.sqrt(2 * math.pi) * inside)
        return total / (len(centres) + 1)

    def _draw(self, centres: Sequence[float], width: float) -> float:
        if self.rng.random() * (len(centres) + 1) < 1:
            return self.rng.random()
        while True:
            x = self.rng.gauss(self.rng.choice(centres), width)
            if 0 <= x <= 1:
                return x

    def ask(self) -> dict:
        if len(self.seen) < self.startup:
            return {n: r.value(self.rng.random()) for n, r in self.space.items()}
        ranked = sorted(self.seen, key=lambda t: -t[1])
        cut = max(2, math.ceil(len(ranked) / 3))
        parts = {}
        for name, r in self.space.items():
            for_, against = ([r.share(p[name]) for p, _ in part] for part in (ranked[:cut], ranked[cut:]))
            parts[name] = for_, against, *(max(0.1, min(0.3, 1.06 * _spread(x) * len(x) ** -0.2)) for x in (for_, against))
        best, best_ratio = {}, -math.inf
        for _ in range(self.draws):
            shares = {name: self._draw(good, width) for name, (good, _, width, _) in parts.items()}
            ratio = sum(math.log(self._density(x, parts[n][0], parts[n][2]) / self._density(x, parts[n][1], parts[n][3]))
                        for n, x in shares.items())
            if ratio > best_ratio:
                best, best_ratio = shares, ratio
        return {name: r.value(best[name]) for name, r in self.space.items()}


def _spread(xs: Sequence[float]) -> float:
    mean = sum(xs) / max(len(xs), 1)
    return math.sqrt(sum((x - mean) ** 2 for x in xs) / max(len(xs) - 1, 1))


@dataclass
class Trial:
    number: int
    params: dict
    folds: list = field(default_factory=list)
    rungs: list = field(default_factory=list)       # (rounds run, mean weighted F1, mean log-loss)

    @property
    def value(self) -> float:
        return self.rungs[-1][1]


def _settings(params: dict, seed: int) -> Settings:
    return Settings(**{k: v for k, v in params.items() if k in Settings.__dataclass_fields__}, seed=seed)


def halving_search(train: DataFrame, n_classes: int, id_col: str, fold_col: str = "fold", label_col: str = "label_idx",
                   features_col: str = "features", space: dict[str, Range] | None = None, brackets: int = 3, width: int = 9,
                   eta: int = 3, folds: int = 5, seed: int = 42, parallelism: int = 4) -> list[Trial]:
    """M9: all trials, ``width`` per bracket; the value is the mean weighted F1
    over the folds of column ``fold_col``. ``train`` should be a stored table."""
    space = space or booster_space()
    proposals, trials = Proposals(space, seed), []
    last = max(0, math.ceil(math.log(width, eta) - 1e-9))

    def start(trial: Trial, fold: int):
        marked = train.withColumn("_is_val", col(fold_col) == fold)
        return _Fit(marked, n_classes, label_col, features_col, id_col, "_is_val", _settings(trial.params, seed))

    def go_on(fit: _Fit, rounds: int) -> dict:
        fit.advance(rounds - len(fit.done) - len(fit.since))
        return fit.validation()

    with ThreadPoolExecutor(parallelism) as pool:
        for _ in range(brackets):
            bracket = []
            for _ in range(width):
                bracket.append(Trial(len(trials) + len(bracket), proposals.ask()))
            for trial in bracket:
                trial.folds = list(pool.map(lambda f, t=trial: start(t, f), range(folds)))
            going = bracket
            for rung in range(last + 1):
                for trial in going:
                    rounds = max(1, math.ceil(trial.params["rounds"] * eta ** (rung - last)))
                    scores = list(pool.map(lambda fit, n=rounds: go_on(fit, n), trial.folds))
                    trial.rungs.append((rounds, *(sum(s[m] for s in scores) / folds for m in ("weighted_f1", "log_loss"))))
                    if rung == 0:
                        proposals.tell(trial.params, trial.value)
                going = sorted(going, key=lambda t: (-t.value, t.number))[:max(1, len(going) // eta)]
            for trial in bracket:
                trial.folds = []
            trials += bracket
    return trials


def best_trial(trials: Sequence[Trial]) -> Trial:
    """The best of those that ran in full (first on ties)."""
    full = max(len(t.rungs) for t in trials)
    return max((t for t in trials if len(t.rungs) == full), key=lambda t: (t.value, -t.number))


def trial_table(spark, trials: Sequence[Trial]) -> DataFrame:
    """One row per trial and rung."""
    rows = [(t.number, i, n, f1, loss, {k: float(v) for k, v in t.params.items()})
            for t in trials for i, (n, f1, loss) in enumerate(t.rungs)]
    return spark.createDataFrame(rows, "trial int, rung int, rounds int, weighted_f1 double, log_loss double, params map<string,double>")


def refit(train: DataFrame, trial: Trial, n_classes: int, id_col: str, label_col: str = "label_idx",
          features_col: str = "features", seed: int = 42) -> SoftmaxBoost:
    """The best trial's parameters on the whole training split."""
    s = _settings(trial.params, seed)
    return fit_softmax(train, n_classes, id_col, label_col, features_col, **s.__dict__)[0]
