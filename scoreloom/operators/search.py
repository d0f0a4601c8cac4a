"""Search of settings for leaf-wise trees by a tree-structured Parzen sampler, with pruning and stopping.

The sampler splits the trials so far into the better and the others, takes a density over each (a Gaussian around every
trial, and a uniform prior), draws points from the density of the better ones and tries the one where the ratio of both
densities is largest. Trials run one after the other, each on the whole cluster; only their scores come to the driver.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from statistics import median

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.operators import boosting
from scoreloom.operators.boosting import LeafwiseModel, binned_rows, fit_binned, settings_of
from scoreloom.operators.sampling import stratified_folds
from scoreloom.session import written


@dataclass(frozen=True)
class Dimension:
    low: float
    high: float
    whole: bool = False
    log: bool = False

    def inward(self, x: float) -> float:
        """The value on the scale on which densities are taken, from 0 to 1."""
        low, high, x = (math.log(v) if self.log else v for v in (self.low, self.high, x))
        return (x - low) / (high - low) if high > low else 0.5

    def outward(self, u: float) -> float:
        low, high = (math.log(v) if self.log else v for v in (self.low, self.high))
        x = low + min(max(u, 0.0), 1.0) * (high - low)
        x = min(max(math.exp(x) if self.log else x, self.low), self.high)
        return float(round(x)) if self.whole else x


# The nine dimensions of the search, the trials, the share of rows and columns, and when to give up.
SPACE: dict[str, Dimension] = {
    "n_estimators": Dimension(5, 50, whole=True),
    "learning_rate": Dimension(0.01, 0.5, log=True),
    "num_leaves": Dimension(2, 128, whole=True),
    "max_depth": Dimension(3, 10, whole=True),
    "reg_alpha": Dimension(0.0, 1.0),
    "reg_lambda": Dimension(0.0, 1.0),
    "subsample": Dimension(0.5, 1.0),
    "colsample_bytree": Dimension(0.5, 1.0),
    "scale_pos_weight": Dimension(1.0, 30.0),
}
PATIENCE = 10


class Parzen:
    """Proposes settings, given the trials so far; higher scores are better."""

    def __init__(self, space: Mapping[str, Dimension], seed: int = 42, startup: int = 10, candidates: int = 24):
        self.space, self.startup, self.candidates = dict(space), startup, candidates
        self.random = np.random.Generator(np.random.PCG64(seed))

    def propose(self, trials: Sequence[tuple[Mapping[str, float], float]]) -> dict[str, float]:
        if len(trials) < self.startup:
            return {name: d.outward(self.random.random()) for name, d in self.space.items()}
        ranked = sorted(trials, key=lambda t: -t[1])
        better = max(1, min(25, math.ceil(0.15 * len(trials))))
        out = {}
        for name, d in self.space.items():
            good, rest = (np.array([d.inward(s[name]) for s, _ in part]) for part in (ranked[:better], ranked[better:]))
            drawn = self._draw(good)
            ratio = self._density(drawn, good) - self._density(drawn, rest)
            out[name] = d.outward(float(drawn[int(np.argmax(ratio))]))
        return out

    @staticmethod
    def _widths(points: np.ndarray) -> np.ndarray:
        """Of each Gaussian: the larger distance to a neighbour, within limits that shrink with the number of trials."""
        order = np.argsort(points)
        edges = np.concatenate([[0.0], points[order], [1.0]])
        gaps = np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1])
        out = np.empty(len(points))
        out[order] = np.clip(gaps, 1.0 / min(100, 1 + len(points)) / 2, 1.0)
        return out

    def _draw(self, points: np.ndarray) -> np.ndarray:
        which = self.random.integers(0, len(points) + 1, self.candidates)  # the last is the prior
        centre, width = np.append(points, 0.5)[which], np.append(self._widths(points), 1.0)[which]
        out = self.random.normal(centre, width)
        for _ in range(8):
            outside = (out < 0) | (out > 1)
            out[outside] = self.random.normal(centre[outside], width[outside])
        prior = which == len(points)
        out[prior] = self.random.random(int(prior.sum()))
        return np.clip(out, 0.0, 1.0)

    def _density(self, at: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Logarithm of the mixture's density; a Gaussian counts as far as it lies between 0 and 1."""
        if not len(points):
            return np.zeros(len(at))
        width = self._widths(points)
        erf = np.vectorize(math.erf)
        inside = 0.5 * (erf((1 - points) / width / math.sqrt(2)) - erf(-points / width / math.sqrt(2)))
        bells = np.exp(-0.5 * ((at[:, None] - points) / width) ** 2) / (width * math.sqrt(2 * math.pi) * np.maximum(inside, 1e-12))
        return np.log((bells.sum(axis=1) + 1.0) / (len(points) + 1))


@dataclass
class Trial:
    settings: dict[str, float]
    scores: list[float] = field(default_factory=list)  # by fold
    reason: str = "complete"
    seconds: float = 0.0

    @property
    def score(self) -> float:
        return sum(self.scores) / len(self.scores)


def run_trials(
    evaluate: Callable[[Mapping[str, float], int], float],
    space: Mapping[str, Dimension],
    trials: int,
    folds: int = 1,
    seed: int = 42,
    first: Sequence[Mapping[str, float]] = (),
    seconds: float | None = None,
    patience: int | None = PATIENCE,
    prune_after: int = 5,
    startup: int = 10,
    clock: Callable[[], float] = time.monotonic,
) -> tuple[list[Trial], str]:
    """Trials of ``evaluate(settings, fold)`` and why they ended: ``trials``, ``seconds`` or ``no gain``.

    ``first`` are tried before what the sampler proposes. After each fold but the last a trial is pruned when its mean so
    far lies below the median of the complete trials' means over as many folds, once there are ``prune_after`` of them.
    ``no gain``: ``patience`` trials in a row have not raised the best score. A trial that is cut off by the time
    limit has the reason ``seconds``, and its mean counts only if no trial is complete.
    """
    sampler, done, start, best, idle = Parzen(space, seed, startup), [], clock(), -math.inf, 0
    for number in range(trials):
        known = [(t.settings, t.score) for t in done if t.scores]
        trial, began = Trial(dict(first[number]) if number < len(first) else sampler.propose(known)), clock()
        done.append(trial)
        for fold in range(folds):
            trial.scores.append(evaluate(trial.settings, fold))
            if fold + 1 < folds and seconds is not None and clock() - start >= seconds:
                trial.reason = "seconds"
                break
            others = [sum(t.scores[: fold + 1]) / (fold + 1) for t in done[:-1] if t.reason == "complete"]
            if fold + 1 < folds and len(others) >= prune_after and trial.score < median(others):
                trial.reason = "pruned"
                break
        trial.seconds = clock() - began
        gained = trial.reason == "complete" and trial.score > best
        best, idle = (trial.score, 0) if gained else (best, idle + 1)
        if seconds is not None and clock() - start >= seconds:
            return done, "seconds"
        if patience is not None and idle >= patience:
            return done, "no gain"
    return done, "trials"


def best_trial(done: Sequence[Trial]) -> Trial:
    """The best complete trial; of equals the first."""
    complete = [t for t in done if t.reason == "complete"] or list(done)
    return max(complete, key=lambda t: t.score)


@dataclass(frozen=True)
class LeafwiseSearch:
    """Result of ``parzen_search``: the refitted model, its settings, all trials, and why the search ended."""

    model: LeafwiseModel
    settings: dict[str, float]
    table: DataFrame
    ended: str


def parzen_search(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keys: Sequence[str],
    trials: int = 100,
    folds: int = 5,
    beta: float = 1.3,
    space: Mapping[str, Dimension] = SPACE,
    fixed: Mapping[str, float] | None = None,
    **how,
) -> LeafwiseSearch:
    """Search the settings of leaf-wise trees by F-beta over stratified folds and refit the best on all rows.

    Bins are cut once, over all training rows, and equal rows are counted unless trees may see a share of the rows.
    ``fixed`` are settings outside the search; ``how`` goes to ``run_trials``. The table has a row per trial with its settings, its mean score, the folds run and the reason.
    """
    # the rows that a tree sees depend on their keys only where it sees a share of them
    shares = any("subsample" in some for some in (space, fixed or {}, *how.get("first", ())))
    kept = keys if shares else []
    folded = stratified_folds(df.select(*dict.fromkeys([*keys, *features, target])), target, keys, folds)
    folded = written(folded.select(*dict.fromkeys([*kept, *features, target, "fold"])), "folds")
    rows, edges = binned_rows(folded, [*features, "fold"], target, kept)
    fold_edges = edges.pop()
    own_fold = F.get("b", F.lit(len(features))).cast("int")
    rows = written(rows.withColumn("fold", own_fold - 1).withColumn("b", F.slice("b", 1, len(features))), "binned")
    if len(fold_edges) != folds - 1:
        raise ValueError("some folds have no rows")

    def model_of(settings: Mapping[str, float], part: DataFrame) -> LeafwiseModel:
        return fit_binned(part, edges, features, settings_of({**(fixed or {}), **settings}))

    def evaluate(settings: Mapping[str, float], fold: int) -> float:
        model = model_of(settings, rows.where(F.col("fold") != fold))
        held = boosting._scored(rows.where(F.col("fold") == fold).withColumn("score", F.lit(model.start)), model.trees)
        said = F.col("score") > 0
        copies = boosting._copies(rows)
        hit, called, events = held.agg(
            F.sum((said & (F.col("y") == 1)).cast("long") * copies), F.sum(said.cast("long") * copies), F.sum(F.col("y") * copies)
        ).first()
        # F-beta from counts; nothing called or nothing to call is 0
        return (1 + beta**2) * hit / (beta**2 * events + called) if hit else 0.0

    done, ended = run_trials(evaluate, space, trials, folds, **how)
    best = best_trial(done)
    names = list(dict.fromkeys(name for t in done for name in t.settings))
    table = df.sparkSession.createDataFrame(
        [(i, *[float(t.settings[n]) for n in names], t.score, len(t.scores), t.reason) for i, t in enumerate(done)],
        "trial int, " + ", ".join(f"{n} double" for n in names) + ", fbeta double, folds int, reason string",
    )
    return LeafwiseSearch(model_of(best.settings, rows), best.settings, table.orderBy(F.desc("fbeta"), "trial"), ended)
