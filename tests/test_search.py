"""The sampler on known functions, the rules that end a search, and a search over leaf-wise trees."""

import math
import random

import pytest

from scoreloom.operators import search
from scoreloom.operators.boosting import Leafwise
from scoreloom.operators.search import SPACE, Dimension, best_trial, parzen_search, run_trials

BOX = {"x": Dimension(-5, 5), "rate": Dimension(1e-3, 1.0, log=True), "n": Dimension(1, 40, whole=True)}


def bowl(s, fold=0):
    return -((s["x"] - 1.7) ** 2) - (math.log10(s["rate"]) + 2) ** 2 - ((s["n"] - 12) / 10) ** 2


def test_beats_random_points_of_equal_number():
    better, gaps = 0, []
    for seed in range(20):
        found = best_trial(run_trials(bowl, BOX, 60, seed=seed, patience=None)[0]).score
        rng = random.Random(seed)
        blind = max(bowl({k: d.outward(rng.random()) for k, d in BOX.items()}) for _ in range(60))
        better += found > blind
        gaps.append(found - blind)
    assert better >= 15 and sum(gaps) > 0


def test_proposals_stay_inside():
    done, ended = run_trials(bowl, BOX, 40, patience=None)
    assert ended == "trials" and len(done) == 40
    for t in done:
        assert all(BOX[k].low <= v <= BOX[k].high for k, v in t.settings.items()) and t.settings["n"] == int(t.settings["n"])
    assert [t.settings for t in done] == [t.settings for t in run_trials(bowl, BOX, 40, patience=None)[0]]


def test_stops_without_gain():
    """Falling scores stop the search after the patience, rising ones never do."""
    n = iter(range(1000))
    done, ended = run_trials(lambda s, f: -next(n), BOX, 50, patience=10)
    assert (ended, len(done)) == ("no gain", 11)
    n = iter(range(1000))
    assert run_trials(lambda s, f: next(n), BOX, 30, patience=3)[1] == "trials"


def test_stops_by_time():
    now = [0.0]

    def slow(settings, fold):
        now[0] += 10
        return bowl(settings)

    done, ended = run_trials(slow, BOX, 50, folds=3, seconds=75, patience=None, clock=lambda: now[0])
    assert ended == "seconds" and len(done) == 3
    assert [(t.reason, len(t.scores)) for t in done] == [("complete", 3), ("complete", 3), ("seconds", 2)]


def test_prunes_by_fold():
    scores = iter([5, 5, 5, 6, 6, 6, 7, 7, 7, 1, 6.5, 6.5, 6.5])
    first = [{"x": 0.0, "rate": 0.1, "n": 1}] * 5
    done, _ = run_trials(lambda s, f: next(scores), BOX, 5, folds=3, first=first, prune_after=3)
    assert [(t.reason, len(t.scores)) for t in done] == [("complete", 3)] * 3 + [("pruned", 1), ("complete", 3)]
    assert best_trial(done) is done[2]


def test_search_over_trees(spark):
    rng = random.Random(1)
    rows = [(i, rng.random(), rng.random()) for i in range(400)]
    rows = [(i, a, b, int(rng.random() < (0.9 if a > 0.6 else 0.1))) for i, a, b in rows]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    first = [
        {"n_estimators": 1, "learning_rate": 0.01, "num_leaves": 2, "scale_pos_weight": 1.0},
        {"n_estimators": 3, "learning_rate": 0.5, "num_leaves": 4, "scale_pos_weight": 1.0},
    ]
    space = {k: SPACE[k] for k in first[0]}
    found = parzen_search(df, ["a", "b"], "y", ["id"], trials=2, folds=2, space=space, first=first)
    table = {r["trial"]: r for r in found.table.collect()}
    assert table[0]["fbeta"] == 0.0 and table[1]["fbeta"] > 0.8 and table[1]["reason"] == "complete"
    assert found.settings == first[1] and found.ended == "trials" and len(found.model.trees) == 3


def test_nine_dimensions():
    assert len(SPACE) == 9
    with pytest.raises(KeyError):
        SPACE["rate"]


def test_equal_rows_are_counted(spark, monkeypatch):
    """The rows of a search over trees that see all rows are as many as there are bins, and give the same scores."""
    rng = random.Random(2)
    rows = [(i, rng.randrange(2), rng.randrange(3)) for i in range(900)]
    df = spark.createDataFrame([(i, a, b, int(rng.random() < 0.2 + 0.3 * a + 0.2 * b)) for i, a, b in rows], "id int, a int, b int, y int")
    seen, fit = [], search.fit_binned
    monkeypatch.setattr(search, "fit_binned", lambda part, *how: seen.append(part.count()) or fit(part, *how))
    first = [{"learning_rate": 0.3, "scale_pos_weight": 2.0}, {"learning_rate": 0.1, "scale_pos_weight": 1.5}]
    how = {"trials": 2, "folds": 2, "space": {k: SPACE[k] for k in first[0]}, "first": first}
    fixed = {"n_estimators": 3, "num_leaves": 5, "reg_lambda": 0.5}
    counted = parzen_search(df, ["a", "b"], "y", ["id"], fixed=fixed, **how)
    assert max(seen) <= 24
    by_row = parzen_search(df, ["a", "b"], "y", ["id"], fixed=fixed | {"subsample": 1.0}, **how)
    assert seen[-1] == 900 and counted.table.collect() == by_row.table.collect() and counted.model.trees == by_row.model.trees
    with pytest.raises(ValueError):
        edges = [[0.5], [0.5]]
        search.fit_binned(spark.sql("SELECT array(1S, 1S) AS b, 1 AS y, 2L AS n"), edges, ["a", "b"], Leafwise(subsample=0.5))
