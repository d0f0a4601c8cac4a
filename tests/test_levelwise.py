import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from catalog import modelling as queries
from scoreloom.operators import levelwise
from scoreloom.operators import modelling as ml

FEATURES = ["x", "z", "m"]
EVERYTHING = {"maxIter": 4, "stepSize": 0.3, "maxDepth": 3, "subsamplingRate": 1.0, "featureShare": 1.0, "positiveWeight": 1.7}


@pytest.fixture(scope="module")
def rows(spark):
    """Rates that go up and down with ``x``; ``m`` is missing in some rows."""
    rng, data = random.Random(3), []
    for i in range(3000):
        x, z, m = float(rng.randrange(12)), float(rng.randrange(5)), float(rng.randrange(3))
        rate = 0.15 + 0.3 * (x > 6) + 0.2 * (x == 3) + 0.2 * (z > 2) + 0.1 * (m > 1)
        data.append((i, x, z, None if i % 7 == 0 else m, int(rng.random() < rate)))
    return spark.createDataFrame(data, "id int, x double, z double, m double, y int")


def test_search_fits_the_trees_of_spark(rows):
    """All rows and features: the refitted model is that of Spark's learner on the ordered numbers of the rows. With
    several jobs a level and fit, and bins taken for unordered names, the search had other trees."""
    found = ml.hyperparameter_search(rows, FEATURES, "y", ["id"], folds=3, settings=[EVERYTHING])
    weighted = rows.withColumn("w", F.when(F.col("y") == 1, 1.7).otherwise(1.0)).withColumn("m", F.coalesce("m", F.lit(99.0)))
    learner = GBTClassifier(maxIter=4, stepSize=0.3, maxDepth=3, weightCol="w", labelCol="y", featuresCol=ml.FEATURES)
    theirs = learner.fit(ml.assembler(FEATURES).transform(weighted))
    expected = ml.scored(theirs, ml.assembler(FEATURES).transform(weighted), ["id"]).orderBy("id").collect()
    got = ml.scored(found.model, rows, ["id"]).orderBy("id").collect()
    assert max(abs(a["p"] - b["p"]) for a, b in zip(got, expected)) < 1e-9
    assert [a["prediction"] for a in got] == [b["prediction"] for b in expected]


def test_search_scores_held_out_rows_of_each_fold(rows):
    """The F-beta of a trial is the mean over the folds of models that have not seen them."""
    found = ml.hyperparameter_search(rows, FEATURES, "y", ["id"], folds=3, settings=[EVERYTHING, {**EVERYTHING, "maxIter": 1}])
    filled = rows.withColumn("w", F.when(F.col("y") == 1, 1.7).otherwise(1.0)).withColumn("m", F.coalesce("m", F.lit(99.0)))
    folded = ml.stratified_folds(filled, "y", ["id"], 3).cache()
    for trial, trees in ((0, 4), (1, 1)):
        learner = GBTClassifier(maxIter=trees, stepSize=0.3, maxDepth=3, weightCol="w", labelCol="y", featuresCol=ml.FEATURES)
        scores = []
        for fold in range(3):
            model = learner.fit(ml.assembler(FEATURES).transform(folded.where(F.col("fold") != fold)))
            said = ml.scored(model, ml.assembler(FEATURES).transform(folded.where(F.col("fold") == fold)), ["y"])
            scores.append(ml.metrics.classification_metrics(said, "y", F.col("prediction"), beta=ml.BETA).first()["fbeta"])
        got = found.table.where(F.col("trial") == trial).first()["fbeta"]
        assert got == pytest.approx(sum(scores) / 3, abs=1e-12)


def test_all_models_of_a_search_are_fitted_side_by_side(rows, monkeypatch):
    """One call for trials times folds and one for the best; the same search again, from other partitions, is the same."""
    asked, keep = [], levelwise.fitted
    monkeypatch.setattr(levelwise, "fitted", lambda blocks, sizes, models, trees=False: asked.append(len(models)) or keep(blocks, sizes, models, trees))
    settings = [{**s, "maxIter": 3, "maxDepth": 3} for s in ml.random_settings(4)]
    tables = [
        ml.hyperparameter_search(rows.repartition(n), FEATURES, "y", ["id"], folds=3, settings=settings).table.collect() for n in (2, 7)
    ]
    assert asked == [12, 1, 12, 1] and tables[0] == tables[1] and len(tables[0]) == 4


def test_the_query_runs_the_whole_job(spark, monkeypatch):
    """The registered query asks for the job's hundred trials over five folds; it ran three small ones over two."""

    class Asked(Exception):
        pass

    def asked(blocks, sizes, models, trees=False):
        raise Asked([(how, fold) for how, fold in models])

    monkeypatch.setattr(levelwise, "fitted", asked)
    with pytest.raises(Asked) as found:
        queries.hyperparameter_search(spark, "/root/testdata/sf0.001")
    points = [levelwise.Settings.of(s, ml.SEED) for s in ml.random_settings(100)]
    assert found.value.args[0] == [(p, fold) for p in points for fold in range(5)]


def blocks_of(table: np.ndarray, counts: np.ndarray, size: int) -> list[dict]:
    out = []
    for k in range(0, table.shape[1], size):
        part = table[:, k:k + size]
        out.append({
            "place": k, "size": part.shape[1], "bins": part.tobytes() + bytes(-part.size % 4),
            "counts": np.ascontiguousarray(counts[:, k:k + size]).tobytes(),
        })
    return out


def test_a_task_with_many_cells_goes_through_files(monkeypatch):
    """The same trees whether blocks and scores are in memory or in files, whatever the order of arrival."""
    random = np.random.Generator(np.random.PCG64(5))
    table = random.integers(0, 9, (3, 1000)).astype(np.uint8)
    counts = random.integers(0, 6, (4, 1000)).astype(np.uint32)
    counts[2:] *= np.where(table[0] > 4, 2, 1).astype(np.uint32)
    how, found = levelwise.Settings(4, 0.2, 4, 0.7, 0.6, 2.0), []
    for limit in (levelwise.IN_MEMORY, 100):
        monkeypatch.setattr(levelwise, "IN_MEMORY", limit)
        blocks = blocks_of(table, counts, 130)
        cells = levelwise._Cells(iter(blocks[::-1] if limit == 100 else blocks), 3)
        assert (cells.file is None) == (limit > 100)
        fit = levelwise._Fit(cells, [10, 10, 10], how, 1).run()
        found.append(([[list(a) for a in vars(t).values()] for t in fit.trees], fit.counts()))
    assert found[0] == found[1]
    tp, fp, fn = found[0][1]
    assert tp + fn == counts[3].sum() and tp + fp <= counts[1].sum() + counts[3].sum()


def test_rows_are_drawn_one_by_one_out_of_a_cell():
    random = np.random.Generator(np.random.PCG64(1))
    n = np.concatenate([np.zeros(10, np.int64), np.ones(40_000, np.int64), np.full(40_000, 25)])
    got = levelwise._drawn(random, n, 0.6)
    assert (got <= n).all() and not got[:10].any()
    assert abs(got[10:40_010].mean() - 0.6) < 0.02 and abs(got[40_010:].mean() - 15) < 0.1
    assert abs(got[40_010:].var() - 25 * 0.6 * 0.4) < 0.3
    assert levelwise._drawn(random, n, 1.0) is n
