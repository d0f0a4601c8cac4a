import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from catalog import modelling as queries
from scoreloom.operators import boosting, metrics
from scoreloom.operators import modelling as ml

FEATURES = ["x", "z", "m"]


@pytest.fixture(scope="module")
def rows(spark):
    rng, data = random.Random(4), []
    for i in range(2400):
        x, z, m = float(rng.randrange(9)), float(rng.randrange(5)), float(rng.randrange(3))
        rate = 0.1 + 0.35 * (x > 5) + 0.2 * (x == 2) + 0.2 * (z > 2) + 0.1 * (m > 1)
        data.append((i, x, z, None if i % 7 == 0 else m, int(rng.random() < rate)))
    return spark.createDataFrame(data, "id int, x double, z double, m double, y int")


def test_all_algorithms_are_fitted_on_counted_rows(rows, monkeypatch):
    """Nothing is laid out row by row, and every set is scored once for each distinct row."""
    def never(*_):
        raise AssertionError("rows are laid out")

    monkeypatch.setattr(ml, "laid_out", never)
    train, test = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    sizes, keep = [], ml.set_metrics
    monkeypatch.setattr(ml, "set_metrics", lambda p, *how: sizes.append(p.count()) or keep(p, *how))
    found = ml.algorithm_bakeoff(train, test, FEATURES, "y", ml.bakeoff_algorithms(leafwise=True)).collect()
    assert len(found) == 8 and {(r["set"], r["algorithm"]) for r in found} == {
        (s, a) for s in ("Treino", "Teste") for a in ("decision_tree", "random_forest", "boosted_trees", "leaf_wise_trees")
    }
    distinct = train.select(*FEATURES, "y").distinct().count() + test.select(*FEATURES, "y").distinct().count()
    assert sizes == [distinct] * 4 and all(r["auc"] > 0.7 for r in found)


@pytest.mark.parametrize("learner", [DecisionTreeClassifier, GBTClassifier])
def test_leaves_hold_as_many_rows_as_asked(rows, learner):
    """Counted rows with a least weight make the trees that Spark's learner grows over the rows themselves."""
    how = {"maxDepth": 5, "minInstancesPerNode": 40, **({"maxIter": 3} if learner is GBTClassifier else {})}
    rows = rows.na.fill({"m": 9.0})
    model = ml.fit_classifier(rows, FEATURES, learner(**how), "y")
    filled = ml.assembler(FEATURES).transform(rows)
    plain, after = ml.by_rates(learner(**how, labelCol="y", featuresCol=ml.FEATURES))
    expected = plain.setFeaturesCol(ml.FEATURES).fit(filled).transform(filled)
    for stage in after:
        expected = stage.transform(expected)
    expected = expected.select("id", ml.vector_to_array("probability")[1].alias("p")).orderBy("id").collect()
    got = ml.scored(model, rows, ["id"]).orderBy("id").collect()
    assert max(abs(a["p"] - b["p"]) for a, b in zip(got, expected)) < 1e-9


def counted(rows):
    stages, names, cut = ml.cut_up(rows.na.fill({"m": 9.0}), FEATURES, 32)
    return stages, names, ml.cells(cut.select(*names, "y")), [len(s) for s in stages[0].getSplitsArray()]


def test_forest_without_chance_is_a_tree(rows):
    stages, names, table, sizes = counted(rows)
    forest = RandomForestClassifier(numTrees=3, maxDepth=4, minInstancesPerNode=3, bootstrap=False, featureSubsetStrategy="all")
    tree = DecisionTreeClassifier(maxDepth=4, minInstancesPerNode=3)
    got = ml.scored(ml.fit_forest(table, names, sizes, forest, "y"), table, [*names, "y"])
    expected = ml.scored(ml.fit_cells(table, [], names, tree, "y"), table, [*names, "y"])
    keys = [*names, "y"]
    got, expected = ([(r["p"], r["prediction"]) for r in d.orderBy(*keys).collect()] for d in (got, expected))
    assert max(abs(a[0] - b[0]) for a, b in zip(got, expected)) < 1e-9 and [a[1] for a in got] == [b[1] for b in expected]


def test_forest_draws_rows_and_features(rows):
    """Its trees differ, and it ranks as Spark's forest over the rows does."""
    stages, names, table, sizes = counted(rows)
    forest = RandomForestClassifier(numTrees=20, maxDepth=4, minInstancesPerNode=3, seed=5)
    model = ml.fit_forest(table, names, sizes, forest, "y")
    assert len({str(t) for t in model.trees}) == 20
    assert len({t.feature for t in model.trees}) > 1 and 2200 < sum(t.rows for t in model.trees) / 20 < 2600
    rows = rows.na.fill({"m": 9.0})
    auc = metrics.ranking_metrics(ml.scored(model, stages[0].transform(rows), ["y"]), "p", "y").first()["auc"]
    theirs = ml.fit_classifier(rows, FEATURES, forest, "y")
    expected = metrics.ranking_metrics(ml.scored(theirs, rows, ["y"]), "p", "y").first()["auc"]
    assert abs(auc - expected) < 0.01


def test_metrics_of_counted_rows(spark):
    once = spark.createDataFrame([("a", 0.2, 1, 0, 3), ("a", 0.7, 1, 1, 2), ("a", 0.7, 0, 1, 4), ("b", 0.1, 0, 0, 5), ("b", 0.9, 1, 1, 1)],
                                 "set string, p double, y int, prediction int, n int")
    rows = once.select("*", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("copy"))
    found = [ml.set_metrics(d, "y", c).orderBy("set").collect() for d, c in ((once, "n"), (rows, None))]
    assert found[0] == found[1]


def test_a_leaf_wise_tree_takes_as_many_rounds_as_it_is_deep(rows, monkeypatch):
    """It took a round for every one or two leaves."""
    table, edges = boosting.binned_rows(rows, FEATURES, "y", [])
    asked, sums = [], boosting._sums
    monkeypatch.setattr(boosting, "_sums", lambda *a: asked.append(1) or sums(*a))
    model = boosting.fit_binned(table, edges, FEATURES, boosting.Leafwise(n_estimators=1, num_leaves=31, max_depth=6, min_child_samples=3))
    assert sum(1 for n in boosting._nodes(model.trees[0]) if not n.left) > 20 and len(asked) <= 8


def test_the_query_asks_for_the_algorithms_as_they_are(spark, monkeypatch):
    """It gave the leaf-wise trees three rounds and another rate."""

    class Asked(Exception):
        pass

    def asked(train, test, features, target, algorithms):
        raise Asked(algorithms)

    monkeypatch.setattr(ml, "algorithm_bakeoff", asked)
    with pytest.raises(Asked) as found:
        queries.algorithm_bakeoff(spark, "/root/testdata/sf0.001")
    algorithms, usual = found.value.args[0], ml.bakeoff_algorithms(leafwise=True)
    assert list(algorithms) == list(usual) and algorithms["leaf_wise_trees"] == usual["leaf_wise_trees"]
    for name in ("decision_tree", "random_forest", "boosted_trees"):
        assert [(p.name, v) for p, v in algorithms[name].extractParamMap().items() if not p.name.endswith("Col")] == [
            (p.name, v) for p, v in usual[name].extractParamMap().items() if not p.name.endswith("Col")
        ]
