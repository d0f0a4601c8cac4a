import math
import random
from decimal import Decimal

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from scoreloom.operators import banding
from scoreloom.operators import modelling as ml
from scoreloom.plans import model_runs


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(800):
        x, z = rng.random(), rng.random()
        data.append((i, x, z, int(rng.random() < 0.1 + 0.8 * (x > 0.5))))
    return spark.createDataFrame(data, "id int, x double, z double, y int")


def test_tree_bins_cover_the_line(rows):
    bins = ml.tree_bins(rows, "x", "y", 5).orderBy("bin").collect()
    assert bins[0]["lower_bound"] == float("-inf") and bins[-1]["upper_bound"] == float("inf")
    assert sum(b["volume"] for b in bins) == 800 and 2 <= len(bins) <= 5
    assert all(a["upper_bound"] <= b["lower_bound"] for a, b in zip(bins, bins[1:]))
    applied = banding.apply_tree_bins(rows, "x", [b["upper_bound"] for b in bins[:-1]])
    assert {r[0] for r in applied.select("TFT_x").distinct().collect()} == set(range(len(bins)))


def test_scorecard_finds_the_signal(rows):
    card = ml.logistic_scorecard(rows, ["x", "z"], "y").collect()
    assert len(card) == 3 and card[0]["wald"] >= card[1]["wald"]
    found = {r["variable"]: r for r in card}
    assert found["x"]["p_value"] < 1e-6 < found["z"]["p_value"] and found["x"]["beta"] > 1


def test_selection_and_permutation(rows):
    chosen, table = ml.importance_selection(rows, ["x", "z"], "y", 0.3)
    assert chosen == ["x"] and table.first()["feature"] == "x"
    model = ml.fit_classifier(rows, ["x", "z"], DecisionTreeClassifier(maxDepth=2), "y")
    losses = {r["feature"]: r["importance"] for r in ml.permutation_importance(model, rows, ["x", "z"], "y", ["id"], 2).collect()}
    assert losses["x"] > 0.1 > abs(losses["z"])


def test_fits_do_not_depend_on_partitions(rows):
    found = [
        [r["importance"] for r in ml.importance_selection(rows.repartition(n), ["x", "z"], "y", 0.3)[1].orderBy("feature").collect()]
        for n in (4, 9)
    ]
    assert found[0] == found[1]


def test_tree_bins_have_as_many_leaves_as_asked(spark):
    data = [(float(x), int((x * 37 + k) % 10 < x)) for x in range(10) for k in range(40)]
    df = spark.createDataFrame(data, "x double, y int")
    for most in (2, 5, 7):
        bins = ml.tree_bins(df, "x", "y", most).orderBy("bin").collect()
        assert len(bins) == most and all(a["upper_bound"] == b["lower_bound"] for a, b in zip(bins, bins[1:]))
    assert ml.tree_bins(df.where("x < 0"), "x", "y").count() == 0
    assert ml.tree_bins(df.where("x = 1"), "x", "y").first()["volume"] == 40


def test_tree_bins_try_every_cut(spark):
    """A column that is nearly always 0, and one of more than 256 values, against a plain tree over all cuts."""
    skewed = [(0.0, int(k % 50 == 0)) for k in range(8000)] + [(float(v), int(k < (0, 5, 1, 5, 2)[v - 1])) for v in range(1, 6) for k in range(5)]
    wide = [(float(v), int((300 <= v < 303) or v % 7 == 0 or v > 880)) for v in range(900)]
    for data in (skewed, wide):
        values = sorted({x for x, _ in data})
        count = {v: [0, 0] for v in values}
        for x, y in data:
            count[x][0] += 1
            count[x][1] += y

        def impurity(part):
            n, e = (sum(count[v][c] for v in part) for c in (0, 1))
            return 2 * e * (n - e) / n if n else 0.0

        parts = [values]
        while len(parts) < 5:
            gain, cut, old = min((impurity(p[:k]) + impurity(p[k:]) - impurity(p), p[k], p) for p in parts for k in range(1, len(p)))
            assert gain < 0
            parts = sorted([p for p in parts if p is not old] + [[v for v in old if v < cut], [v for v in old if v >= cut]])
        df = spark.createDataFrame(data, "x double, y int")
        bins = ml.tree_bins(df, "x", "y", 5).orderBy("bin").collect()
        assert [b["volume"] for b in bins] == [sum(count[v][0] for v in p) for p in parts]
        assert [b["upper_bound"] for b in bins[:-1]] == [(a[-1] + b[0]) / 2 for a, b in zip(parts, parts[1:])]


def test_report_and_comparison(rows):
    train, test = rows.where("id % 2 = 0"), rows.where("id % 2 = 1")
    model = ml.fit_classifier(train, ["x"], DecisionTreeClassifier(maxDepth=2), "y")
    report = ml.model_report(model, train, test, ["x"], "y")
    kinds = {(r["set"], r["metric"]) for r in report.select("set", "metric").distinct().collect()}
    assert len(kinds) == 1 + 2 * 8
    found = ml.nested_model_comparison(train, test, {"z": ["z"], "zx": ["z", "x"]}, "y", {"maxIter": 2, "maxDepth": 2})
    auc = {r["model"]: r["auc"] for r in found.where("set = 'Teste'").collect()}
    assert auc["zx"] > auc["z"] + 0.1


def test_whole_run(spark):
    """Silver-like tables to a fitted run, scored population and swap report."""
    rng = random.Random(6)
    bureau, telco, book = [], [], []
    for i in range(900):
        key, cohort, flag = f"{i:05d}Z{'ZX'[i % 2]}{i:04d}", [202410, 202412, 202501, 202502, 202503][i % 5], int(i % 3 > 0)
        score, usage = rng.randrange(1000), rng.random()
        fpd = int(rng.random() < 0.1 + 0.7 * (score < 400)) if flag else None
        bureau.append((key, cohort, flag, fpd, "P", "PRE", score, rng.randrange(1000), 1))
        telco.append((key, cohort, flag, fpd, "P", "PRE", usage, None if i % 2 else 1.0, 1))
        if i % 4:
            book.append((key, cohort, Decimal(rng.randrange(100)), f"g{i % 3}", 1))
    ids = "NUM_CPF string, SAFRA int, FLAG_INSTALACAO int, FPD int, PROD string, flag_mig2 string"
    bureau = spark.createDataFrame(bureau, ids + ", SCORE_01 int, SCORE_02 int, DATPROC long")
    tables = {
        "telco": spark.createDataFrame(telco, ids + ", var_26 double, var_27 double, DATPROC long"),
        "recharge": spark.createDataFrame(book, "NUM_CPF string, SAFRA int, VL_X decimal(10,2), grp string, DATPROC long"),
    }
    run = model_runs.ModelRun("t", ("telco", "recharge"), 0.05, sample_by="FPD", fractions={0: 1.0, 1: 1.0})
    setting = [{**s, "maxIter": 3, "maxDepth": 3} for s in ml.random_settings(2)]
    fitted = model_runs.fit_run(bureau, tables, run, folds=2, settings=setting)
    assert "SCORE_01" in fitted.selected
    quality = {r["set"]: r for r in fitted.metrics().collect()}
    assert quality["Teste"]["auc"] > 0.7 and quality["Treino"]["ks"] > 0.3
    assert fitted.stability().first()["psi"] >= 0
    everyone = model_runs.score_all(bureau, tables, fitted)
    assert everyone.count() == 900 and everyone.where("points < 0 OR points > 1001").count() == 0
    assert everyone.where("FLAG_INSTALACAO = 0 AND FPD IS NOT NULL").count() == 0
    swap = model_runs.swap_report(everyone, bureau)
    assert sum(r["volume"] for r in swap.groups.collect()) == 900
    r = swap.approvals.first()
    assert r["installed"] == 600 and r["baseline_approvals"] == pytest.approx(900)
    assert swap.risk.count() == swap.groups.count() and swap.default_rates.count() == 2
    assert fitted.bakeoff.count() == 6 and swap.duplicates.first()[0] == 0
    assert sum(r["n"] for r in swap.install_rates.collect()) == bureau.where("substr(NUM_CPF, 6, 2) IN ('ZZ', 'ZX')").count()
    bands = swap.bands.collect()
    assert sum(r["volume"] for r in bands) == 900 == sum(r["volume"] for r in swap.volumes.collect())
    assert all(0 <= r["mean_SCORE_01"] < 1000 and 0 <= r["mean_points"] <= 1001 for r in bands)


def test_runs_are_nested():
    sets = [set(r.tables) for r in model_runs.RUNS]
    assert len(sets) == 6 and all(a <= b for a, b in zip(sets, sets[1:]))
    assert model_runs.RUNS[0].without == ("SCORE_02",)
    assert [r.most_nulls for r in model_runs.RUNS] == [0.7] * 5 + [0.8]


def test_frequent_rows_are_dealt_evenly(spark):
    """Two distinct rows make two partitions of old; the copies of each are now spread and none is lost."""
    rows = spark.range(60_000).select((F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    dealt = ml.laid_out(rows)
    assert dealt.groupBy("x", "y").count().orderBy("x").collect() == [(0.0, 0, 30_000), (1.0, 1, 30_000)]
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert max(sizes) <= 5 * ml.BLOCK < 30_000
    assert ml.partitions_of(10 * ml.PARTITIONS * ml.ROWS_PER_PARTITION) == 10 * ml.PARTITIONS


def test_leaves_of_one_class_keep_their_rates(spark):
    """Rates of 0.1, 0.4 and 0.9 over x: the first two say the same class and must still be told apart."""
    rates = F.get(F.array(F.lit(1), F.lit(4), F.lit(9)), F.col("x").cast("int"))
    rows = spark.range(3000).select((F.col("id") % 3).cast("double").alias("x"), F.floor(F.col("id") / 3).alias("n"))
    rows = rows.select("x", (F.col("n") % 10 < rates).cast("int").alias("y"))
    for classifier in (DecisionTreeClassifier(maxDepth=3), DecisionTreeClassifier(maxDepth=3, minInstancesPerNode=2)):
        found = ml.scored(ml.fit_classifier(rows, ["x"], classifier, "y"), rows, ["x"]).distinct().orderBy("x").collect()
        assert [(r["x"], round(r["p"], 9), r["prediction"]) for r in found] == [(0.0, 0.1, 0), (1.0, 0.4, 0), (2.0, 0.9, 1)]


def test_scorecard_reads_distinct_rows(spark, monkeypatch):
    """The regression iterates over a written table of the distinct rows, and finds the log odds of all of them."""
    rows = spark.range(4000).select((F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 4 == 0).cast("double").alias("y"))
    rows = rows.unionByName(spark.createDataFrame([(1.0, 1.0)] * 100, "x double, y double"))
    sizes, keep = [], ml.written
    monkeypatch.setattr(ml, "written", lambda df, label: sizes.append(df.count()) or keep(df, label))
    card = {r["variable"]: r for r in ml.logistic_scorecard(rows, ["x"], "y").collect()}
    assert sizes == [2]
    assert abs(card["x"]["beta"] - math.log(100 / 2000)) < 1e-6 and abs(card["const"]["beta"]) < 1e-6
    variance = 1 / 100 + 1 / 2000 + 1 / 1000 + 1 / 1000
    assert abs(card["x"]["wald"] - math.log(100 / 2000) ** 2 / variance) < 1e-3


def test_search_scores_distinct_rows(spark, monkeypatch):
    """Rates of 0.1 and 0.9 over x: the search counts eight cells, and its F-beta is that of calling x = 1."""
    rows = spark.range(2000).select("id", (F.col("id") % 2).cast("double").alias("x"), F.floor(F.col("id") / 2).alias("n"))
    rows = rows.select("id", "x", (F.col("n") % 10 < 1 + 8 * F.col("x")).cast("int").alias("y"))
    made, keep = [], ml.cells
    monkeypatch.setattr(ml, "cells", lambda df: made.append(keep(df)) or made[-1])
    one = {"maxIter": 2, "stepSize": 0.3, "maxDepth": 2, "subsamplingRate": 0.9, "featureShare": 1.0, "positiveWeight": 1.0}
    found = ml.hyperparameter_search(rows, ["x"], "y", ["id"], folds=2, settings=[one])
    assert [t.count() for t in made] == [8]
    assert abs(found.table.first()["fbeta"] - 0.9) < 0.02
    said = ml.scored(found.model, rows, ["x"]).select("x", "prediction").distinct().orderBy("x").collect()
    assert [tuple(r) for r in said] == [(0.0, 0), (1.0, 1)]
