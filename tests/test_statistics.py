import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import banding, metrics, policy, profile, sampling, scorecard


def scores(spark, rows):
    return spark.createDataFrame(rows, "s double, y int")


@pytest.fixture(scope="module")
def random_scores():
    rng = random.Random(11)
    return [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(500)]


def test_ties(spark):
    df = scores(spark, [(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)])
    r = metrics.ranking_metrics(df, "s", "y").first()
    assert (r["ks"], r["auc"], r["gini"]) == (0, 0.5, 0)
    assert metrics.normalized_gini(df, "s", "y").first()[0] == pytest.approx(0)


def test_ranking_against_all_pairs(spark, random_scores):
    pos = [s for s, y in random_scores if y]
    neg = [s for s, y in random_scores if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ks = max(abs(np.mean([p >= t for p in pos]) - np.mean([n >= t for n in neg])) for t, _ in random_scores)
    r = metrics.ranking_metrics(scores(spark, random_scores), "s", "y").first()
    assert r["auc"] == pytest.approx(auc) and r["ks"] == pytest.approx(ks)
    squeezed = scores(spark, [(math.exp(3 * s), y) for s, y in random_scores])
    same = metrics.ranking_metrics(squeezed, "s", "y").first()
    assert same["ks"] == pytest.approx(ks) and same["auc"] == pytest.approx(auc)


def test_one_class_only(spark):
    r = metrics.ranking_metrics(scores(spark, [(0.1, 0), (0.2, 0)]), "s", "y").first()
    assert r["auc"] is None and r["average_precision"] is None


def test_perfect_order(spark):
    df = scores(spark, [(0.9, 1), (0.8, 1), (0.3, 0), (0.1, 0)])
    assert metrics.normalized_gini(df, "s", "y").first()[0] == pytest.approx(1)
    assert metrics.ranking_metrics(df, "s", "y").first()["average_precision"] == pytest.approx(1)


def test_bands(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(1, 11)], "x double, c double")
    assert [r["FAIXA"] for r in banding.quantile_bands(df, "x").orderBy("x").collect()] == list(range(10))
    assert {r["FAIXA"] for r in banding.quantile_bands(df, "c").collect()} == {0}
    assert {r["FAIXA"] for r in banding.equal_width_bands(df, "c").collect()} == {4}
    with_null = spark.createDataFrame([(None,), (1.0,), (2.0,)], "x double")
    assert sorted(str(r["FAIXA"]) for r in banding.quantile_bands(with_null, "x", 2).collect()) == ["0", "1", "None"]


def test_bands_against_pandas(spark, random_scores):
    x = pd.Series([s for s, _ in random_scores])
    df = scores(spark, random_scores)
    for mine, theirs in (
        (banding.quantile_bands(df, "s", 7), pd.qcut(x, 7, labels=False, duplicates="drop")),
        (banding.equal_width_bands(df, "s", 7), pd.cut(x, 7, labels=False)),
    ):
        assert sorted(r["FAIXA"] for r in mine.collect()) == sorted(theirs)
    digits = banding.apply_tree_bins(df, "s", [0.2, 0.5, 0.7])
    assert sorted(r[1] for r in digits.collect()) == sorted(np.digitize(x, [0.2, 0.5, 0.7]))


def test_histogram_against_numpy(spark, random_scores):
    got = profile.histogram(scores(spark, random_scores), ["s"], 30).collect()
    want, edges = np.histogram([s for s, _ in random_scores], bins=30)
    assert {r["bin"]: r["n"] for r in got} == {i: n for i, n in enumerate(want) if n}
    assert all(r["lower"] == pytest.approx(edges[r["bin"]]) for r in got)


def test_psi(spark):
    rng = random.Random(4)
    same = [(rng.random(),) for _ in range(100)]
    df = spark.createDataFrame(same, "s double")
    twice = df.withColumn("part", F.lit("e")).unionByName(df.withColumn("part", F.lit("a")))
    assert scorecard.psi(twice, "s", "part", "e", "a").first()["psi"] == pytest.approx(0)
    gap = spark.createDataFrame([(0.0, "e"), (1.0, "a")], "s double, part string")
    assert scorecard.psi(gap, "s", "part", "e", "a").first()["psi"] == math.inf
    finite = scorecard.psi(gap, "s", "part", "e", "a", epsilon=1e-3).first()
    assert finite["psi"] < math.inf and finite["reading"] == "shifted"


def test_decile_volumes_add_up(spark, random_scores):
    for kind in ("quantile", "equal"):
        got = metrics.decile_table(scores(spark, random_scores), "s", "y", kind=kind).collect()
        assert sum(r["volume"] for r in got) == 500 and all(r["min_score"] <= r["max_score"] for r in got)


def test_iv_by_hand(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("a", 0)] + [("b", 1)] + [("b", 0)] * 5 + [(None, 1)], "c string, y int")
    want = (3 / 4 - 1 / 6) * math.log((3 / 4) / (1 / 6)) + (1 / 4 - 5 / 6) * math.log((1 / 4) / (5 / 6))
    got = scorecard.iv_table(df, "y", ["c"]).first()
    assert got["iv"] == pytest.approx(want) and got["label"] == "Preditor Forte"


def test_null_groups_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1)], "g string, y int")
    got = {r["g"]: (r["volume"], r["target_mean"]) for r in profile.group_event_rate_with_nulls(df, "y", "g").collect()}
    assert got == {"a": (2, 0.5), None: (0, 1.0)}
    total = profile.counts_with_total(df, ["g"]).collect()
    assert [(r["g"], r["n"], r["pct"]) for r in total] == [("a", 2, 100.0), ("Total", 2, 100.0)]


def test_sketched_profile(spark):
    df = spark.createDataFrame([(i % 7, None if i % 2 else "x") for i in range(100)], "a int, b string")
    exact = {r["feature"]: r for r in profile.metadata_profile(df, targets=["a"]).collect()}
    rough = {r["feature"]: r for r in profile.metadata_profile(df, targets=["a"], exact=False).collect()}
    assert exact["a"]["role"] == "Target" and (exact["b"]["nulls"], exact["b"]["cardinality"]) == (50, 1)
    assert rough["b"]["nulls"] == 50 and rough["a"]["cardinality"] == pytest.approx(7, abs=1)
    counts = profile.count_and_distinct_by(df, "b", "a", exact=False).count()
    assert counts == 2


def test_box_stats_with_null_group(spark):
    df = spark.createDataFrame([(float(v), g) for g in ("a", None) for v in (1, 2, 3, 4, 100)], "x double, g string")
    for r in profile.box_stats(df, ["x"], ["g"]).collect():
        assert (r["q1"], r["median"], r["q3"], r["low_whisker"], r["high_whisker"], r["outliers"]) == (2, 3, 4, 1, 4, 1)


def test_samples(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    first = sampling.downsample(df.repartition(3), 1234, ["id"])
    again = sampling.downsample(df.repartition(8), 1234, ["id"])
    assert first.count() == 1234 and first.exceptAll(again).count() == 0
    assert sampling.downsample(df, 9999, ["id"]).count() == 5000
    part = sampling.stratified_sample(df, "y", {1: 0.5}, ["id"])
    assert 500 < part.count() < 750 and part.where("y = 0").count() == 0
    folds = sampling.stratified_folds(df, "y", ["id"]).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds} == {250, 750}


def test_policy(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 500), ("b", 1, 0, 100), ("c", 0, None, 400), ("d", 0, None, 10)],
        "NUM_CPF string, FLAG_INSTALACAO int, FPD int, pts int",
    )
    swapped = policy.with_swap(df, "pts")
    got = [(r["grupo_swap"], r["volume"], r["fpd_real"]) for r in policy.swap_table(swapped).collect()]
    assert got == [("mantido", 2, 1.0), ("swap_in", 1, None), ("swap_out", 1, 0.0)]
    rates = {r["policy"]: (r["n"], r["default_rate"]) for r in policy.policy_default_rates(swapped).collect()}
    assert rates == {"baseline": (2, 0.5), "modelo": (1, 1.0)}
    r = policy.estimated_approvals(swapped, df).first()
    assert (r["installed"], r["baseline_approvals"], r["model_approvals"]) == (2, 4.0, 2)
