import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators.ordered import column_quantiles, quantiles, running_totals, shuffled_rank


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(3)
    rows = []
    for i in range(600):
        # a third of the rows share one value, and one group holds most rows
        value = 5.0 if i % 3 == 0 else round(rng.gauss(0, 50), 1)
        rows.append((i, None if i % 50 == 7 else ("a" if i % 10 else "b"), value, rng.random() < 0.3))
    rows.append((601, "a", None, True))
    return pd.DataFrame(rows, columns=["id", "g", "v", "y"])


def to_spark(spark, frame):
    rows = [(r.id, r.g, None if pd.isna(r.v) else r.v, int(r.y)) for r in frame.itertuples()]
    return spark.createDataFrame(rows, "id int, g string, v double, y int")


@pytest.mark.parametrize("rows_per_bucket", [5, 60, 10_000])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_totals(spark, frame, rows_per_bucket, descending, groups):
    df = to_spark(spark, frame)
    got = running_totals(df, "v", {"n": F.lit(1), "p": F.col("y")}, groups, descending, rows_per_bucket).collect()
    kept = frame.dropna(subset=["v"]).copy()
    kept["k"] = kept["g"].fillna("<null>") if groups else "all"
    seen = 0
    for key, part in kept.groupby("k"):
        by = part.groupby("v")["y"].agg(["size", "sum"]).sort_index(ascending=not descending)
        want = {v: (n, p, cn, cp, len(part), part["y"].sum()) for v, n, p, cn, cp in zip(
            by.index, by["size"], by["sum"], by["size"].cumsum(), by["sum"].cumsum())}
        rows = [r for r in got if not groups or (r["g"] or "<null>") == key]
        assert {r["v"]: (r["n"], r["p"], r["cum_n"], r["cum_p"], r["all_n"], r["all_p"]) for r in rows} == want
        seen += len(rows)
    assert seen == len(got)


@pytest.mark.parametrize("rows_per_bucket", [5, 60, 10_000])
def test_quantiles(spark, frame, rows_per_bucket):
    probabilities = [0, 0.1, 0.25, 0.333, 0.5, 0.9, 1]
    got = quantiles(to_spark(spark, frame), "v", probabilities, ["g"], rows_per_bucket).collect()
    assert len(got) == 3
    for r in got:
        part = frame[frame["g"].isna() if r["g"] is None else frame["g"] == r["g"]]["v"].dropna()
        assert r["n"] == len(part)
        assert np.allclose(r["quantiles"], np.quantile(part, probabilities), rtol=0, atol=1e-9)


def test_column_quantiles(spark, frame):
    df = to_spark(spark, frame).withColumn("w", F.col("id") * 2)
    got = column_quantiles(df, ["v", "w"], [0.5])
    assert got["v"][0] == pytest.approx(frame["v"].median()) and got["w"][0] == pytest.approx(frame["id"].median() * 2)


@pytest.mark.parametrize("share", [0.001, 0.05, -1.0])
def test_fenced_quantiles_are_exact(spark, monkeypatch, share):
    """Also with fences that miss their ranks, which must then be found in full."""
    from scoreloom.operators import ordered

    monkeypatch.setattr(ordered, "FEW_VALUES", 10)
    monkeypatch.setattr(ordered, "SKETCH_ACCURACY", 200)
    monkeypatch.setattr(ordered, "FENCE_SHARE", share)
    monkeypatch.setattr(ordered, "SKETCHED_AT_ONCE", 2)
    rng = np.random.default_rng(5)
    data = pd.DataFrame({
        "normal": rng.normal(0, 9, 4000), "ties": rng.integers(0, 4, 4000) / 4, "constant": 3.0,
        "hot": np.where(rng.random(4000) < 0.4, 7.0, rng.exponential(20, 4000)),
    })
    df = spark.createDataFrame(data).withColumn("empty", F.lit(None).cast("double"))
    df = df.withColumn("holes", F.when(F.col("normal") > 0, F.col("normal")))
    probabilities = [i / 10 for i in range(11)] + [0.333]
    got = column_quantiles(df, [*data.columns, "empty", "holes"], probabilities)
    assert set(got) == {*data.columns, "holes"}
    data["holes"] = data["normal"].where(data["normal"] > 0)
    for c in got:
        assert np.allclose(got[c], np.quantile(data[c].dropna(), probabilities), rtol=0, atol=1e-9)


def test_shuffled_rank_numbers_every_group(spark, frame):
    got = shuffled_rank(to_spark(spark, frame).repartition(5), ["id"], ["g"]).collect()
    again = {r["id"]: r["rank"] for r in shuffled_rank(to_spark(spark, frame).coalesce(1), ["id"], ["g"]).collect()}
    assert {r["id"]: r["rank"] for r in got} == again
    by_group = {}
    for r in got:
        by_group.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(ranks) == list(range(len(ranks))) for ranks in by_group.values())
    other = {r["id"]: r["rank"] for r in shuffled_rank(to_spark(spark, frame), ["id"], ["g"], seed=9).collect()}
    assert other != again
