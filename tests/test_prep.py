import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scoreloom.operators import prep


def test_fills(spark):
    df = spark.createDataFrame([(1.0, "b"), (-1.0, "a"), (3.0, None), (None, "b"), (4.0, "a")], "x double, c string")
    means = prep.fit_means(df)
    assert means.numbers["x"] == pytest.approx(8 / 3)
    assert [r["x"] for r in means.apply(df).collect()][1] == pytest.approx(8 / 3)
    modes = prep.fit_modes(df)
    assert modes.texts == {"c": "a"} and modes.apply(df).where("c IS NULL").count() == 0
    assert prep.fit_modes(df.where("c IS NULL")).texts == {"c": "VERIFICAR"}
    assert means.apply(df, unknown_texts=True).where("c = 'VERIFICAR'").count() == 1
    assert means.apply(df).where("c IS NULL").count() == 1


def test_one_hot_and_ordinal(spark):
    df = spark.createDataFrame([("a",), ("b.c",), (None,)], "c string")
    fitted = prep.fit_one_hot(df, ["c"])
    new = spark.createDataFrame([("zzz",), ("b.c",)], "c string")
    assert [tuple(r) for r in fitted.apply(new).collect()] == [(0, 0), (0, 1)]
    assert fitted.apply(new).columns == ["c_a", "c_b_c"]
    long = prep.one_hot_long(df.withColumn("k", prep.F.lit(1)), ["c"], ["k"])
    assert sorted(r["feature"] for r in long.collect()) == ["c_a", "c_b.c"]
    known = prep.ordinal_encode(df.dropna(), {"c": ["b.c", "a"]})
    assert [r["c"] for r in known.collect()] == [1.0, 0.0]
    with pytest.raises(Exception):
        prep.ordinal_encode(new, {"c": ["b.c", "a"]}).collect()


def test_target_encoding_by_hand(spark):
    rows = [("a", 1), ("a", 1), ("a", 0), ("b", 0), ("b", 0), ("c", 1)]
    df = spark.createDataFrame(rows, "c string, y int")
    ys = np.array([y for _, y in rows], dtype=float)
    found = prep.fit_target_encoding(df, ["c"], "y")
    got = {r["category"]: r["encoded"] for r in found.tables["c"].collect()}
    for name in "abc":
        y = np.array([v for c, v in rows if c == name], dtype=float)
        weight = len(y) * ys.var() / (len(y) * ys.var() + y.var())
        assert got[name] == pytest.approx(weight * y.mean() + (1 - weight) * ys.mean())
    new = spark.createDataFrame([("zzz",), (None,)], "c string")
    assert [r["c"] for r in found.apply(new).collect()] == [pytest.approx(ys.mean())] * 2


def test_cross_fit_uses_other_folds_only(spark):
    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("c"),
        (F.col("id") % 7 == 0).cast("int").alias("y"),
    )
    before = {r["id"]: r for r in prep.cross_fit_target_encode(df, "c", "y", ["id"]).collect()}
    changed = df.withColumn("y", F.when(F.col("id") == 21, 1 - F.col("y")).otherwise(F.col("y")))
    after = {r["id"]: r for r in prep.cross_fit_target_encode(changed, "c", "y", ["id"]).collect()}
    assert len(before) == 300 and before[21]["c_encoded"] == pytest.approx(after[21]["c_encoded"])
    assert any(before[i]["c_encoded"] != after[i]["c_encoded"] for i in before)


def test_scales(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, k double")
    got = [tuple(r) for r in prep.fit_robust_scale(df, ["x", "k"]).apply(df).collect()]
    assert got == [(-0.4, 0.0), (0.0, 0.0), (1.6, 0.0)]
    x = np.array([1.0, 2, 6])
    got = [r["x"] for r in prep.fit_standard_scale(df, ["x"]).apply(df).collect()]
    assert np.allclose(got, (x - x.mean()) / x.std())


def test_prep_applies_by_name(spark):
    rows = [(i, float(i % 9) if i % 4 else None, ["a", "b", None][i % 3], f"k{i % 25}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, low string, high string, y int")
    fitted = prep.fit_prep(df, "y", ["id"])
    assert fitted.features == ["low_a", "low_b", "high", "x"]
    shuffled = df.select("high", "y", "x", "id", "low")
    a, b = (sorted(map(tuple, fitted.apply(d).collect())) for d in (df, shuffled))
    assert a == b and len(a) == 200 and all(v is not None for r in a for v in r)


def test_selection(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") % 2).cast("double").alias("c"),
        F.lit(1.0).alias("d"),
    )
    assert prep.low_variance(df, ["a", "b", "c", "d"]) == ["d"]
    assert prep.correlated(df, ["a", "b", "c"], 0.5) == ["b"]


def test_auto_preprocess(spark):
    rows = [(i, float(i), float(2 * i), None, f"k{i % 3}", int(i % 5 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, a double, b double, empty double, c string, y int")
    got = prep.auto_preprocess(df, "y", ["id"], sample=100)
    assert got.table.count() == 120 and "empty" not in got.table.columns and "b" in got.dropped
    assert {r["feature"]: r["pct_nulls"] for r in got.metadata.collect()}["empty"] == 100.0


def test_domains_and_types(spark):
    df = spark.createDataFrame([(1.00004, 1), (2.0, 2**40), (None, 3)], "x double, n bigint")
    table = prep.domain_table(df, "x", {"1.0": "one"})
    got = [r["TFB_x"] for r in prep.apply_domain(df, table.where("x <> '2.0'"), "x").collect()]
    assert sorted(map(str, got)) == ["2.0", "None", "one"]
    assert [t for _, t in prep.narrow_types(df).dtypes] == ["float", "bigint"]


def test_correlation_over_what_both_have(spark):
    """Against pandas, where every row has a null; a constant side and pairs without common rows have none."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + 1e6
    x[np.arange(300), rng.integers(0, 4, 300)] = np.nan
    x = np.column_stack([x, np.full(300, 3.0), np.where(np.isnan(x[:, 0]), 1.0, np.nan)])
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)], ", ".join(f"{c} double" for c in names))
    want = pd.DataFrame(x, columns=names).corr()
    for at_once in (400, 4):
        for (a, b), r in prep.correlations(df, names, at_once).items():
            assert r is None if np.isnan(want[a][b]) else r == pytest.approx(want[a][b], abs=1e-9)
    assert prep.correlations(df, []) == {} and prep.correlated(df.limit(0), names) == []


def test_prep_is_stored_and_loaded(spark, tmp_path):
    rows = [(i, float(i % 9) if i % 4 else None, ["a", "b\"'", None][i % 3], f"k{i % 25}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, low string, high string, y int")
    fitted = prep.fit_prep(df, "y", ["id"])
    fitted.save(str(tmp_path / "prep"))
    again = prep.Prep.load(spark.newSession(), str(tmp_path / "prep"))
    assert again.features == fitted.features and again.expected == {"low": "string", "high": "string", "x": "number"}
    a, b = (sorted(map(tuple, p.apply(df.drop("y"), ["x"]).collect())) for p in (fitted, again))
    assert a == b and len(a) == 200
    with pytest.raises(ValueError, match="absent: .'high'.*x .string, not number"):
        again.apply(df.drop("high").withColumn("x", F.col("x").cast("string")))
    values = tmp_path / "prep" / "values"
    for part in values.glob("part*"):
        part.write_text(part.read_text().replace('"version": 1', '"version": 99'))
    for crc in values.glob(".part*.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="version 99"):
        prep.Prep.load(spark, str(tmp_path / "prep"))
