import pytest
from pyspark.sql import functions as F

from scoreloom.operators.dedup import dedup_full_row, dedup_latest, duplicate_key_count
from scoreloom.session import fresh_path
from scoreloom.sources.sinks import append_audit, path_exists, save_table, stage_counts, table_exists, upsert_by_key, write_partitioned


def rows(spark, data):
    return spark.createDataFrame(data, "NUM_CPF int, SAFRA int, v string")


def stored(spark, path):
    return sorted((r["NUM_CPF"], r["SAFRA"], r["v"]) for r in spark.read.parquet(path).collect())


def test_upsert(spark):
    path = fresh_path(spark, "t")
    upsert_by_key(rows(spark, [(1, 1, "a"), (2, 1, "b"), (9, 2, "z")]), path)
    source = rows(spark, [(2, 1, "c"), (3, 1, "d"), (3, 3, "e")])
    for _ in range(2):
        upsert_by_key(source, path)
        assert stored(spark, path) == [(1, 1, "a"), (2, 1, "c"), (3, 1, "d"), (3, 3, "e"), (9, 2, "z")]


def test_upsert_with_null_keys(spark):
    path = fresh_path(spark, "t")
    source = rows(spark, [(None, 1, "a"), (4, None, "b"), (1, 1, "c")])
    for values in (None, None, [1, None]):
        upsert_by_key(source, path, values=values)
        assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, spark.read.parquet(path).distinct().collect()))
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="twice"):
        upsert_by_key(rows(spark, [(1, 1, "x"), (1, 1, "y")]), path)
    assert path_exists(spark, path) and not path_exists(spark, path + "-none")


def test_upsert_with_new_column(spark):
    path = fresh_path(spark, "t")
    upsert_by_key(rows(spark, [(1, 1, "a"), (2, 2, "b")]), path)
    upsert_by_key(rows(spark, [(1, 1, "c")]).withColumn("w", F.lit(5)), path)
    got = spark.read.option("mergeSchema", "true").parquet(path).orderBy("NUM_CPF").collect()
    assert [(r["v"], r["w"]) for r in got] == [("c", 5), ("b", None)]


def test_partition_overwrite(spark):
    path = fresh_path(spark, "t")
    write_partitioned(rows(spark, [(1, 1, "a"), (2, 2, "b")]), path, files_per_partition=3)
    write_partitioned(rows(spark, [(5, 2, "n")]), path, only_touched=True)
    assert stored(spark, path) == [(1, 1, "a"), (5, 2, "n")]
    write_partitioned(rows(spark, [(7, 7, "w")]), path)
    assert stored(spark, path) == [(7, 7, "w")]


def test_catalog_table(spark):
    name = "scoreloom_test_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not table_exists(spark, name)
    save_table(rows(spark, [(1, 1, "a")]), name, path=fresh_path(spark, "table"))
    assert table_exists(spark, name) and spark.read.table(name).count() == 1


def test_bucketed_tables_join_without_shuffle(spark):
    data = [(i, 1 + i % 2, "x") for i in range(200)]
    for name in ("scoreloom_left", "scoreloom_right"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        save_table(rows(spark, data), name, buckets=4, path=fresh_path(spark, name))
    left, right = spark.read.table("scoreloom_left"), spark.read.table("scoreloom_right")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        joined = left.hint("merge").join(right, ["NUM_CPF", "SAFRA"])
        assert joined.count() == 200
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_audit_and_counts(spark):
    path, df = fresh_path(spark, "audit"), rows(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, "c")])
    append_audit(df, "t", path)
    append_audit(df, "u", path)
    got = spark.read.parquet(path)
    assert got.columns == ["nome_tabela", "safra", "qtd_registros", "datproc"] and got.count() == 4
    assert {r["stage"]: r["n"] for r in stage_counts({"a": df, "b": df.limit(0)}).collect()} == {"a": 3, "b": 0}


def test_dedup(spark):
    df = spark.createDataFrame(
        [(1, 5, "a", None), (1, 5, "b", None), (1, 4, "z", 1), (None, 1, "n", 2), (None, 2, "m", None)],
        "k int, DATPROC int, v string, w int",
    )
    once = dedup_latest(df, ["k"])
    assert sorted((str(r["k"]), r["v"]) for r in once.collect()) == [("1", "b"), ("None", "m")]
    assert once.columns == df.columns and sorted(map(str, dedup_latest(once, ["k"]).collect())) == sorted(map(str, once.collect()))
    assert duplicate_key_count(df, ["k"]).first()[0] == 3
    assert dedup_full_row(df.unionByName(df)).count() == 5
