"""Filters, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import ORDERS, PEOPLE, REFERENCE, orders, people, table, unit_hash_sql, hash_sql
from catalog.registry import register
from scoreloom.operators import assemble, sampling
from scoreloom.operators.books import BookSpec, cohort_keys, cohort_slice
from scoreloom.operators.profile import category_columns

SPEC = BookSpec("orders", "ORD", ("price",), ("avg",), key="cust", cohort="safra")
SHORT = "order_id, cust, safra, status"


def short(df):
    return df.select("order_id", "cust", "safra", "status")


@register("filter_cohort_keys", f"WITH {ORDERS} SELECT DISTINCT cust FROM orders_ WHERE safra = {REFERENCE}")
def filter_cohort_keys(spark, folder):
    return cohort_keys(orders(spark, folder), REFERENCE, SPEC)


@register("filter_cohort_range", f"WITH {ORDERS} SELECT {SHORT} FROM orders_ WHERE safra BETWEEN 200007 AND 200107")
def filter_cohort_range(spark, folder):
    return short(cohort_slice(orders(spark, folder), REFERENCE, SPEC))


@register("filter_range_and_platform", f"""
WITH {ORDERS} SELECT {SHORT} FROM orders_ WHERE safra BETWEEN 200007 AND 200107 AND priority = '1-URGENT'""")
def filter_range_and_platform(spark, folder):
    return short(cohort_slice(orders(spark, folder), REFERENCE, SPEC).where(F.col("priority") == "1-URGENT"))


@register("filter_population", f"""
WITH {PEOPLE} SELECT cust, balance FROM people WHERE installed = 1 AND segment = 'BUILDING'""")
def filter_population(spark, folder):
    plan = F.when(F.col("segment") == "BUILDING", "PRE").otherwise("POS")
    df = people(spark, folder).withColumn("flag_mig2", plan)
    return assemble.population(df, "installed", "Flag_mig2").select("cust", "balance")


@register("filter_key_substring", f"""
WITH {PEOPLE} SELECT cust, name FROM people WHERE substr(name, 17, 2) IN ('42', '77')""")
def filter_key_substring(spark, folder):
    return assemble.control_group(people(spark, folder), "name", 17, 2, ("42", "77")).select("cust", "name")


@register("point_lookup_sorted", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_suppkey = 7 AND l_returnflag = 'R' AND l_quantity = 10 ORDER BY l_orderkey, l_linenumber, l_partkey""")
def point_lookup_sorted(spark, folder):
    hit = (F.col("l_suppkey") == 7) & (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 10)
    return (
        table(spark, folder, "lineitem").where(hit)
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        .orderBy("l_orderkey", "l_linenumber", "l_partkey")
    )


@register("out_of_time_split", f"""
WITH {ORDERS} SELECT {SHORT}, CASE WHEN safra BETWEEN 200001 AND 200012 THEN 'train' ELSE 'test' END AS part
FROM orders_ WHERE safra BETWEEN 200001 AND 200012 OR safra BETWEEN 200101 AND 200107""")
def out_of_time_split(spark, folder):
    return assemble.label_out_of_time(short(orders(spark, folder)), (200001, 200012), (200101, 200107), "safra")


@register("flag_split", f"""
WITH {PEOPLE} SELECT 'installed' AS part, count(*) AS n, min(cust) AS first_cust FROM people WHERE installed = 1
UNION ALL SELECT 'not_installed', count(*), min(cust) FROM people WHERE installed = 0""")
def flag_split(spark, folder):
    df = people(spark, folder)

    def part(name, flag):
        rows = df.where(F.col("installed") == flag)
        return rows.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.min("cust").alias("first_cust"))

    return part("installed", 1).unionByName(part("not_installed", 0))


@register("stratified_sample", f"""
WITH {ORDERS} SELECT {SHORT} FROM orders_
WHERE {unit_hash_sql('order_id')} < CASE status WHEN 'F' THEN 0.3::DOUBLE WHEN 'O' THEN 0.1::DOUBLE ELSE 0 END""")
def stratified_sample(spark, folder):
    return sampling.stratified_sample(short(orders(spark, folder)), "status", {"F": 0.3, "O": 0.1}, ["order_id"])


@register("downsample_to_n", f"""
WITH {ORDERS} SELECT {SHORT} FROM orders_ ORDER BY {hash_sql('order_id')}, order_id LIMIT 8500""")
def downsample_to_n(spark, folder):
    return sampling.downsample(short(orders(spark, folder)), 8500, ["order_id"])


@register("category_filter_by_cardinality", f"WITH {PEOPLE} SELECT cust, segment FROM people")
def category_filter_by_cardinality(spark, folder):
    df = people(spark, folder)
    return df.select("cust", *category_columns(df, 10))


@register("stratified_folds", f"""
WITH {PEOPLE} SELECT cust, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {hash_sql('cust')}, cust) - 1) % 5 AS INTEGER) AS fold
FROM people""")
def stratified_folds(spark, folder):
    return sampling.stratified_folds(people(spark, folder).select("cust", "y"), "y", ["cust"])


@register("class_weighting", f"""
WITH {PEOPLE} SELECT cust, y, CASE WHEN y = 1 THEN 4.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM people""")
def class_weighting(spark, folder):
    return sampling.class_weights(people(spark, folder).select("cust", "y"), "y", 4.5)
