"""Reading, writing, counting."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from catalog.inputs import ORDERS, orders, table
from catalog.registry import register
from scoreloom.operators.profile import preview_rows, schema_report
from scoreloom.session import fresh_path
from scoreloom.sources.feeds import read_parquet, read_table
from scoreloom.sources.sinks import append_audit, stage_counts, upsert_by_key, write_partitioned
from scoreloom.operators.dedup import dedup_full_row


@register("scan_parquet", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""")
def scan_parquet(spark, folder):
    df = read_parquet(spark, f"{folder}/orders.parquet")
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@register("scan_table", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_table(spark, folder):
    # An external catalog table over the given file, read by its full name.
    name = "customer_" + hashlib.md5(folder.encode()).hexdigest()[:8]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{folder}/customer.parquet'")
    catalog, schema = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    df = read_table(spark, f"{catalog}.{schema}.{name}")
    return df.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@register("temp_view", """
SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY o_orderstatus""")
def temp_view(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders_view")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders_view GROUP BY o_orderstatus"
    )


PLAIN_ORDERS = f"WITH {ORDERS} SELECT cust, safra, order_id, status, CAST(price AS DOUBLE) AS price FROM orders_"


def plain_orders(df):
    return df.select("cust", "safra", "order_id", "status", F.col("price").cast("double").alias("price"))


@register("write_partitioned", PLAIN_ORDERS)
def write_partitioned_(spark, folder):
    path = fresh_path(spark, "orders_by_cohort")
    write_partitioned(plain_orders(orders(spark, folder)), path, ["safra"])
    return plain_orders(read_parquet(spark, path))


@register("upsert_by_key", f"""
WITH {ORDERS},
target AS (SELECT cust, safra, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total
           FROM orders_ WHERE status <> 'P' GROUP BY cust, safra),
source AS (SELECT cust, safra, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total
           FROM orders_ WHERE safra BETWEEN 200001 AND 200012 GROUP BY cust, safra)
SELECT * FROM source
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.cust = t.cust AND s.safra = t.safra)""")
def upsert_by_key_(spark, folder):
    def months(df):
        return df.groupBy("cust", "safra").agg(
            F.count("*").alias("n"), F.sum("price").cast("double").alias("total")
        )

    path, rows = fresh_path(spark, "customer_months"), orders(spark, folder)
    late = months(rows.where(F.col("safra").between(200001, 200012)))
    upsert_by_key(months(rows.where("status <> 'P'")), path, ["cust", "safra"], "safra")
    upsert_by_key(late, path, ["cust", "safra"], "safra")
    upsert_by_key(late, path, ["cust", "safra"], "safra")
    return read_parquet(spark, path).select("cust", "safra", "n", "total")


@register("audit_rows", f"""
WITH {ORDERS} SELECT 'orders' AS nome_tabela, safra, count(*) AS qtd_registros FROM orders_ GROUP BY safra
UNION ALL
SELECT 'open_orders', safra, count(*) FROM orders_ WHERE status = 'O' GROUP BY safra""")
def audit_rows_(spark, folder):
    path, rows = fresh_path(spark, "control"), orders(spark, folder)
    append_audit(rows, "orders", path, "safra")
    append_audit(rows.where("status = 'O'"), "open_orders", path, "safra")
    return read_parquet(spark, path).drop("datproc")


@register("preview_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10""")
def preview_rows_(spark, folder):
    return preview_rows(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"], 10
    )


@register("row_count_checkpoints", """
SELECT 'raw' AS stage, count(*) AS n FROM lineitem
UNION ALL SELECT 'one_per_key', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'joined', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def row_count_checkpoints(spark, folder):
    lines, o = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return stage_counts({
        "raw": lines,
        "one_per_key": dedup_full_row(lines.select("l_orderkey", "l_linenumber")),
        "joined": lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")),
    })


@register("schema_report", """
SELECT 'c_custkey' AS feature, 'bigint' AS type, count(c_custkey) AS filled FROM customer
UNION ALL SELECT 'c_name', 'string', count(c_name) FROM customer
UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey) FROM customer
UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal) FROM customer
UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment) FROM customer""")
def schema_report_(spark, folder):
    return schema_report(table(spark, folder, "customer"))


