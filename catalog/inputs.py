"""The given tables in the roles the operators need, and the same roles in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.cleaning import cohort_of

RUN_STAMP = 20250401120000
REFERENCE = 200107
BACKFILL = [200105, 200106, 200107]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(name: str):
    return F.col(name).cast("decimal(12,2)")


# --- orders as a transaction feed with a cohort -------------------------------------------------

def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("cust"),
        cohort_of(F.col("o_orderdate")).alias("safra"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        money("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("order_date"),
    )


ORDERS = """orders_ AS (
  SELECT o_custkey AS cust, CAST(year(o_orderdate)*100+month(o_orderdate) AS INTEGER) AS safra,
         o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS priority,
         CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderdate AS order_date
  FROM orders)"""


# --- orders as a raw text feed with sentinels and junk -----------------------------------------

def raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    o, key = table(spark, folder, "orders"), F.col("o_orderkey")
    stamp = F.upper(F.date_format("o_orderdate", "ddMMMyyyy:HH:mm:ss"))
    return o.select(
        F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("order_text"),
        F.when(key % 17 == 0, "null").when(key % 19 == 0, "").when(key % 23 == 0, "-3").when(key % 29 == 0, "xx")
        .otherwise(stamp).alias("stamp_text"),
        F.when(key % 13 == 0, "31/02/2020").when(key % 11 == 0, " NULL ")
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day_text"),
        F.when(key % 31 == 0, "-1").otherwise((key % 86400).cast("string")).alias("clock_text"),
        F.when(key % 7 == 0, "n/a").otherwise(money("o_totalprice").cast("string")).alias("price_text"),
        F.col("o_custkey").cast("string").alias("cust_text"),
        F.col("o_orderstatus").alias("status_text"),
    )


RAW = """raw AS (
  SELECT ' ' || o_orderkey || ' ' AS order_text,
         CASE WHEN o_orderkey % 17 = 0 THEN 'null' WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN '-3'
              WHEN o_orderkey % 29 = 0 THEN 'xx'
              ELSE upper(strftime(o_orderdate, '%d%b%Y:%H:%M:%S')) END AS stamp_text,
         CASE WHEN o_orderkey % 13 = 0 THEN '31/02/2020' WHEN o_orderkey % 11 = 0 THEN ' NULL '
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS day_text,
         CASE WHEN o_orderkey % 31 = 0 THEN '-1' ELSE CAST(o_orderkey % 86400 AS VARCHAR) END AS clock_text,
         CASE WHEN o_orderkey % 7 = 0 THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_text,
         CAST(o_custkey AS VARCHAR) AS cust_text, o_orderstatus AS status_text
  FROM orders)"""


# --- lineitem as a scored population: target, score, category, cohort ---------------------------

def scored(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.col("l_linestatus").alias("grp"),
        F.col("l_returnflag").alias("flag"),
        cohort_of(F.col("l_shipdate")).alias("safra"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_partkey").alias("part"),
    )


SCORED = """scored AS (
  SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         l_extendedprice AS score, l_quantity AS qty, l_discount AS disc, l_tax AS tax, l_linestatus AS grp,
         l_returnflag AS flag, CAST(year(l_shipdate)*100+month(l_shipdate) AS INTEGER) AS safra,
         l_suppkey AS supp, l_partkey AS part
  FROM lineitem)"""


# --- events as a second scored population with many ties ----------------------------------------

def event_scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        (F.col("event_type") == "error").cast("int").alias("y"),
        F.col("value").alias("score"),
        F.col("event_type").alias("kind"),
        F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "train").otherwise("test").alias("part"),
    )


EVENTS = """ev AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y, value AS score, event_type AS kind,
         CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'train' ELSE 'test' END AS part
  FROM events)"""


# --- customers with NULLs, an installed flag and a target ---------------------------------------

def people(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("cust"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"),
        F.when(balance >= 0, balance).alias("balance"),
        F.when(F.col("c_nationkey") >= 5, (F.col("c_nationkey") % 4).cast("double")).alias("tier"),
        F.when(balance > 9000, balance).alias("rare"),
        F.when(balance > 0, 1).otherwise(0).alias("installed"),
        F.when(F.col("c_custkey") % 5 == 0, 1).otherwise(0).alias("y"),
    )


PEOPLE = """people AS (
  SELECT c_custkey AS cust, c_name AS name, c_nationkey AS nation, CAST(c_nationkey AS VARCHAR) AS nation_text,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
         CASE WHEN c_nationkey >= 5 THEN CAST(c_nationkey % 4 AS DOUBLE) END AS tier,
         CASE WHEN c_acctbal > 9000 THEN c_acctbal END AS rare,
         CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS installed,
         CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS y
  FROM customer)"""


# --- customers under two approval policies ------------------------------------------------------

def policy(spark: SparkSession, folder: str) -> DataFrame:
    """Points from the average order value; default is observed for installed customers only."""
    spend = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg((F.sum(money("o_totalprice")).cast("double") / F.count("*")).alias("spend"))
    )
    p = people(spark, folder).join(spend, F.col("cust") == F.col("o_custkey"), "left").drop("o_custkey")
    points = F.floor(F.coalesce("spend", F.lit(0.0)) / 1000).cast("int")
    return p.select(
        "cust",
        "name",
        "nation",
        "installed",
        F.when(F.col("installed") == 1, F.col("y")).alias("fpd"),
        points.alias("points"),
        F.col("balance").alias("score_01"),
        (F.coalesce("spend", F.lit(0.0)) / 1e6).alias("p_hat"),
    )


POLICY = PEOPLE + """, spend AS (
  SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS spend
  FROM orders GROUP BY o_custkey), policy AS (
  SELECT cust, name, nation, installed, CASE WHEN installed = 1 THEN y END AS fpd,
         CAST(floor(coalesce(spend, 0.0) / 1000) AS INTEGER) AS points, balance AS score_01,
         coalesce(spend, CAST(0 AS DOUBLE)) / 1e6 AS p_hat
  FROM people LEFT JOIN spend ON cust = o_custkey)"""
THRESHOLD = 250


def hash_sql(*keys: str, seed: int = 42) -> str:
    """SQL for scoreloom.functions.scalars.hash_text."""
    return f"md5(concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}, '{seed}'))"


def unit_hash_sql(*keys: str, seed: int = 42) -> str:
    return f"(CAST(('0x' || substr({hash_sql(*keys, seed=seed)}, 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def quantile_sql(rows: str, value: str, p: float) -> str:
    """Linearly interpolated quantile of one column, written out by rank."""
    return f"(SELECT quantile_cont({value}, {p}) FROM {rows})"


