"""Typing, cleaning and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (
    EVENTS,
    ORDERS,
    PEOPLE,
    POLICY,
    RAW,
    RUN_STAMP,
    THRESHOLD,
    event_scores,
    orders,
    people,
    policy,
    raw_feed,
    table,
    unit_hash_sql,
)
from catalog.registry import register
from scoreloom.functions import cleaning, scalars
from scoreloom.operators.assemble import columns_not_in, drop_columns, rename_features, split_features_target
from scoreloom.operators.prep import domain_table, apply_domain, narrow_types
from scoreloom.sources.feeds import Feed, typed

FEED = Feed(
    "orders_text",
    {
        "text": ("cust_text", "status_text"),
        "bigint": ("order_text",),
        "money": ("price_text",),
        "stamp": ("stamp_text",),
        "day": ("day_text",),
        "clock": ("clock_text",),
    },
    cohort_from="stamp_text",
    sentinels=cleaning.EXTENDED_SENTINELS,
)
STAMP = "try_strptime(CASE WHEN trim(stamp_text) NOT IN ('null','NULL','','-3','-2','-1') THEN trim(stamp_text) END, '%d%b%Y:%H:%M:%S')"
DAY = "try_strptime(CASE WHEN trim(day_text) NOT IN ('null','NULL','') THEN trim(day_text) END, '%d/%m/%Y')"
CLOCK = """CASE WHEN trim(clock_text) NOT IN ('null','NULL','','-3','-2','-1') THEN
    CAST(substr(lpad(trim(clock_text), 6, '0'), 1, 2) AS INTEGER) * 3600
  + CAST(substr(lpad(trim(clock_text), 6, '0'), 3, 2) AS INTEGER) * 60
  + CAST(substr(lpad(trim(clock_text), 6, '0'), 5, 2) AS INTEGER) END"""
STAMP_OUT = "'yyyy-MM-dd HH:mm:ss'"


@register("typed_projection", f"""
WITH {RAW} SELECT cust_text, status_text, TRY_CAST(trim(order_text) AS BIGINT) AS order_text,
  CAST(TRY_CAST(price_text AS DECIMAL(10,2)) AS DOUBLE) AS price_text,
  strftime({STAMP}, '%Y-%m-%d %H:%M:%S') AS stamp_text, strftime({DAY}, '%Y-%m-%d') AS day_text,
  {CLOCK} AS clock_text, CAST(year({STAMP})*100 + month({STAMP}) AS INTEGER) AS "SAFRA",
  CAST({RUN_STAMP} AS BIGINT) AS "DATPROC" FROM raw""")
def typed_projection(spark, folder):
    df = typed(raw_feed(spark, folder), FEED, RUN_STAMP)
    return df.withColumns({
        "price_text": F.col("price_text").cast("double"),
        "stamp_text": F.date_format("stamp_text", "yyyy-MM-dd HH:mm:ss"),
        "day_text": F.date_format("day_text", "yyyy-MM-dd"),
    })


@register("strict_projection", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST({RUN_STAMP} AS BIGINT) AS "DATPROC" FROM customer""")
def strict_projection(spark, folder):
    text = table(spark, folder, "customer").select(
        *[F.col(c).cast("string").alias(c) for c in ("c_custkey", "c_nationkey", "c_acctbal")]
    )
    feed = Feed(
        "customer",
        {"text": ("c_custkey",), "int": ("c_nationkey",), "double": ("c_acctbal",)},
        strict=True,
    )
    return typed(text, feed, RUN_STAMP)


@register("null_sentinels", f"""
WITH {RAW} SELECT order_text,
  CASE WHEN trim(stamp_text) IN ('null','NULL','') THEN NULL ELSE stamp_text END AS basic,
  CASE WHEN trim(stamp_text) IN ('null','NULL','','-3','-2','-1') THEN NULL ELSE stamp_text END AS extended,
  CASE WHEN trim(day_text) IN ('null','NULL','') THEN NULL ELSE day_text END AS day_text FROM raw""")
def null_sentinels(spark, folder):
    return raw_feed(spark, folder).select(
        "order_text",
        cleaning.null_sentinels(F.col("stamp_text")).alias("basic"),
        cleaning.null_sentinels(F.col("stamp_text"), cleaning.EXTENDED_SENTINELS).alias("extended"),
        cleaning.null_sentinels(F.col("day_text")).alias("day_text"),
    )


@register("parse_timestamp", f"""
WITH {RAW} SELECT order_text, strftime({STAMP}, '%Y-%m-%d %H:%M:%S') AS stamp FROM raw""")
def parse_timestamp(spark, folder):
    stamp = cleaning.parse_stamp(F.col("stamp_text"), cleaning.EXTENDED_SENTINELS)
    return raw_feed(spark, folder).select("order_text", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@register("parse_date", f"WITH {RAW} SELECT order_text, strftime({DAY}, '%Y-%m-%d') AS day FROM raw")
def parse_date(spark, folder):
    day = cleaning.parse_day(F.col("day_text"))
    return raw_feed(spark, folder).select("order_text", F.date_format(day, "yyyy-MM-dd").alias("day"))


@register("hhmmss_to_seconds", f"WITH {RAW} SELECT order_text, {CLOCK} AS seconds FROM raw")
def hhmmss_to_seconds(spark, folder):
    return raw_feed(spark, folder).select(
        "order_text", cleaning.clock_to_seconds(F.col("clock_text")).alias("seconds")
    )


@register("derive_cohort", f"""
WITH {RAW} SELECT order_text, CAST(year({STAMP})*100 + month({STAMP}) AS INTEGER) AS safra FROM raw""")
def derive_cohort(spark, folder):
    stamp = cleaning.parse_stamp(F.col("stamp_text"), cleaning.EXTENDED_SENTINELS)
    return raw_feed(spark, folder).select("order_text", cleaning.cohort_of(stamp).alias("safra"))


@register("cohort_to_date", f"""
WITH {ORDERS} SELECT order_id, strftime(strptime(safra || '01', '%Y%m%d'), '%Y-%m-%d') AS data_dt FROM orders_""")
def cohort_to_date(spark, folder):
    return orders(spark, folder).select(
        "order_id", F.date_format(cleaning.cohort_start(F.col("safra")), "yyyy-MM-dd").alias("data_dt")
    )


@register("cohort_shift", f"""
WITH {ORDERS}, d AS (SELECT order_id, strptime(safra || '01', '%Y%m%d') AS m FROM orders_)
SELECT order_id,
  CAST(year(m - INTERVAL 12 MONTH)*100 + month(m - INTERVAL 12 MONTH) AS INTEGER) AS back_12,
  CAST(year(m - INTERVAL 5 MONTH)*100 + month(m - INTERVAL 5 MONTH) AS INTEGER) AS back_5,
  CAST(year(m + INTERVAL 3 MONTH)*100 + month(m + INTERVAL 3 MONTH) AS INTEGER) AS on_3 FROM d""")
def cohort_shift(spark, folder):
    c = F.col("safra")
    return orders(spark, folder).select(
        "order_id",
        cleaning.shift_cohort(c, -12).alias("back_12"),
        cleaning.shift_cohort(c, -5).alias("back_5"),
        cleaning.shift_cohort(c, 3).alias("on_3"),
    )


@register("run_stamp", f'SELECT o_orderkey, CAST({RUN_STAMP} AS BIGINT) AS "DATPROC" FROM orders')
def run_stamp(spark, folder):
    feed = Feed("orders", {"bigint": ("o_orderkey",)})
    return typed(table(spark, folder, "orders"), feed, RUN_STAMP)


LINES_ORDERS = """lo AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS paid, o_orderstatus,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS due
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def lines_orders(spark, folder):
    o = table(spark, folder, "orders")
    return table(spark, folder, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").alias("paid"), "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("due"),
    )


@register("days_between", f"""
WITH {LINES_ORDERS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(date_diff('day', CAST(due AS DATE), CAST(paid AS DATE)) AS INTEGER) AS days FROM lo""")
def days_between(spark, folder):
    return lines_orders(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalars.days_between(F.col("paid"), F.col("due")).alias("days"),
    )


@register("late_flag", f"""
WITH {LINES_ORDERS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN due IS NOT NULL AND paid > due THEN 1 ELSE 0 END AS late FROM lo""")
def late_flag(spark, folder):
    return lines_orders(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalars.late_flag(F.col("paid"), F.col("due")).alias("late"),
    )


@register("age_in_cohort", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(l_shipdate) - year(o_orderdate) END AS INTEGER) AS age
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def age_in_cohort(spark, folder):
    o = table(spark, folder, "orders")
    birth = F.when(F.col("o_orderstatus") == "P", " -1 ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, folder, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scalars.age_in_cohort(cleaning.cohort_of(F.col("l_shipdate")), birth).alias("age"),
    )


@register("column_difference_projection", """
SELECT c_custkey, c_name, c_acctbal, n_nationkey, n_name, n_regionkey
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def column_difference_projection(spark, folder):
    left = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    right = table(spark, folder, "nation").withColumn("c_nationkey", F.col("n_nationkey"))
    joined = left.alias("l").join(right.alias("r"), "c_nationkey", "left")
    return joined.select("c_custkey", "c_name", "c_acctbal", *columns_not_in(right, left))


@register("drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns_(spark, folder):
    return drop_columns(table(spark, folder, "customer"), ["c_acctbal", "c_nationkey", "rn", "DATPROC"])


@register("rename_features", """
SELECT c_custkey AS "VAR_1", c_name AS "VAR_2", c_acctbal AS "VAR_3", c_mktsegment AS "VAR_4", c_nationkey
FROM customer""")
def rename_features_(spark, folder):
    return rename_features(table(spark, folder, "customer"), "c_nationkey")[0]


@register("rename_features_mapping", """
SELECT old_name, new_name, n FROM (VALUES ('c_custkey','VAR_1'), ('c_name','VAR_2'), ('c_acctbal','VAR_3'),
  ('c_mktsegment','VAR_4')) t(old_name, new_name) JOIN (
  SELECT 'c_custkey' AS c, count(c_custkey) AS n FROM customer UNION ALL SELECT 'c_name', count(c_name) FROM customer
  UNION ALL SELECT 'c_acctbal', count(c_acctbal) FROM customer
  UNION ALL SELECT 'c_mktsegment', count(c_mktsegment) FROM customer) f ON c = old_name""")
def rename_features_mapping(spark, folder):
    df = table(spark, folder, "customer")
    renamed, mapping = rename_features(df, "c_nationkey")
    filled = renamed.agg(*[F.count(c).alias(c) for c in mapping.values()]).unpivot(
        [], list(mapping.values()), "new_name", "n"
    )
    return filled.select(
        scalars.remap(F.col("new_name"), {v: k for k, v in mapping.items()}).alias("old_name"), "new_name", "n"
    )


@register("narrow_types", """
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, CAST(l_quantity AS FLOAT)::DOUBLE AS l_quantity,
  CAST(l_partkey AS INTEGER) AS l_partkey,
  'int,int,float,int' AS types FROM lineitem""")
def narrow_types_(spark, folder):
    df = narrow_types(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey"))
    types = ",".join(f.dataType.simpleString() for f in df.schema.fields)
    return df.withColumns({"l_quantity": F.col("l_quantity").cast("double"), "types": F.lit(types)})


@register("score_points", f"""
WITH {EVENTS} SELECT event_id, round((1 - score / 1000) * 1000, 0) AS points FROM ev""")
def score_points(spark, folder):
    return event_scores(spark, folder).select("event_id", scalars.score_points(F.col("score") / 1000).alias("points"))


@register("tie_jitter", f"""
WITH {EVENTS} SELECT event_id, score + {unit_hash_sql('event_id')} * 0.0001::DOUBLE AS score FROM ev""")
def tie_jitter(spark, folder):
    return event_scores(spark, folder).select(
        "event_id", scalars.tie_jitter(F.col("score"), F.col("event_id")).alias("score")
    )


@register("range_to_category", """
WITH d AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS code FROM orders),
p AS (SELECT o_orderkey, CASE WHEN length(code) >= 3 THEN CAST(substr(code, 1, 3) AS INTEGER) END AS p FROM d)
SELECT o_orderkey, CASE WHEN p IS NULL THEN NULL WHEN p <= 399 THEN 'Sudeste' WHEN p <= 659 THEN 'Nordeste'
  WHEN p <= 699 THEN 'Norte' WHEN p <= 799 THEN 'Centro-Oeste' ELSE 'Sul' END AS region FROM p""")
def range_to_category(spark, folder):
    code = F.concat(F.lit("CEP "), F.col("o_orderkey").cast("string"), F.lit("-x"))
    return table(spark, folder, "orders").select("o_orderkey", scalars.postal_region(code).alias("region"))


DOMAINS = {"BUILDING": "GOODS", "MACHINERY": "GOODS", "AUTOMOBILE": "CARS"}
DOMAIN_CASE = "CASE segment WHEN 'BUILDING' THEN 'GOODS' WHEN 'MACHINERY' THEN 'GOODS' WHEN 'AUTOMOBILE' THEN 'CARS' ELSE segment END"


@register("domain_mapping", f"""
WITH {PEOPLE} SELECT segment, {DOMAIN_CASE} AS "TFB_segment" FROM people GROUP BY 1, 2""")
def domain_mapping(spark, folder):
    return domain_table(people(spark, folder), "segment", DOMAINS)


@register("apply_domain_mapping", f"""
WITH {PEOPLE} SELECT cust, {DOMAIN_CASE} AS "TFB_segment" FROM people""")
def apply_domain_mapping(spark, folder):
    df = people(spark, folder)
    return apply_domain(df.select("cust", "segment"), domain_table(df, "segment", DOMAINS), "segment")


@register("swap_group", f"""
WITH {POLICY}, a AS (SELECT cust, installed, CASE WHEN points >= {THRESHOLD} THEN 1 ELSE 0 END AS approved FROM policy)
SELECT cust, approved, CASE WHEN installed = 0 AND approved = 1 THEN 'swap_in'
  WHEN installed = 1 AND approved = 0 THEN 'swap_out' ELSE 'mantido' END AS grupo_swap FROM a""")
def swap_group(spark, folder):
    approved = scalars.approved_flag(F.col("points"), THRESHOLD)
    return policy(spark, folder).select(
        "cust", approved.alias("approved"), scalars.swap_group(F.col("installed"), approved).alias("grupo_swap")
    )


@register("split_features_target", f"WITH {PEOPLE} SELECT segment, balance, tier, rare, y FROM people")
def split_features_target_(spark, folder):
    return split_features_target(
        people(spark, folder), ids=["cust", "name", "nation", "nation_text", "installed"], target="y"
    )


@register("round_numeric_to_category", f"""
WITH {EVENTS} SELECT category, count(*) AS n FROM (
  SELECT CAST(CAST(floor(score * 100 / 3) AS BIGINT) AS VARCHAR) || '.0' AS category FROM ev) GROUP BY category""")
def round_numeric_to_category(spark, folder):
    return (
        event_scores(spark, folder)
        .select(scalars.round_to_category(F.floor(F.col("score") * 100 / 3).cast("double")).alias("category"))
        .groupBy("category")
        .agg(F.count("*").alias("n"))
    )


@register("ratio_features", f"""
WITH {ORDERS}, m AS (
  SELECT cust, sum(CASE WHEN safra >= 200107 THEN price END) AS a, count(CASE WHEN safra >= 200107 THEN 1 END) AS na,
         sum(price) AS b, count(*) AS nb FROM orders_ GROUP BY cust)
SELECT cust, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b,
  CASE WHEN b <> 0 THEN CAST(a AS DOUBLE) / CAST(b AS DOUBLE) END AS a_to_b,
  CASE WHEN na <> 0 THEN CAST(nb AS DOUBLE) / na END AS nb_to_na FROM m""")
def ratio_features(spark, folder):
    recent = F.col("safra") >= 200107
    m = orders(spark, folder).groupBy("cust").agg(
        F.sum(F.when(recent, F.col("price"))).cast("double").alias("a"),
        F.count(F.when(recent, 1)).alias("na"),
        F.sum("price").cast("double").alias("b"),
        F.count("*").alias("nb"),
    )
    return m.select(
        "cust", "a", "b",
        scalars.safe_ratio(F.col("a"), F.col("b")).alias("a_to_b"),
        scalars.safe_ratio(F.col("nb"), F.col("na")).alias("nb_to_na"),
    )
