"""Assembling wide tables, upsert-like unions, books."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import BACKFILL, ORDERS, PEOPLE, REFERENCE, RUN_STAMP, orders, people, table
from catalog.registry import register
from scoreloom.functions.scalars import age_in_cohort
from scoreloom.operators import assemble, books
from scoreloom.operators.books import BookSpec, Indicator
from scoreloom.operators.dedup import dedup_full_row, dedup_latest
from scoreloom.operators.profile import percent_of, row_total
from scoreloom.session import fresh_path
from scoreloom.plans.books import payment_values


# --- star joins on customer and month ------------------------------------------------------------

def months(rows, label, condition=None):
    rows = rows if condition is None else rows.where(condition)
    return rows.groupBy("cust", "safra").agg(
        F.count("*").alias(f"n_{label}"), F.sum("price").cast("double").alias(f"total_{label}")
    )


MONTHS = ",\n".join(
    f"m_{label} AS (SELECT cust, safra, count(*) AS n_{label}, CAST(sum(price) AS DOUBLE) AS total_{label}"
    f" FROM orders_ {where} GROUP BY cust, safra)"
    for label, where in {
        "all": "", "f": "WHERE status = 'F'", "o": "WHERE status = 'O'", "p": "WHERE status = 'P'",
        "u": "WHERE priority = '1-URGENT'",
    }.items()
)
STAR = f"WITH {ORDERS}, {PEOPLE}, {MONTHS}"


def month_tables(spark, folder):
    rows = orders(spark, folder)
    return months(rows, "all"), {
        "f": months(rows, "f", "status = 'F'"), "o": months(rows, "o", "status = 'O'"),
        "p": months(rows, "p", "status = 'P'"), "u": months(rows, "u", "priority = '1-URGENT'"),
    }


@register("obt_left_join", f"""
{STAR} SELECT b.cust, b.safra, n_all, total_all, n_f, total_f, n_u, total_u,
  CAST(safra // 100 AS INTEGER) - 1970 AS idade
FROM m_all b LEFT JOIN m_f USING (cust, safra) LEFT JOIN m_u USING (cust, safra)""")
def obt_left_join(spark, folder):
    base, parts = month_tables(spark, folder)
    third = parts["u"].withColumn("total_f", F.lit(-1.0)).withColumn("birth", F.lit("1970-05-17"))
    wide = assemble.star_join(base, [parts["f"], third], ["cust", "safra"])
    return wide.select(
        "cust", "safra", "n_all", "total_all", "n_f", "total_f", "n_u", "total_u",
        age_in_cohort(F.col("safra"), F.lit("1970-05-17")).alias("idade"),
    )


ABT = """SELECT b.cust, b.safra, n_all, total_all, n_f, total_f, n_o, total_o, n_p, total_p, n_u, total_u
FROM {base} b LEFT JOIN m_f USING (cust, safra) LEFT JOIN m_o USING (cust, safra)
LEFT JOIN m_p USING (cust, safra) LEFT JOIN m_u USING (cust, safra)"""


@register("abt_star_join", f"""{STAR}, base AS (
  SELECT m_all.* FROM m_all JOIN people USING (cust) WHERE installed = 1 AND safra BETWEEN 200102 AND 200107)
{ABT.format(base='base')}""")
def abt_star_join(spark, folder):
    base, parts = month_tables(spark, folder)
    installed = people(spark, folder).where("installed = 1").select("cust")
    base = assemble.cohort_range(base, 200102, 200107, "safra").join(installed, "cust", "left_semi")
    return assemble.star_join(base, list(parts.values()), ["cust", "safra"])


@register("augmented_population_join", f"{STAR} {ABT.format(base='m_all')}")
def augmented_population_join(spark, folder):
    base, parts = month_tables(spark, folder)
    return assemble.star_join(base, list(parts.values()), ["cust", "safra"])


@register("scalar_cross_join", f"""
WITH {ORDERS} SELECT status, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders_), 2)::DOUBLE AS pct
FROM orders_ GROUP BY status""")
def scalar_cross_join(spark, folder):
    rows = orders(spark, folder)
    counts = rows.groupBy("status").agg(F.count("*").alias("n"))
    return counts.select("status", "n", percent_of("n", row_total(rows)).alias("pct"))


@register("union_populations", f"""
WITH {PEOPLE} SELECT cust, installed, balance, y FROM people WHERE installed = 1
UNION ALL SELECT cust, installed, balance, NULL FROM people WHERE installed = 0""")
def union_populations(spark, folder):
    df = people(spark, folder).select("cust", "installed", "balance", "y")
    return assemble.union_populations(
        [df.where("installed = 1"), df.where("installed = 0").drop("y")], ["cust", "installed", "balance", "y"]
    )


@register("distinct_keys", f"WITH {ORDERS} SELECT DISTINCT cust FROM orders_ WHERE priority = '1-URGENT'")
def distinct_keys(spark, folder):
    return orders(spark, folder).where("priority = '1-URGENT'").select("cust").distinct()


# --- de-duplication --------------------------------------------------------------------------------

@register("dedup_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
       strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_latest_(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )
    return dedup_latest(rows, ["l_orderkey", "l_linenumber"], ["shipped"])


@register("dedup_full_row", f"WITH {ORDERS} SELECT order_id, cust, safra, status FROM orders_")
def dedup_full_row_(spark, folder):
    rows = orders(spark, folder).select("order_id", "cust", "safra", "status")
    return dedup_full_row(rows.unionByName(rows.where("order_id % 10 = 0")))


# --- books ------------------------------------------------------------------------------------------

ORDER_BOOK = BookSpec(
    name="book_orders", suffix="ORD", values=("price",), aggregates=("avg", "max", "min", "sum", "count"),
    indicators=(Indicator("status", "ST", ("F", "O", "P")),), key="cust", cohort="safra",
)
ALL_CUSTOMERS = BookSpec(**{**ORDER_BOOK.__dict__, "keep_customers_without_features": False})
COHORT_ANCHOR = BookSpec(**{**ORDER_BOOK.__dict__, "anchor": "cohort", "indicators": ()})


def as_doubles(df):
    """Decimals as DOUBLE; ratios, which are divided as decimals here and as doubles in SQL, to 8 digits."""
    out = []
    for f in df.schema.fields:
        c = f"cast(`{f.name}` AS double)" if f.dataType.typeName() == "decimal" else f"`{f.name}`"
        out.append(f"{f'round({c}, 8)' if f.name.startswith('RAZ_') else c} AS `{f.name}`")
    return df.selectExpr(*out)


def average_sql(condition: str) -> str:
    """Average rounded first to 6 and then to 2 digits, in whole cents (no negative prices occur)."""
    total = f"CAST(sum(CASE WHEN {condition} THEN price END) * 100 AS HUGEINT)"
    count = f"nullif(count(CASE WHEN {condition} THEN price END), 0)"
    six = f"((2 * {total} * 10000 + {count}) // (2 * {count}))"
    return f"CAST((2 * {six} + 10000) // 20000 AS DOUBLE) / 100"


def book_sql(spec: BookSpec, reference: int, feed_where: str = "TRUE", customers: str | None = None) -> str:
    """SELECT of a whole book; ``customers`` is a query giving the reference population."""
    first = books.shifted(reference, -12)
    index = "(safra // 100) * 12 + safra % 100"
    last = f"max({index}) OVER (PARTITION BY cust)" if spec.anchor == "customer" else f"{reference // 100 * 12 + reference % 100}"
    labels = [("", "TRUE")] + [(f"{i.alias}_{v}_", f"{i.column} = '{v}'") for i in spec.indicators for v in i.values]
    layer1, ratios = [], []
    for w, n in spec.windows.items():
        for label, condition in labels:
            inside = f"age <= {n} AND {condition}"
            expressions = {
                "avg": average_sql(inside),
                "max": f"CAST(max(CASE WHEN {inside} THEN price END) AS DOUBLE)",
                "min": f"CAST(min(CASE WHEN {inside} THEN price END) AS DOUBLE)",
                "sum": f"CAST(sum(CASE WHEN {inside} THEN price END) AS DOUBLE)",
                "count": f"count(CASE WHEN {inside} THEN price END)",
            }
            layer1 += [f'{expressions[a]} AS "{spec.layer1_name(a, w, label, "price")}"' for a in spec.aggregates]
    for num, den in spec.ratio_pairs():
        for label, _ in labels:
            a, b = (spec.layer1_name("avg", w, label, "price") for w in (num, den))
            ratios.append(f'round(CASE WHEN "{b}" <> 0 THEN "{a}" / "{b}" END, 8) AS "{spec.ratio_name(num, den, label, "price")}"')
    joined = f"({customers}) k LEFT JOIN l1 USING (cust)" if customers else "l1"
    return f"""SELECT *, {', '.join(ratios)}, CAST({reference} AS INTEGER) AS safra, CAST({RUN_STAMP} AS BIGINT) AS "DATPROC"
FROM (WITH slice AS (SELECT *, {last} - ({index}) AS age FROM orders_
        WHERE safra BETWEEN {first} AND {reference} AND {feed_where}),
      l1 AS (SELECT cust, {', '.join(layer1)} FROM slice GROUP BY cust)
      SELECT * FROM {joined})"""


def customers_sql(reference, where="TRUE"):
    return f"SELECT DISTINCT cust FROM orders_ WHERE safra = {reference} AND {where}"


@register("feature_book", f"WITH {ORDERS} {book_sql(ORDER_BOOK, REFERENCE, customers=customers_sql(REFERENCE))}")
def feature_book(spark, folder):
    """De-duplicated orders of known customers to one wide row per customer of the reference cohort."""
    known = table(spark, folder, "customer").select(F.col("c_custkey").alias("cust"))
    rows = dedup_latest(orders(spark, folder), ["order_id"], ["order_date"]).join(known, "cust", "left_semi")
    return as_doubles(books.build_book(rows, REFERENCE, ORDER_BOOK, RUN_STAMP))


URGENT = "priority = '1-URGENT'"


@register("reference_population_join", f"""
WITH {ORDERS} {book_sql(ORDER_BOOK, REFERENCE, URGENT, customers_sql(REFERENCE))}""")
def reference_population_join(spark, folder):
    rows = orders(spark, folder)
    book = books.build_book(rows, REFERENCE, ORDER_BOOK, RUN_STAMP, row_filter=F.expr(URGENT), population=rows)
    return as_doubles(book)


@register("window_flag_aggregates", f"""
WITH {ORDERS} SELECT * EXCLUDE (safra, "DATPROC", {', '.join('"RAZ_MED_%s_%s_price_ORD"' % p for p in COHORT_ANCHOR.ratio_pairs())})
FROM ({book_sql(COHORT_ANCHOR, REFERENCE)})""")
def window_flag_aggregates(spark, folder):
    rows = books.cohort_slice(books.book_rows(orders(spark, folder), COHORT_ANCHOR), REFERENCE, COHORT_ANCHOR)
    types = {f.name: f.dataType for f in rows.schema.fields}
    return as_doubles(
        books.window_features(books.customer_months(rows, COHORT_ANCHOR), COHORT_ANCHOR, types, REFERENCE)
    )


@register("indicator_window_aggregates", f"""
WITH {ORDERS} {book_sql(ALL_CUSTOMERS, REFERENCE)}""")
def indicator_window_aggregates(spark, folder):
    return as_doubles(books.build_book(orders(spark, folder), REFERENCE, ALL_CUSTOMERS, RUN_STAMP))


@register("anchored_window_flags", f"""
WITH {ORDERS}, s AS (SELECT *, max((safra // 100) * 12 + safra % 100) OVER (PARTITION BY cust)
    - ((safra // 100) * 12 + safra % 100) AS age FROM orders_ WHERE safra BETWEEN 200007 AND 200107)
SELECT order_id, cust, safra, {', '.join(f'CASE WHEN age <= {n} THEN 1 ELSE 0 END AS "{w}"' for w, n in books.WINDOWS.items())}
FROM s""")
def anchored_window_flags(spark, folder):
    rows = books.cohort_slice(orders(spark, folder), REFERENCE, ORDER_BOOK).select("order_id", "cust", "safra")
    return books.window_flags(rows, ORDER_BOOK)


BACKFILL_SQL = "\nUNION ALL BY NAME\n".join(
    book_sql(ORDER_BOOK, c, customers=customers_sql(c)) for c in BACKFILL
)


@register("book_backfill", f"WITH {ORDERS} {BACKFILL_SQL}")
def book_backfill(spark, folder):
    return as_doubles(books.backfill(orders(spark, folder), BACKFILL, ORDER_BOOK, RUN_STAMP))


@register("book_growth", f"WITH {ORDERS} {book_sql(ORDER_BOOK, REFERENCE, customers=customers_sql(REFERENCE))}")
def book_growth(spark, folder):
    """Two loads: the second brings the reference month and late rows of one before; the book is that of all rows."""
    path, late = fresh_path(spark, "growing"), (F.col("safra") == 200103) & (F.col("order_id") % 5 == 0)
    rows = orders(spark, folder).withColumn("load", F.when(late | (F.col("safra") >= REFERENCE), 2).otherwise(1))
    rows.write.partitionBy("safra").parquet(f"{path}/feed")
    feed = spark.read.schema(rows.schema).parquet(f"{path}/feed")
    store = books.StoredMonths(f"{path}/store", ORDER_BOOK)
    store.grow(feed.where("load = 1"), "load")
    store.grow(feed, "load")
    return as_doubles(store.book(spark, REFERENCE, RUN_STAMP))


@register("payment_book_values", f"""
WITH lo AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS paid,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS due FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(date_diff('day', CAST(due AS DATE), CAST(paid AS DATE)) AS INTEGER) AS "DIAS_ENTRE_PAGT_E_VENC",
  CASE WHEN due IS NOT NULL AND paid > due THEN 1 ELSE 0 END AS "PAGT_ATRASADO" FROM lo""")
def payment_book_values(spark, folder):
    o = table(spark, folder, "orders")
    feed = table(spark, folder, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").alias("DAT_STATUS_FATURA"), F.col("l_shipdate").alias("DAT_STATUS_PAGAMENTO"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("DAT_VENCIMENTO_CREDITO"),
    )
    return payment_values(feed).drop("DAT_STATUS_FATURA", "DAT_STATUS_PAGAMENTO", "DAT_VENCIMENTO_CREDITO")
