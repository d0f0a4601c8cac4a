"""The three customer books in their full width, next to SQL for every column."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import REFERENCE, RUN_STAMP, table
from catalog.joins import as_doubles
from catalog.registry import register
from scoreloom.functions.cleaning import shifted
from scoreloom.operators.books import BookSpec
from scoreloom.plans import books as plans

# Lines of orders as the three feeds. The expressions are the same text in Spark and in SQL.
AMOUNTS = ("l_extendedprice", "l_quantity", "o_totalprice", "l_discount", "l_quantity - 25")


def _amount(i: int) -> str:
    """Some amounts are negative, each is missing on some lines."""
    return f"CASE WHEN l_linenumber <> {1 + i // len(AMOUNTS)} THEN CAST({AMOUNTS[i % len(AMOUNTS)]} AS DECIMAL(12,2)) END"


def _coded(column: str, **codes: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items()) + " END"


KEYS = {"NUM_CPF": "o_custkey", "SAFRA": "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT)"}
DUE, PAID = "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END", "l_shipdate"
PAYMENT_FEED = KEYS | {v: _amount(i) for i, v in enumerate(plans.PAYMENT_BOOK.values[:11])} | {
    "SEQ_FATURA": "l_linenumber",
    "IND_STATUS_FATURA": _coded("l_returnflag", A="C", R="O"),
    "COD_RAZAO_ATIVIDADE": "CASE o_orderpriority WHEN '1-URGENT' THEN 'CA' WHEN '2-HIGH' THEN 'PB' END",
}
RECHARGE_FEED = KEYS | {v: _amount(i) for i, v in enumerate(plans.RECHARGE_BOOK.values)} | {
    "FLAG_SOS": "CAST(l_linenumber % 2 AS INT)",
    "COD_PLATAFORMA_ATU": _coded("l_returnflag", A="PREPG", R="CTLFC"),
}
LATE_FEED = KEYS | {v: _amount(i) for i, v in enumerate(plans.LATE_BOOK.values[:12])} | {
    "DW_FAIXA_AGING_FATURA": "CAST(l_linenumber AS INT)",
    "DW_FAIXA_AGING_DIVIDA": "CAST(l_suppkey % 9 AS INT)",
    "DW_FAIXA_TEMPO_BASE": "CAST(l_partkey % 7 AS INT)",
    "DW_FAIXA_AGING_PROX_FECH": "CASE WHEN l_linenumber > 2 THEN CAST(l_linenumber % 4 AS INT) END",
    "IND_PDD": _coded("l_returnflag", A="S", R="N"),
    "IND_WO": _coded("l_linestatus", O="R", F="W"),
    "IND_PCCR": _coded("o_orderstatus", O="W", F="C"),
    "IND_ACA": "CASE WHEN l_linenumber < 3 THEN 'N' WHEN l_linenumber < 5 THEN 'S' END",
    "IND_PRIMEIRA_FAT": "CASE WHEN l_linenumber = 1 THEN 'S' ELSE 'N' END",
    "IND_FRAUDE": "CASE o_orderpriority WHEN '1-URGENT' THEN 'N' WHEN '2-HIGH' THEN 'S' END",
}
INTEGERS = {"DIAS_ENTRE_PAGT_E_VENC", "PAGT_ATRASADO", *(c for c in LATE_FEED if c.startswith("DW_"))}


def lines(spark, folder, columns: dict[str, str]):
    same = F.col("l_orderkey") == F.col("o_orderkey")
    joined = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), same)
    return joined.selectExpr(*(f"{e} AS `{c}`" for c, e in columns.items()))


def _rounded(total: str, count: str, digits: int) -> str:
    """A quotient of whole numbers times 10^digits, rounded half away from zero, as a whole number."""
    scale = 10**digits
    return f"(sign({total}) * ((2 * abs({total}) * {scale} + {count}) // (2 * {count})))"


def _first_quotient(total: str, count: str, whole: bool) -> str:
    """Whole numbers are divided and rounded to 2 digits at once; amounts, in cents, to 6 digits first."""
    cents = f"CAST({total} AS HUGEINT)" if whole else f"CAST({total} * 100 AS HUGEINT)"
    return _rounded(cents, f"nullif({count}, 0)", 2 if whole else 4)


def _average(first: str, whole: bool) -> str:
    hundredths = first if whole else f"(sign({first}) * ((2 * abs({first}) + 10000) // 20000))"
    return f"CAST({hundredths} AS DOUBLE) / 100"


def _cell_columns(spec: BookSpec, window: str, label: str, n: int, condition: str | None) -> str:
    """SELECT of layer 1 for one window and one condition: a table per cell, since planning grows with a query's width."""
    inside = f"FILTER (WHERE age <= {n} AND {(condition or 'TRUE').replace('`', chr(34))})"
    needed = [f for f in ("sum", "count", "max", "min") if f in spec.aggregates or f in ("sum", "count")]
    sums = [f'{f}("{v}") {inside} AS "{f}_{v}"' for v in spec.values for f in needed]
    means = [f"""{_first_quotient(f'"sum_{v}"', f'"count_{v}"', v in INTEGERS)} AS "mean_{v}\"""" for v in spec.values]
    layer1 = []
    for v in spec.values:
        whole = v in INTEGERS
        column = {
            "avg": _average(f'"mean_{v}"', whole),
            "sum": f'CAST("sum_{v}" AS {"BIGINT" if whole else "DOUBLE"})',
            "max": f'CAST("max_{v}" AS {"INTEGER" if whole else "DOUBLE"})',
            "min": f'CAST("min_{v}" AS {"INTEGER" if whole else "DOUBLE"})',
            "count": f'"count_{v}"',
        }
        layer1 += [f'{column[a]} AS "{spec.layer1_name(a, window, label, v)}"' for a in spec.aggregates]
    kept = f'HAVING max("SAFRA") = {REFERENCE}' if spec.keep_customers_without_features else ""
    return f"""SELECT "NUM_CPF", {', '.join(layer1)} FROM (SELECT *, {', '.join(means)} FROM (
  SELECT "NUM_CPF", {', '.join(sums)} FROM slice GROUP BY "NUM_CPF" {kept}))"""


def full_sql(spec: BookSpec, columns: dict[str, str], extra: str = "", where: str = "TRUE") -> str:
    index = '("SAFRA" // 100) * 12 + "SAFRA" % 100'
    cells = [
        _cell_columns(spec, window, label, n, condition)
        for window, n in spec.windows.items() for label, condition in spec.conditions()
    ]
    tables = ",\n".join(f"cell{i} AS MATERIALIZED ({cell})" for i, cell in enumerate(cells))
    joined = "cell0 " + " ".join(f'JOIN cell{i} USING ("NUM_CPF")' for i in range(1, len(cells)))
    ratios = []
    for num, den in spec.ratio_pairs():
        for label, _ in spec.conditions():
            for value in spec.values:
                a, b = (spec.layer1_name("avg", w, label, value) for w in (num, den))
                name = spec.ratio_name(num, den, label, value)
                ratios.append(f'round(CASE WHEN "{b}" <> 0 THEN "{a}" / "{b}" END, 8) AS "{name}"')
    feed = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"""
WITH feed_ AS (SELECT {feed}{extra} FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
slice AS MATERIALIZED (SELECT *, max({index}) OVER (PARTITION BY "NUM_CPF") - ({index}) AS age FROM feed_
  WHERE "SAFRA" BETWEEN {shifted(REFERENCE, -12)} AND {REFERENCE} AND {where}),
{tables}
SELECT *, {', '.join(ratios)}, CAST({REFERENCE} AS INTEGER) AS "SAFRA", CAST({RUN_STAMP} AS BIGINT) AS "DATPROC"
FROM {joined}"""


DERIVED = f""", CAST(date_diff('day', CAST({DUE} AS DATE), CAST({PAID} AS DATE)) AS INTEGER) AS "DIAS_ENTRE_PAGT_E_VENC",
  CASE WHEN {PAID} > {DUE} THEN 1 ELSE 0 END AS "PAGT_ATRASADO\""""


@register("payment_book_full", full_sql(plans.PAYMENT_BOOK, PAYMENT_FEED, DERIVED))
def payment_book_full(spark, folder):
    dates = {"DAT_STATUS_FATURA": PAID, "DAT_STATUS_PAGAMENTO": PAID, "DAT_VENCIMENTO_CREDITO": DUE}
    return as_doubles(plans.payment_book(lines(spark, folder, PAYMENT_FEED | dates), REFERENCE, RUN_STAMP))


@register("recharge_book_full", full_sql(plans.RECHARGE_BOOK, RECHARGE_FEED, where="\"COD_PLATAFORMA_ATU\" = 'PREPG'"))
def recharge_book_full(spark, folder):
    return as_doubles(plans.recharge_book(lines(spark, folder, RECHARGE_FEED), REFERENCE, RUN_STAMP))


@register("late_book_full", full_sql(plans.LATE_BOOK, LATE_FEED))
def late_book_full(spark, folder):
    return as_doubles(plans.late_book(lines(spark, folder, LATE_FEED), REFERENCE, RUN_STAMP))
