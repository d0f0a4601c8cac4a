import random
import re
from dataclasses import replace
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators import books
from scoreloom.operators.books import BookSpec, Indicator
from scoreloom.plans import books as plans
from scoreloom.session import fresh_path

SPEC = BookSpec("t", "X", ("v",), ("avg", "max", "min", "sum", "count"), (Indicator("s", "S", ("A",)),), key="k", cohort="c")


def feed(spark, rows):
    return spark.createDataFrame(rows, "k string, c int, s string, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))


@pytest.mark.parametrize("name,layer1,ratios", [("PAYMENT_BOOK", 1170, 312), ("RECHARGE_BOOK", 200, 32), ("LATE_BOOK", 1040, 832)])
def test_book_sizes(name, layer1, ratios):
    spec = getattr(plans, name)
    n_conditions = len(spec.conditions())
    assert len(spec.windows) * len(spec.values) * len(spec.aggregates) * n_conditions == layer1
    assert len(spec.ratio_pairs()) * len(spec.values) * n_conditions == ratios


def test_names():
    spec = plans.PAYMENT_BOOK
    assert spec.layer1_name("avg", "U3M", "1_FATURA_1_", "VAL_PAGAMENTO_FATURA") == "VL_MED_U3M_1_FATURA_1_VAL_PAGAMENTO_FATURA_PAGT"
    assert spec.ratio_name("U1M", "U3M", "COD_ATVD_PAGT_CA_", "VAL_BAIXA_ATIVIDADE") == "RAZ_MED_U1M_U3M_COD_ATVD_CA_VAL_BAIXA_ATIVIDADE_PAGT"
    assert spec.ratio_name("U1M", "U3M", "", "DIAS_ENTRE_PAGT_E_VENC") == "RAZ_MED_U1M_U3M_DIAS_ENTRE_E_VENC_PAGT"


def test_windows_end_at_the_last_active_month(spark):
    rows = feed(spark, [("a", 202405, "A", "1"), ("a", 202404, "A", "2"), ("a", 202403, "A", "4"), ("b", 202410, "A", "8")])
    spec = replace(SPEC, keep_customers_without_features=False)
    got = {r["k"]: r for r in books.build_book(rows, 202410, spec, 1).collect()}
    assert got["a"]["VL_TOT_U1M_v_X"] == 3 and got["a"]["VL_TOT_U3M_v_X"] == 7 and got["a"]["VL_QT_U1M_v_X"] == 2
    fixed = books.build_book(rows, 202410, replace(spec, anchor="cohort"), 1)
    got = {r["k"]: r for r in fixed.collect()}
    assert got["a"]["VL_TOT_U3M_v_X"] is None and got["a"]["VL_QT_U3M_v_X"] == 0 and got["a"]["VL_TOT_U6M_v_X"] == 3 and got["a"]["VL_TOT_U9M_v_X"] == 7
    flags = {(r["k"], r["c"]): r["U1M"] for r in books.window_flags(rows, SPEC).collect()}
    assert flags == {("a", 202405): 1, ("a", 202404): 1, ("a", 202403): 0, ("b", 202410): 1}


def test_ratio_over_zero_or_null(spark):
    rows = feed(spark, [("a", 202410, "A", "0"), ("a", 202406, "A", "0"), ("b", 202410, "B", None)])
    got = {r["k"]: r for r in books.build_book(rows, 202410, SPEC, 1).collect()}
    assert got["a"]["RAZ_MED_U1M_U3M_v_X"] is None and got["b"]["RAZ_MED_U1M_U3M_v_X"] is None


def test_reference_population(spark):
    rows = feed(spark, [("a", 202410, "A", "5"), ("b", 202410, "B", "5"), ("c", 202409, "A", "5")])
    got = books.build_book(rows, 202410, SPEC, 7, row_filter=F.col("s") == "A", population=rows).collect()
    assert {r["k"]: r["VL_TOT_U1M_v_X"] for r in got} == {"a": 5, "b": None}
    assert {(r["c"], r["DATPROC"]) for r in got} == {(202410, 7)}
    own = books.build_book(rows, 202410, SPEC, 7, row_filter=F.col("s") == "A")
    assert [r["k"] for r in own.collect()] == ["a"]


def half_up(x, digits):
    return x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def test_against_brute_force_with_a_hot_customer(spark):
    rng, data = random.Random(1), []
    for i in range(900):
        customer = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        month = 202300 + rng.randrange(1, 13) if rng.random() < 0.5 else 202400 + rng.randrange(1, 11)
        data.append((customer, month, rng.choice("AB"), None if rng.random() < 0.1 else f"{rng.uniform(-50, 50):.2f}"))
    got = {r["k"]: r for r in books.build_book(feed(spark, data), 202410, SPEC, 1).collect()}
    inside = [r for r in data if 202310 <= r[1] <= 202410]
    month_no = lambda c: c // 100 * 12 + c % 100
    active = {k for k, c, _, _ in inside if c == 202410}
    assert set(got) == active and "hot" in active
    for k in active:
        mine = [r for r in inside if r[0] == k]
        last = max(month_no(r[1]) for r in mine)
        for window, n in SPEC.windows.items():
            for label, status in (("", None), ("S_A_", "A")):
                vs = [Decimal(r[3]) for r in mine if last - month_no(r[1]) <= n and r[3] and status in (None, r[2])]
                row = got[k]
                assert row[f"VL_QT_{window}_{label}v_X"] == len(vs)
                assert row[f"VL_TOT_{window}_{label}v_X"] == (sum(vs) if vs else None)
                assert row[f"VL_MAX_{window}_{label}v_X"] == (max(vs) if vs else None)
                assert row[f"VL_MIN_{window}_{label}v_X"] == (min(vs) if vs else None)
                mean = half_up(half_up(sum(vs) / len(vs), 6), 2) if vs else None
                assert row[f"VL_MED_{window}_{label}v_X"] == mean


def test_average_equals_the_built_in_one(spark):
    rng = random.Random(5)
    data = [("a", 202410 - rng.randrange(3), "A", f"{rng.uniform(0, 1):.2f}") for _ in range(97)]
    rows = feed(spark, data)
    want = rows.agg(F.round(F.avg("v"), 2)).first()[0]
    got = books.build_book(rows, 202410, SPEC, 1).first()["VL_MED_U12M_v_X"]
    assert got == want


def test_backfill_equals_single_books(spark):
    rng = random.Random(2)
    data = [(f"k{rng.randrange(9)}", 202400 + rng.randrange(1, 13), rng.choice("AB"), f"{rng.uniform(0, 9):.2f}") for _ in range(300)]
    rows = feed(spark, data)
    many = sorted(map(str, books.backfill(rows, [202408, 202410], SPEC, 1).collect()))
    single = sorted(str(r) for c in (202408, 202410) for r in books.build_book(rows, c, SPEC, 1).collect())
    assert many == single


def test_book_job_is_repeatable(spark):
    columns = ["NUM_CPF string", "SAFRA int", "COD_PLATAFORMA_ATU string", "FLAG_SOS int"]
    columns += [f"{v} decimal(10,2)" for v in plans.RECHARGE_BOOK.values]
    one = Decimal("1.50")
    rows = spark.createDataFrame(
        [("a", 202410, "PREPG", 1, one, one, one, one), ("a", 202409, "PREPG", 0, one, one, one, one),
         ("b", 202410, "POSPG", 0, one, one, one, one), ("c", 202409, "PREPG", 0, one, one, one, one)],
        ", ".join(columns),
    )
    book, audit = fresh_path(spark, "book"), fresh_path(spark, "audit")
    for _ in range(2):
        plans.book_job(rows, "book_recarga", book, audit, 1, references=[202409, 202410])
    got = {(r["NUM_CPF"], r["SAFRA"]): r["VL_TOT_U12M_VAL_REAL_RECARGA"] for r in spark.read.parquet(book).collect()}
    assert got == {("a", 202409): one, ("a", 202410): 2 * one, ("c", 202409): one}
    assert spark.read.parquet(audit).count() == 4


def test_full_payment_book(spark):
    from scoreloom.sources.feeds import PAYMENT
    from scoreloom.plans.silver import silver
    from tests.test_feeds import raw

    rows = [
        {"NUM_CPF": "A", "DAT_STATUS_FATURA": f"{d:02d}OCT2024:00:00:00", "CONTRATO": str(d), "NUM_SUB_SEQ_FATURA": "1",
         "SEQ_FATURA": "1", "VAL_PAGAMENTO_FATURA": f"{d}.00", "DAT_STATUS_PAGAMENTO": "20OCT2024:00:00:00",
         "DAT_VENCIMENTO_CREDITO": "15OCT2024:00:00:00"}
        for d in (10, 20)
    ]
    got = plans.payment_book(silver(raw(spark, PAYMENT, rows), PAYMENT, 1), 202410, 1)
    assert len(got.columns) == 1170 + 312 + 3
    r = got.first()
    assert r["VL_TOT_U1M_VAL_PAGAMENTO_FATURA_PAGT"] == 30 and r["VL_MED_U1M_1_FATURA_1_VAL_PAGAMENTO_FATURA_PAGT"] == 15
    assert r["VL_MAX_U1M_DIAS_ENTRE_PAGT_E_VENC_PAGT"] == 5 and r["VL_TOT_U1M_PAGT_ATRASADO_PAGT"] == 2
    assert r["RAZ_MED_U1M_U3M_VAL_PAGAMENTO_FATURA_PAGT"] == 1


def test_books_grow_month_by_month(spark, tmp_path):
    """Two loads with late rows and a new month give what one build over all rows gives; untouched months stay as they are."""
    spec = books.BookSpec("b", "X", ("v",), ("avg", "max", "min", "sum", "count"), (books.Indicator("k", "K", ("a", "b")),), key="id", cohort="safra")
    rows = [(i % 9, 202400 + m, Decimal(i * m % 37) / 4, "ab"[i % 2], 2 if m == 12 or (m == 3 and i % 4 == 0) else 1)
            for m in range(1, 13) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, safra int, v decimal(10,2), k string, load int")
    df.write.partitionBy("safra").parquet(str(tmp_path / "feed"))
    feed = spark.read.schema(df.schema).parquet(str(tmp_path / "feed"))
    store = books.StoredMonths(str(tmp_path / "store"), spec)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "store" / "months").rglob("*.parquet")}
    assert store.grow(feed.where("load = 1"), "load") == list(range(202401, 202412))
    before = files()
    assert store.changed(feed, "load") == {202403: 2, 202412: 2}
    assert store.grow(feed, "load", [202412]) == [202412] and store.grow(feed, "load") == [202403]
    assert store.grow(feed, "load") == []
    after = files()
    kept = {p for p in before if "safra=202403" not in p}
    assert all(after.get(p) == before[p] for p in kept) and not {p for p in before if "safra=202403" in p} & set(after)
    whole = books.build_book(df, 202412, spec, 7)
    got, want = (sorted(map(tuple, d.select(whole.columns).collect())) for d in (store.book(spark, 202412, 7), whole))
    assert got == want and len(got) == 9
    plan = feed.where(F.col("safra").isin([202412]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*safra", plan)


def test_customer_without_months_in_any_window_stays(spark):
    """Anchored at the reference cohort: later and much older months are in no window, but their customers stay."""
    rows = feed(spark, [("late", 202411, "A", "1"), ("old", 202301, "A", "2"), ("both", 202411, "A", "4"), ("both", 202409, "A", "8")])
    spec = replace(SPEC, anchor="cohort")
    types = {f.name: f.dataType for f in rows.schema.fields}
    got = {r["k"]: r for r in books.window_features(books.customer_months(rows, spec), spec, types, 202410).collect()}
    assert set(got) == {"late", "old", "both"}
    assert all(got[k]["VL_TOT_U12M_v_X"] is None and got[k]["VL_QT_U12M_v_X"] == 0 for k in ("late", "old"))
    assert got["both"]["VL_TOT_U1M_v_X"] == 8 and got["both"]["VL_QT_U12M_v_X"] == 1


def test_averages_of_hundredths_are_those_of_decimals(spark):
    rng = random.Random(3)
    rows = [(rng.randint(-10**k, 10**k), rng.randint(0, 10 ** rng.randint(0, 5))) for k in range(1, 12) for _ in range(40)]
    rows += [(s * sign, n) for sign in (1, -1) for s, n in [(1, 2), (1, 3), (10_000, 20_001), (9_999, 20_000), (9_998, 20_000), (25, 10)]] + [(None, 0)]
    part, amount = {"sum": "s", "count": "n", "max": "s", "min": "s"}, T.DecimalType(12, 2)
    of_longs = spark.createDataFrame(rows, "s bigint, n bigint").selectExpr("monotonically_increasing_id() AS id", "s", "n")
    of_decimals = of_longs.selectExpr("id", "cast(cast(s AS decimal(32,0)) * 0.01BD AS decimal(32,2)) AS s", "n")
    new = of_longs.selectExpr("id", *[f"{books._combined_hundredths(a, part, amount)} AS {a}" for a in ("avg", "sum", "count")])
    old = of_decimals.selectExpr("id", *[f"{books._combined(a, part, amount)} AS {a}" for a in ("avg", "sum", "count")])
    assert [f.dataType for f in new.schema] == [f.dataType for f in old.schema]
    assert sorted(new.collect()) == sorted(old.collect(), key=lambda r: r["id"])


def test_book_of_many_columns_has_few_expressions(spark):
    """Compiling an expression for each of 1,482 features took most of every task's 20 seconds at sf0.1."""
    spec, fields = plans.PAYMENT_BOOK, spark.conf.get("spark.sql.debug.maxToStringFields")
    values = ", ".join(f"cast(1 AS decimal(12,2)) AS {v}" for v in spec.values)
    feed_ = spark.sql(f"SELECT 1 AS NUM_CPF, 202410 AS SAFRA, 1 AS SEQ_FATURA, 'C' AS IND_STATUS_FATURA, 'CA' AS COD_RAZAO_ATIVIDADE, {values} FROM range(2)")
    book = books.build_book(feed_, 202410, spec, 1)
    try:
        spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
        plan = book._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert plan.count(" / ") < 50 and plan.count("CASE WHEN") < 400  # by feature they were 702 divisions
    row = book.first()
    assert row["VL_TOT_U12M_1_FATURA_1_VAL_PAGAMENTO_FATURA_PAGT"] == 2 and row["RAZ_MED_U9M_U12M_VAL_PAGAMENTO_FATURA_PAGT"] == 1
    assert row["VL_TOT_U12M_STATUS_FAT_O_VAL_PAGAMENTO_FATURA_PAGT"] is None
