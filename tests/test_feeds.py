import pytest
from pyspark.sql import functions as F

from scoreloom.plans.public_table import one_big_table, public_summary, with_region
from scoreloom.plans.silver import duplicate_lookup, silver, silver_job
from scoreloom.session import fresh_path
from scoreloom.sources import feeds

RUN = 20250401120000


def raw(spark, feed, rows):
    """A text table with all columns of a feed, missing ones NULL."""
    names = feed.names
    data = [[r.get(n) for n in names] for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))


def test_column_counts(spark):
    sizes = {n: len(silver(raw(spark, f, []), f, RUN).columns) for n, f in feeds.FEEDS.items()}
    assert sizes == {
        "base_pagamento": 75, "base_atraso": 52, "base_recarga": 26, "base_dados_cadastrais": 34,
        "base_score_bureau_movel": 9, "base_telco": 75,
    }


def test_payment_job(spark):
    base = {"NUM_CPF": "A", "DAT_STATUS_FATURA": "06OCT2023:00:00:00", "CONTRATO": " 7 ", "NUM_SUB_SEQ_FATURA": "1"}
    rows = [
        {**base, "VAL_PAGAMENTO_FATURA": "10.50", "SEQ_FATURA": "12.7"},
        {**base, "VAL_PAGAMENTO_FATURA": "99.00"},
        {**base, "NUM_CPF": "B", "DAT_STATUS_FATURA": "null", "VAL_PAGAMENTO_FATURA": "123456789012.5"},
        {**base, "NUM_CPF": "C", "DAT_STATUS_FATURA": "bad", "CONTRATO": "x"},
    ]
    path, table, audit = (fresh_path(spark, x) for x in ("raw", "silver", "audit"))
    raw(spark, feeds.PAYMENT, rows).write.parquet(path)
    silver_job(spark, feeds.PAYMENT, path, table, audit, RUN)
    got = {r["NUM_CPF"]: r for r in spark.read.parquet(table).collect()}
    assert set(got) == {"A", "B", "C"}
    assert (got["A"]["SAFRA"], got["A"]["CONTRATO"], got["A"]["DATPROC"]) == (202310, 7, RUN)
    assert got["B"]["SAFRA"] is None and got["B"]["VAL_PAGAMENTO_FATURA"] is None
    assert got["C"]["SAFRA"] is None and got["C"]["CONTRATO"] is None
    counts = {r["safra"]: r["qtd_registros"] for r in spark.read.parquet(audit).collect()}
    assert counts == {202310: 1, None: 2}


def test_whole_row_duplicates_and_lookup(spark):
    one = {"NUM_CPF": "A", "DW_NUM_NTC": "5", "DAT_INSERCAO_CREDITO": "06OCT2023:00:00:00", "HOR_INSERCAO_CREDITO": "93015"}
    got = silver(raw(spark, feeds.RECHARGE, [one, one, {**one, "HOR_INSERCAO_CREDITO": "-2"}]), feeds.RECHARGE, RUN)
    found = duplicate_lookup(got, "A", "5", "2023-10-06 00:00:00").collect()
    assert [r["HOR_INSERCAO_CREDITO"] for r in found] == [None, 34215]


def test_strict_feed_fails(spark):
    bad = raw(spark, feeds.BUREAU, [{"NUM_CPF": "A", "SAFRA": "202410", "SCORE_01": "many"}])
    with pytest.raises(Exception):
        silver(bad, feeds.BUREAU, RUN).collect()


def test_one_big_table(spark):
    keys = {"NUM_CPF": "A", "SAFRA": "202410", "FLAG_INSTALACAO": "1", "FPD": "0", "PROD": "P", "flag_mig2": "PRE"}
    bureau = silver(raw(spark, feeds.BUREAU, [{**keys, "SCORE_01": "500"}, {**keys, "NUM_CPF": "B", "FPD": "1"}]), feeds.BUREAU, RUN)
    telco = silver(raw(spark, feeds.TELCO, [{**keys, "var_26": "1.5"}]), feeds.TELCO, RUN)
    reg = silver(
        raw(spark, feeds.REGISTRATION, [{**keys, "DATADENASCIMENTO": "05/03/1990", "CEP_3_digitos": "405", "var_02": "3"}]),
        feeds.REGISTRATION, RUN,
    )
    table = one_big_table(bureau, telco, reg, RUN)
    assert len(table.columns) == 8 + 68 + 24 + 3 + 1
    got = {r["NUM_CPF"]: r for r in with_region(table).collect()}
    assert (got["A"]["IDADE"], got["A"]["var_26"], got["A"]["var_02"], got["A"]["regiao"]) == (34, 1.5, 3, "Nordeste")
    assert got["B"]["IDADE"] is None and got["B"]["regiao"] is None
    assert public_summary(table).collect()[0]["pct_target"] == 50.0
    assert table.where(F.col("DATPROC") == RUN).count() == 2
