"""The three customer books and the job that builds, upserts and audits them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.scalars import days_between, late_flag
from scoreloom.operators.books import BookSpec, Indicator, backfill, build_book
from scoreloom.sources.sinks import append_audit, upsert_by_key

# Values, indicators and aggregates of the three books.
PAYMENT_BOOK = BookSpec(
    name="book_pagamento",
    suffix="PAGT",
    values=(
        "VAL_PAGAMENTO_FATURA", "VAL_DESCONTO_ITEM", "VAL_PAGAMENTO_ITEM", "VAL_JUROS_MULTAS_ITEM",
        "VAL_MULTA_EQUIP_ITEM", "VAL_MULTA_EQUIP_TOTAL", "VAL_MULTA_FID_ITEM", "VAL_BAIXA_ATIVIDADE",
        "VAL_ORIGINAL_PAGAMENTO", "VAL_ATUAL_PAGAMENTO", "VAL_PAGAMENTO_CREDITO", "DIAS_ENTRE_PAGT_E_VENC",
        "PAGT_ATRASADO",
    ),
    aggregates=("avg", "max", "sum"),
    indicators=(
        Indicator("SEQ_FATURA", "1_FATURA", (1,)),
        Indicator("IND_STATUS_FATURA", "STATUS_FAT", ("C", "O")),
        Indicator("COD_RAZAO_ATIVIDADE", "COD_ATVD_PAGT", ("CA", "PB")),
    ),
    keep_customers_without_features=False,
)
RECHARGE_BOOK = BookSpec(
    name="book_recarga",
    suffix="RECARGA",
    values=("VAL_CREDITO_INSERIDO", "VAL_BONUS", "VAL_REAL", "VALOR_SOS"),
    aggregates=("avg", "max", "min", "sum", "count"),
    indicators=(Indicator("FLAG_SOS", "FLAG_SOS", (1,)),),
)
LATE_BOOK = BookSpec(
    name="book_atraso",
    suffix="ATRASO",
    values=(
        "VAL_FAT_LIQUIDO", "VAL_FAT_BRUTO", "VAL_FAT_CREDITO", "VAL_FAT_AJUSTE", "VAL_FAT_BRUTO_BC",
        "VAL_FAT_PAGAMENTO_BRUTO", "VAL_FAT_ABERTO", "VAL_FAT_ABERTO_LIQ", "VAL_MULTA_JUROS",
        "VAL_MULTA_CANCELAMENTO", "VAL_PARC_APARELHO_LIQ", "VAL_FAT_LIQ_JM_MC", "DW_FAIXA_AGING_FATURA",
        "DW_FAIXA_AGING_DIVIDA", "DW_FAIXA_TEMPO_BASE", "DW_FAIXA_AGING_PROX_FECH",
    ),
    aggregates=("avg",),
    indicators=(
        Indicator("IND_PDD", "PDD", ("S", "N")),
        Indicator("IND_WO", "WO", ("R", "W")),
        Indicator("IND_PCCR", "PCCR", ("W", "C")),
        Indicator("IND_ACA", "ACA", ("N", "S")),
        Indicator("IND_PRIMEIRA_FAT", "PRIM_FAT", ("S", "N")),
        Indicator("IND_FRAUDE", "FRAUDE", ("N", "S")),
    ),
)
PREPAID_PLATFORM = "PREPG"
BACKFILL_COHORTS = (202410, 202411, 202412, 202501, 202502, 202503)


def payment_values(payment: DataFrame) -> DataFrame:
    """Add the two derived payment values: days from due date to status, and the late flag."""
    due = F.col("DAT_VENCIMENTO_CREDITO")
    return payment.select(
        "*",
        days_between(F.col("DAT_STATUS_FATURA"), due).alias("DIAS_ENTRE_PAGT_E_VENC"),
        late_flag(F.col("DAT_STATUS_PAGAMENTO"), due).alias("PAGT_ATRASADO"),
    )


def payment_book(payment: DataFrame, reference: int, run_stamp: int) -> DataFrame:
    return build_book(payment_values(payment), reference, PAYMENT_BOOK, run_stamp)


def recharge_book(recharge: DataFrame, reference: int, run_stamp: int) -> DataFrame:
    """Only prepaid rows count, for the aggregates and for the reference customers."""
    prepaid: Column = F.col("COD_PLATAFORMA_ATU") == PREPAID_PLATFORM
    return build_book(recharge, reference, RECHARGE_BOOK, run_stamp, row_filter=prepaid)


def late_book(late: DataFrame, reference: int, run_stamp: int) -> DataFrame:
    return build_book(late, reference, LATE_BOOK, run_stamp)


def books(feed: DataFrame, book: str, references: Sequence[int], run_stamp: int) -> DataFrame:
    """One book for several reference cohorts; the feed is read and reduced once for all of them."""
    if book == PAYMENT_BOOK.name:
        return backfill(payment_values(feed), references, PAYMENT_BOOK, run_stamp)
    if book == RECHARGE_BOOK.name:
        return backfill(feed, references, RECHARGE_BOOK, run_stamp, F.col("COD_PLATAFORMA_ATU") == PREPAID_PLATFORM)
    return backfill(feed, references, LATE_BOOK, run_stamp)


def book_job(
    feed: DataFrame,
    book: str,
    book_path: str,
    audit_path: str,
    run_stamp: int,
    references: Sequence[int] = BACKFILL_COHORTS,
) -> None:
    """Build the book of all reference cohorts, upsert them at once, then count what was written."""
    upsert_by_key(books(feed, book, references, run_stamp), book_path, values=references)
    stored = feed.sparkSession.read.parquet(book_path).where(F.col("SAFRA").isin(list(references)))
    append_audit(stored, book, audit_path)
