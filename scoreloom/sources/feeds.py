"""Raw feeds: declared columns, target types and cleaning rules, applied as one projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.cleaning import (
    BASIC_SENTINELS,
    EXTENDED_SENTINELS,
    clock_to_seconds,
    cohort_of,
    parse_day,
    parse_stamp,
)


@dataclass(frozen=True)
class Feed:
    """What a raw directory must become.

    ``columns`` maps a kind (text, int, bigint, double, money, stamp, day, clock) to names.
    ``cohort_from`` names the stamp whose month becomes SAFRA, if the feed has none.
    ``strict`` makes plain casts, and ``strict_days`` the named dates, fail on bad input.
    ``key`` is the de-duplication key; an empty key means whole rows.
    """

    name: str
    columns: dict[str, tuple[str, ...]]
    key: tuple[str, ...] = ()
    cohort_from: str | None = None
    sentinels: tuple[str, ...] = BASIC_SENTINELS
    strict: bool = False
    strict_days: frozenset[str] = field(default_factory=frozenset)

    @property
    def names(self) -> list[str]:
        return [c for group in self.columns.values() for c in group]


PLAIN_TYPES = {"text": "string", "int": "int", "bigint": "bigint", "double": "double", "money": "decimal(10,2)"}


def coerce(feed: Feed, name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "stamp":
        return parse_stamp(c, feed.sentinels)
    if kind == "day":
        return parse_day(c, strict=name in feed.strict_days)
    if kind == "clock":
        return clock_to_seconds(c, feed.sentinels)
    return c.cast(PLAIN_TYPES[kind]) if feed.strict else c.try_cast(PLAIN_TYPES[kind])


def typed(raw: DataFrame, feed: Feed, run_stamp: int) -> DataFrame:
    """One projection: every declared column in its type, the cohort, and the run stamp.

    The cohort comes from the parsed stamp, so a bad date gives a NULL cohort, never an error.
    """
    out = [coerce(feed, name, kind).alias(name) for kind, names in feed.columns.items() for name in names]
    if feed.cohort_from:
        out.append(cohort_of(parse_stamp(F.col(feed.cohort_from), feed.sentinels)).alias("SAFRA"))
    return raw.select(*out, F.lit(run_stamp).cast("bigint").alias("DATPROC"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def _names(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def _numbered(first: int, last: int, skip: tuple[int, ...] = ()) -> tuple[str, ...]:
    return tuple(f"var_{i:02d}" for i in range(first, last + 1) if i not in skip)


# The columns of the six feeds by target type, and their keys.
PAYMENT = Feed(
    "base_pagamento",
    {
        "text": _names(
            "NUM_CPF DW_TIPO_FATURA IND_STATUS_FATURA DW_NUM_CLIENTE DW_UN_NEGOCIO DW_FORMA_PAGAMENTO DW_BANCO "
            "DW_TIPO_PAGAMENTO NUM_BANCO_PAGAMENTO NUM_AGENCIA_PAGAMENTO NUM_CC_PAGAMENTO DW_MOTIVO_ESTORNO "
            "COD_ORIGEM_NETUNO COD_CONTA_ATIVIDADE COD_LOGIN_OPERADOR_ATIVIDADE COD_ATIVIDADE COD_RAZAO_ATIVIDADE "
            "COD_FUNDO_ATIVIDADE COD_BANCO_ATIVIDADE NUM_CONTA_ATIVIDADE COD_AGENCIA_ATIVIDADE COD_LOGIN_PAGAMENTO "
            "COD_FORMA_PAGAMENTO NUM_FATURA_PAGAMENTO COD_TIPO_PAGAMENTO DSC_NOME_BANCO_PAGAMENTO "
            "NUM_PARCELA_PAGAMENTO NUM_AGRUPADOR_PAGAMENTO DSC_PAGAMENTO IND_STATUS_PAGAMENTO COD_ARQUIVO_PAGAMENTO "
            "COD_NETUNO_PAGAMENTO COD_LOGIN_CREDITO IND_TIPO_CREDITO COD_ALOCACAO_CREDITO COD_DESALOCACAO_CREDITO "
            "COD_TIPO_FATURA"
        ),
        "int": _names(
            "SEQ_FATURA NUM_SUB_SEQ_FATURA NUM_CREDITO_SEQ DW_AREA SEQ_ENTIDADE_ATIVIDADE SEQ_ENTIDADE_PAGAMENTO "
            "SEQ_ARQUIVO_PAGAMENTO COD_METODO_PAGAMENTO SEQ_PAGAMENTO_CREDITO SEQ_FATURA_CREDITO SEQ_ENTIDADE_CREDITO"
        ),
        "stamp": _names(
            "DAT_STATUS_FATURA DAT_CRIACAO_DW DAT_CRIACAO_ATIVIDADE DAT_ATUALIZACAO_ATIVIDADE DAT_BAIXA_ATIVIDADE "
            "DAT_DEPOSITO_ATIVIDADE DAT_CRIACAO_PAGAMENTO DAT_ATUALIZACAO_PAGAMENTO DAT_STATUS_PAGAMENTO "
            "DAT_CRIACAO_CREDITO DAT_ATUALIZACAO_CREDITO DAT_ATIVIDADE_CREDITO DAT_VENCIMENTO_CREDITO"
        ),
        "bigint": _names("CONTRATO"),
        "money": _names(
            "VAL_PAGAMENTO_FATURA VAL_DESCONTO_ITEM VAL_PAGAMENTO_ITEM VAL_JUROS_MULTAS_ITEM VAL_MULTA_EQUIP_ITEM "
            "VAL_MULTA_EQUIP_TOTAL VAL_MULTA_FID_ITEM VAL_BAIXA_ATIVIDADE VAL_ORIGINAL_PAGAMENTO VAL_ATUAL_PAGAMENTO "
            "VAL_PAGAMENTO_CREDITO"
        ),
    },
    key=_names("NUM_CPF DAT_STATUS_FATURA CONTRATO NUM_SUB_SEQ_FATURA"),
    cohort_from="DAT_STATUS_FATURA",
)

LATE_INVOICE = Feed(
    "base_atraso",
    {
        "text": _names(
            "NUM_CPF NUM_FATURA_HASH DW_NUM_CLIENTE DW_TIPO_CLIENTE_CONTA DW_OFERTA DW_TIPO_FATURAMENTO "
            "COD_PLATAFORMA IND_ISENCAO_COB_FAT IND_WO IND_PDD IND_PCCR IND_ACA IND_PRIMEIRA_FAT IND_FRAUDE"
        ),
        "int": _names(
            "NUM_ENT_SEQ_FATURA DW_UN_NEGOCIO DW_AREA DW_CICLO DW_FAIXA_AGING_FATURA DW_FAIXA_AGING_DIVIDA "
            "DW_FAIXA_TEMPO_BASE DW_FAIXA_AGING_PROX_FECH NUM_BILL_SEQ_FAT NUM_SEQ_ACORDO_FAT"
        ),
        "stamp": _names(
            "DAT_REFERENCIA DAT_CRIACAO_REGISTRO_TRANS DAT_ALTERACAO_REGISTRO_TRANS DAT_CANCELAMENTO_FAT "
            "DAT_ORIGINAL_VCTO_FAT DAT_ALTERACAO_VCTO_FAT DAT_CRIACAO_FAT DAT_VENCIMENTO_FAT DAT_STATUS_FAT "
            "DAT_MIN_VENCIMENTO_FAT DAT_ATIVACAO_CONTA_CLI DAT_CRIACAO_DW"
        ),
        "bigint": _names("CONTRATO DW_HIS_PONTO_VENDA_COMTA"),
        "money": _names(
            "VAL_FAT_LIQUIDO VAL_FAT_BRUTO VAL_FAT_CREDITO VAL_FAT_AJUSTE VAL_FAT_BRUTO_BC VAL_FAT_PAGAMENTO_BRUTO "
            "VAL_FAT_ABERTO VAL_FAT_ABERTO_LIQ VAL_MULTA_JUROS VAL_MULTA_CANCELAMENTO VAL_PARC_APARELHO_LIQ "
            "VAL_FAT_LIQ_JM_MC"
        ),
    },
    key=_names("NUM_CPF DAT_REFERENCIA CONTRATO NUM_ENT_SEQ_FATURA"),
    cohort_from="DAT_REFERENCIA",
    sentinels=EXTENDED_SENTINELS,
)

RECHARGE = Feed(
    "base_recarga",
    {
        "text": _names(
            "NUM_CPF DW_NUM_NTC DW_NUM_CLIENTE COD_TECNOLOGIA_DW COD_CANAL_AQUISICAO COD_TIPO_CREDITO COD_PROMOCAO "
            "COD_PLATAFORMA_ATU COD_STATUS_PLATAFORMA IND_METODO_PAGAMENTO DW_PLANO_TARIFACAO DW_TIPO_RECARGA "
            "DW_TIPO_INSERCAO DW_FORMA_PAGAMENTO DW_INSTITUICAO COD_GRUPO_CARTAO DSC_GRUPO_CARTAO_WPP"
        ),
        "int": _names("FLAG_SOS VALOR_SOS"),
        "stamp": _names("DAT_INSERCAO_CREDITO"),
        "clock": _names("HOR_INSERCAO_CREDITO"),
        "money": _names("VAL_CREDITO_INSERIDO VAL_BONUS VAL_REAL"),
    },
    cohort_from="DAT_INSERCAO_CREDITO",
    sentinels=EXTENDED_SENTINELS,
)

REGISTRATION = Feed(
    "base_dados_cadastrais",
    {
        "text": _names("NUM_CPF PROD flag_mig2 STATUSRF var_15 var_18 var_19 var_21 var_22 var_23 var_24 var_25"),
        "int": _names("SAFRA FLAG_INSTALACAO FPD")
        + _numbered(2, 11)
        + _names("var_14 var_16 var_17 var_20 CEP_3_digitos"),
        "day": _names("DATADENASCIMENTO var_12 var_13"),
    },
    key=_names("NUM_CPF SAFRA"),
)

BUREAU = Feed(
    "base_score_bureau_movel",
    {
        "text": _names("NUM_CPF PROD flag_mig2"),
        "int": _names("SAFRA FLAG_INSTALACAO FPD SCORE_01 SCORE_02"),
    },
    key=_names("NUM_CPF SAFRA"),
    strict=True,
)

TELCO = Feed(
    "base_telco",
    {
        "text": _names("NUM_CPF PROD flag_mig2"),
        "int": _names("SAFRA FLAG_INSTALACAO FPD"),
        "double": _numbered(26, 93),
    },
    key=_names("NUM_CPF SAFRA"),
)

FEEDS = {f.name: f for f in (PAYMENT, LATE_INVOICE, RECHARGE, REGISTRATION, BUREAU, TELCO)}
