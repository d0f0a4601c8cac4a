"""Comparing the approval policy of a model with the current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.scalars import APPROVAL_POINTS, KEPT, SWAP_IN, SWAP_OUT, approved_flag, swap_group

# Order of the groups in reports.
GROUP_ORDER = (KEPT, SWAP_IN, SWAP_OUT)


def install_rates(control: DataFrame, installed: str = "FLAG_INSTALACAO") -> DataFrame:
    """Share of installed and not installed rows in a control group."""
    total = control.agg(F.count("*").alias("n")).scalar()
    counts = control.groupBy(installed).agg(F.count("*").alias("n"))
    return counts.select(installed, "n", (F.col("n") / total).alias("rate"))


def with_swap(df: DataFrame, points: str, threshold: float = APPROVAL_POINTS, installed: str = "FLAG_INSTALACAO") -> DataFrame:
    """Add the model's approval and the swap group."""
    approved = approved_flag(F.col(points), threshold)
    return df.select("*", approved.alias("aprovado_modelo")).withColumn(
        "grupo_swap", swap_group(F.col(installed), F.col("aprovado_modelo"))
    )


def estimated_approvals(swapped: DataFrame, control: DataFrame, installed: str = "FLAG_INSTALACAO") -> DataFrame:
    """Approvals behind the installed sales (installed / install rate) against the model's approvals."""
    rate = control.agg(F.avg(F.when(F.col(installed) == 1, 1).otherwise(0)).alias("r")).scalar()
    out = swapped.agg(
        F.sum(installed).alias("installed"), F.sum("aprovado_modelo").alias("model_approvals")
    )
    return out.withColumn("_r", rate).select(
        "installed", F.try_divide(F.col("installed"), F.col("_r")).alias("baseline_approvals"), "model_approvals"
    )


def policy_default_rates(swapped: DataFrame, target: str = "FPD", installed: str = "FLAG_INSTALACAO") -> DataFrame:
    """Installed rows and their default rate under either policy."""
    seen = F.col(installed) == 1
    policies = {"baseline": seen, "modelo": seen & (F.col("aprovado_modelo") == 1)}
    row = swapped.agg(
        *[F.count(F.when(c, 1)).alias(f"n_{k}") for k, c in policies.items()],
        *[F.avg(F.when(c, F.col(target))).alias(f"r_{k}") for k, c in policies.items()],
    )
    items = [
        F.struct(F.lit(k).alias("policy"), F.col(f"n_{k}").alias("n"), F.col(f"r_{k}").alias("default_rate"))
        for k in policies
    ]
    return row.select(F.inline(F.array(*items)))


def in_group_order(df: DataFrame, column: str = "grupo_swap", order: tuple[str, ...] = GROUP_ORDER) -> DataFrame:
    """Sort by a fixed order of categories; others come last."""
    place = F.lit(len(order))
    for i, name in enumerate(order):
        place = F.when(F.col(column) == name, i).otherwise(place)
    return df.orderBy(place, column)


def swap_volume(swapped: DataFrame) -> DataFrame:
    return swapped.groupBy("grupo_swap").agg(F.count("*").alias("volume"))


def swap_table(
    swapped: DataFrame, key: str = "NUM_CPF", target: str = "FPD", installed: str = "FLAG_INSTALACAO"
) -> DataFrame:
    """Volume and observed default (installed rows only) per swap group, in report order."""
    out = swapped.groupBy("grupo_swap").agg(
        F.count(key).alias("volume"), F.avg(F.when(F.col(installed) == 1, F.col(target))).alias("fpd_real")
    )
    return in_group_order(out)


def risk_by_group(swapped: DataFrame, probability: str) -> DataFrame:
    return swapped.groupBy("grupo_swap").agg(F.avg(probability).alias("risk"))


def band_summary(df: DataFrame, band: str, means: list[str], *by: str) -> DataFrame:
    """Mean of several columns and volume per score band."""
    return df.groupBy(*by, band).agg(*[F.avg(c).alias(c) for c in means], F.count(band).alias("volume"))


def top_features(importances: DataFrame, by: str, k: int | None = None, above: Column | None = None) -> DataFrame:
    """Highest first: the first ``k``, or those above a cut-off."""
    out = importances if above is None else importances.where(F.col(by) > above)
    out = out.orderBy(F.desc(by), *[c for c in importances.columns if c != by])
    return out if k is None else out.limit(k)
