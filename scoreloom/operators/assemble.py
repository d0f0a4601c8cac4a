"""Joining tables into wide ones, column lists, populations and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("NUM_CPF", "SAFRA")


def columns_not_in(df: DataFrame, other: DataFrame) -> list[str]:
    """Columns of ``df`` absent from ``other``, in order; names compare without case, as Spark resolves them."""
    taken = {c.lower() for c in other.columns}
    return [c for c in df.columns if c.lower() not in taken]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names the table does not have are ignored."""
    return df.drop(*names)


def rename_features(df: DataFrame, target: str) -> tuple[DataFrame, dict[str, str]]:
    """Rename all columns but the target to VAR_1, VAR_2, ...; also returns old name -> new name."""
    features = [c for c in df.columns if c != target]
    mapping = {c: f"VAR_{i}" for i, c in enumerate(features, 1)}
    return df.withColumnsRenamed(mapping), mapping


def split_features_target(df: DataFrame, ids: Sequence[str], target: str) -> DataFrame:
    """Features in order, then the target; identifier columns are left out."""
    return df.select(*[c for c in df.columns if c not in ids and c != target], target)


def star_join(base: DataFrame, others: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Left-join tables onto ``base`` by the same keys; a column already present is not repeated.

    All joins use the same keys, so the growing left side is shuffled once and stays partitioned.
    The other tables must hold a key at most once (see ``dedup_latest``).
    """
    out = base
    for other in others:
        out = out.join(other.select(*keys, *columns_not_in(other, out)), list(keys), "left")
    return out


def cohort_range(df: DataFrame, first: int, last: int, cohort: str = "SAFRA") -> DataFrame:
    return df.where(F.col(cohort).between(first, last))


def population(df: DataFrame, installed: str = "FLAG_INSTALACAO", plan: str = "flag_mig2") -> DataFrame:
    """Installed sales of customers coming from prepaid."""
    return df.where((F.col(installed) == 1) & (F.col(plan) == "PRE"))


def control_group(
    df: DataFrame, key: str = "NUM_CPF", start: int = 6, length: int = 2, codes: Sequence[str] = ("ZZ", "ZX")
) -> DataFrame:
    """Rows whose key holds one of the control codes at a fixed place."""
    return df.where(F.substring(F.col(key), start, length).isin(*codes))


def out_of_time(
    df: DataFrame, train: tuple[int, int], test: tuple[int, int], cohort: str = "SAFRA"
) -> tuple[DataFrame, DataFrame]:
    """Development and validation rows by cohort range."""
    return cohort_range(df, *train, cohort), cohort_range(df, *test, cohort)


def label_out_of_time(
    df: DataFrame, train: tuple[int, int], test: tuple[int, int], cohort: str = "SAFRA", name: str = "part"
) -> DataFrame:
    """The same split as a column, to treat both parts in one pass."""
    c = F.col(cohort)
    part = F.when(c.between(*train), "train").when(c.between(*test), "test")
    return df.where(c.between(*train) | c.between(*test)).withColumn(name, part)


def union_populations(tables: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Stack tables in one column order; a column a table lacks is NULL there."""
    out = tables[0]
    for nxt in tables[1:]:
        out = out.unionByName(nxt, allowMissingColumns=True)
    return out.select(*columns)
