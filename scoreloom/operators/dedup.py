"""De-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = ("DATPROC",)) -> DataFrame:
    """One row per key: the greatest by ``latest``, ties broken by the greatest remaining columns.

    An aggregate rather than a row-number window: every task first reduces its own rows to one per
    key, so a key holding a large share of all rows costs one row per task in the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest]
    payload = F.struct(*latest, *rest)
    out = df.groupBy(*keys).agg(F.max(payload).alias("_row")).select(*keys, "_row.*")
    return out.select(*df.columns)


def dedup_full_row(df: DataFrame) -> DataFrame:
    return df.distinct()


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows beyond the first of their key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
