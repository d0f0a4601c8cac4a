"""Cutting numeric columns into bands.

Band edges are a few numbers per column, found by one pass over the table and then compared as
literals, so applying them is a plain projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.ordered import column_quantiles
from scoreloom.operators.profile import column_limits, numeric_columns


def count_true(conditions: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in conditions:
        total = total + F.when(c, 1).otherwise(0)
    return total


def band_above(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed bands: the number of inner edges below the value. ``edges`` include both ends."""
    return F.when(x.isNotNull(), count_true([x > F.lit(e) for e in list(edges)[1:-1]]))


def digitize(x: Column, bounds: Sequence[float]) -> Column:
    """Left-closed bins: the number of ascending bounds not above the value."""
    return F.when(x.isNotNull(), count_true([x >= F.lit(float(b)) for b in sorted(bounds)]))


def quantile_edges(df: DataFrame, columns: Sequence[str], bands: int = 10) -> dict[str, list[float]]:
    """Interpolated quantile edges per column; equal edges are merged."""
    found = column_quantiles(df, columns, [i / bands for i in range(bands + 1)])
    return {c: sorted(set(edges)) for c, edges in found.items()}


def equal_width_edges(df: DataFrame, columns: Sequence[str], bands: int = 10) -> dict[str, list[float]]:
    """Equal-width edges over each column's range; a constant column gets a range of 0.1 % around it."""
    return {c: edges_between(lo, hi, bands) for c, (lo, hi) in column_limits(df, columns).items()}


def edges_between(low: float, high: float, bands: int) -> list[float]:
    if low == high:
        margin = 0.001 * abs(low) if low else 0.001
        low, high = low - margin, high + margin
    step = (high - low) / bands
    return [low + step * i for i in range(bands)] + [high]


def quantile_bands(df: DataFrame, column: str, bands: int = 10, name: str = "FAIXA") -> DataFrame:
    """Add a quantile band 0..bands-1; equal values share a band, and a constant column is band 0."""
    edges = quantile_edges(df, [column], bands).get(column, [])
    return df.withColumn(name, band_above(F.col(column), edges))


def equal_width_bands(df: DataFrame, column: str, bands: int = 10, name: str = "FAIXA") -> DataFrame:
    edges = equal_width_edges(df, [column], bands).get(column, [])
    return df.withColumn(name, band_above(F.col(column), edges))


def band_all_numeric(
    df: DataFrame, bands: int = 10, prefix: str = "BIN_", leave: Sequence[str] = ()
) -> DataFrame:
    """Replace every numeric column but those to ``leave`` by its quantile band."""
    columns = numeric_columns(df, leave)
    edges = quantile_edges(df, columns, bands)
    return df.select(*[
        band_above(F.col(c), edges.get(c, [])).alias(f"{prefix}{c}") if c in columns else F.col(c) for c in df.columns
    ])


def apply_tree_bins(df: DataFrame, column: str, upper_bounds: Sequence[float]) -> DataFrame:
    """Replace ``column`` by its bin ``TFT_<column>`` among ascending upper bounds."""
    return df.withColumn(f"TFT_{column}", digitize(F.col(column), upper_bounds)).drop(column)
