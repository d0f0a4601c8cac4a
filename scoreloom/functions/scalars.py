"""Derived scalar columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.functions.cleaning import EXTENDED_SENTINELS

# Upper end of the 3-digit postal prefix range and its region.
POSTAL_REGIONS = (
    (399, "Sudeste"),
    (659, "Nordeste"),
    (699, "Norte"),
    (799, "Centro-Oeste"),
    (999, "Sul"),
)
# Labels of the policy comparison and the approval threshold in points.
KEPT, SWAP_IN, SWAP_OUT = "mantido", "swap_in", "swap_out"
APPROVAL_POINTS = 300


def days_between(paid: Column, due: Column) -> Column:
    """Calendar days from ``due`` to ``paid``; NULL if either is missing."""
    return F.datediff(F.to_date(paid), F.to_date(due))


def late_flag(status: Column, due: Column) -> Column:
    """1 where the status moment lies after the due moment, else (also for NULL) 0."""
    return F.when(status > due, 1).otherwise(0)


def age_in_cohort(cohort: Column, birth_text: Column) -> Column:
    """Cohort year minus birth year; sentinel or unreadable birth dates give NULL."""
    text = F.trim(birth_text.cast("string"))
    birth = F.try_to_date(F.when(~text.isin(*EXTENDED_SENTINELS), text), "yyyy-MM-dd")
    return F.floor(cohort / 100).cast("int") - F.year(birth)


def postal_region(code: Column) -> Column:
    """Region of a postal code by its first three digits; fewer than three digits give NULL."""
    digits = F.regexp_replace(code.cast("string"), "[^0-9]", "")
    prefix = F.when(F.length(digits) >= 3, F.substring(digits, 1, 3).try_cast("int"))
    region = F.lit(None).cast("string")
    for upper, name in reversed(POSTAL_REGIONS):
        region = F.when(prefix <= upper, name).otherwise(region)
    return region


def score_points(probability: Column) -> Column:
    """Default probability to points, 1000 best."""
    return F.round((1 - probability) * 1000, 0)


def unit_hash(*keys: Column, seed: int = 42) -> Column:
    """A repeatable number in [0, 1) from a row's key, equal on every partitioning."""
    return F.conv(F.substring(hash_text(*keys, seed=seed), 1, 8), 16, 10).cast("double") / 4294967296.0


def hash_text(*keys: Column, seed: int = 42) -> Column:
    """Hex digest of a row's key; sorting by it is a repeatable shuffle."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))


def tie_jitter(score: Column, *keys: Column, width: float = 1e-4, seed: int = 42) -> Column:
    """Add repeatable noise in [0, width) so that equal scores spread over quantile cuts."""
    return score + unit_hash(*keys, seed=seed) * width


def round_to_category(c: Column, digits: int = 4) -> Column:
    """A numeric column as text after rounding, to be used as a category."""
    return F.round(c, digits).cast("string")


def remap(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace categories by the mapping's value; categories without one stay as they are."""
    if not mapping:
        return c
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c), c)


def approved_flag(points: Column, threshold: float = APPROVAL_POINTS) -> Column:
    return F.when(points >= threshold, 1).otherwise(0)


def swap_group(baseline: Column, model: Column) -> Column:
    """Who enters and who leaves when the model replaces the baseline policy."""
    return (
        F.when((baseline == 0) & (model == 1), SWAP_IN)
        .when((baseline == 1) & (model == 0), SWAP_OUT)
        .otherwise(KEPT)
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of a division by zero."""
    return F.when(denominator != 0, numerator / denominator)
