"""Profiling: counts, nulls, frequencies, distributions, event rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.operators.ordered import (
    column_quantiles,
    null_safe_join,
    long_numeric,
    quantiles_of,
    value_sums,
)
from scoreloom.session import written


def numeric_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in leave_out]


def text_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in leave_out]


def percent_of(n: str, total: Column, digits: int | None = 2) -> Column:
    share = F.col(n) * 100 / total
    return share if digits is None else F.round(share, digits)


def row_total(df: DataFrame) -> Column:
    """The table's row count as a scalar subquery; no window over all groups is needed for shares."""
    return df.agg(F.count("*").alias("n")).scalar()


def long_text(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``variable``, ``value`` as text, plus the kept columns."""
    wide = df.select(*keep, *[F.col(c).cast("string").alias(f"_v_{c}") for c in columns])
    return wide.unpivot(list(keep), [f"_v_{c}" for c in columns], "variable", "value").withColumn(
        "variable", F.substring("variable", 4, 10_000)
    )


# --- shape ----------------------------------------------------------------------------------------

def preview_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def _per_column(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one row of ``<field>__<column>`` values into one row per column."""
    items = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{f}__{c}").alias(f) for f in fields]) for c in columns
    ]
    return row.select(F.inline(F.array(*items)))


def schema_report(df: DataFrame) -> DataFrame:
    """Column, type, number of filled values."""
    row = df.agg(
        *[F.lit(f.dataType.simpleString()).alias(f"type__{f.name}") for f in df.schema.fields],
        *[F.count(c).alias(f"filled__{c}") for c in df.columns],
    )
    return _per_column(row, df.columns, ["type", "filled"])


def null_report(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """NULL count and percent (2 digits) of every column, in one pass."""
    row = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in df.columns])
    items = [F.struct(F.lit(c).alias("feature"), (F.col("_n") - F.col(c)).alias("nulls")) for c in df.columns]
    out = row.select("_n", F.inline(F.array(*items))).select(
        "feature", "nulls", F.round(F.col("nulls") * 100 / F.col("_n"), 2).alias("pct_nulls")
    )
    return out.where("nulls > 0") if only_with_nulls else out


def metadata_profile(
    df: DataFrame, ids: Sequence[str] = (), targets: Sequence[str] = (), exact: bool = True
) -> DataFrame:
    """Role, NULL count and percent, distinct count and type of every column.

    The distinct count shuffles one row per column and value; ``exact=False`` replaces it by a
    sketch that needs a single pass.
    """
    names, types = df.columns, {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if exact:
        values = long_text(df, names).groupBy("variable", "value").agg(F.count("*").alias("n"))
        found = values.groupBy(F.col("variable").alias("feature")).agg(
            F.sum("n").alias("_n"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("cardinality"),
        )
    else:
        row = df.agg(
            F.count("*").alias("_n"),
            *[F.count(c).alias(f"filled__{c}") for c in names],
            *[F.approx_count_distinct(c).alias(f"cardinality__{c}") for c in names],
        )
        items = [
            F.struct(
                F.lit(c).alias("feature"),
                (F.col("_n") - F.col(f"filled__{c}")).alias("nulls"),
                F.col(f"cardinality__{c}").alias("cardinality"),
            )
            for c in names
        ]
        found = row.select("_n", F.inline(F.array(*items)))
    role, kind = F.lit("Explicativa"), F.lit(None).cast("string")
    role = F.when(F.col("feature").isin(*targets), "Target").otherwise(role) if targets else role
    role = F.when(F.col("feature").isin(*ids), "ID").otherwise(role) if ids else role
    for name in names:
        kind = F.when(F.col("feature") == name, types[name]).otherwise(kind)
    return found.select(
        "feature", role.alias("role"), "nulls",
        F.round(F.col("nulls") * 100 / F.col("_n"), 2).alias("pct_nulls"), "cardinality", kind.alias("type"),
    )


def select_by_null_cutoff(profile: DataFrame, cutoff: float, inclusive: bool = False) -> DataFrame:
    """Features whose NULL percent lies above the cutoff."""
    c = F.col("pct_nulls")
    return profile.where(c >= cutoff if inclusive else c > cutoff).select("feature", "pct_nulls")


def null_shares(df: DataFrame) -> dict[str, float]:
    row = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in df.columns]).first()
    return {c: 1 - row[c] / row["_n"] if row["_n"] else 0.0 for c in df.columns}


def drop_high_null_columns(df: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, list[str]]:
    """Drop columns with a larger share of NULLs; returns the dropped names for use on other tables."""
    dropped = [c for c, share in null_shares(df).items() if share > threshold]
    return df.drop(*dropped), dropped


# --- counts ---------------------------------------------------------------------------------------

def count_by(df: DataFrame, cohort: str) -> DataFrame:
    return df.groupBy(cohort).agg(F.count("*").alias("n"))


def count_and_distinct_by(df: DataFrame, cohort: str, key: str, exact: bool = True) -> DataFrame:
    """Rows and distinct keys per cohort. Rows are first reduced to one per cohort and key."""
    if not exact:
        return df.groupBy(cohort).agg(F.count("*").alias("n"), F.approx_count_distinct(key).alias("n_keys"))
    per_key = df.groupBy(cohort, key).agg(F.count("*").alias("n"))
    return per_key.groupBy(cohort).agg(F.sum("n").alias("n"), F.count(key).alias("n_keys"))


def cohort_summary(df: DataFrame, cohort: str, key: str, target: str) -> DataFrame:
    """Rows, distinct keys and target percent (2 digits) per cohort."""
    per_key = df.groupBy(cohort, key).agg(
        F.count("*").alias("n"), F.sum(target).alias("_t"), F.count(target).alias("_tn")
    )
    out = per_key.groupBy(cohort).agg(
        F.sum("n").alias("n"), F.count(key).alias("n_keys"), F.sum("_t").alias("_t"), F.sum("_tn").alias("_tn")
    )
    return out.select(cohort, "n", "n_keys", F.round(F.col("_t") * 100 / F.nullif("_tn", F.lit(0)), 2).alias("pct_target"))


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Value, count, percent of all rows (2 digits)."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.select(column, "n", percent_of("n", row_total(df)).alias("pct"))


def counts_with_total(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and percent of each combination without NULLs, and a closing ``Total`` row."""
    whole = df.dropna(subset=list(columns))
    counts = whole.groupBy(*columns).agg(F.count("*").alias("n"))
    counts = counts.withColumn(columns[0], F.col(columns[0]).cast("string"))
    counts = counts.withColumn("pct", percent_of("n", row_total(whole), None))
    total = whole.agg(F.count("*").alias("n")).select(
        F.lit("Total").alias(columns[0]), "n", F.lit(100.0).alias("pct")
    )
    return counts.unionByName(total, allowMissingColumns=True)


def category_columns(df: DataFrame, cutoff: int, max_numeric: int | None = None, leave_out: Sequence[str] = ()) -> list[str]:
    """Text columns with at most ``cutoff`` distinct values; numeric ones too if ``max_numeric`` is given.

    A sketch of all columns (one pass) rules out those far above; the rest are counted exactly.
    """
    limits = {c: cutoff for c in text_columns(df, leave_out)}
    if max_numeric is not None:
        limits |= {c: max_numeric for c in numeric_columns(df, leave_out)}
    if not limits:
        return []
    rough = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in limits]).first()
    near = [c for c, limit in limits.items() if rough[c] <= 2 * limit + 10]
    if not near:
        return []
    values = long_text(df, near).where(F.col("value").isNotNull()).distinct()
    exact = {r["variable"]: r["count"] for r in values.groupBy("variable").count().collect()}
    return [c for c in near if exact.get(c, 0) <= limits[c]]


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns in long form."""
    return long_text(df, columns).groupBy("variable", "value").agg(F.count("*").alias("n"))


def pivot_counts(df: DataFrame, index: str, target: str, values: Sequence = (0, 1), prefix: str = "target_") -> DataFrame:
    """Counts per index value, one column per target value, 0 where there are none."""
    out = [F.count(F.when(F.col(target) == v, 1)).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(index).agg(*out)


def crosstab_share(df: DataFrame, category: str, target: str, values: Sequence = (0, 1), prefix: str = "share_") -> DataFrame:
    """Share of each target value within the category."""
    counts = pivot_counts(df.where(F.col(category).isNotNull() & F.col(target).isNotNull()), category, target, values, "_n_")
    total = sum((F.col(f"_n_{v}") for v in values[1:]), F.col(f"_n_{values[0]}"))
    return counts.select(category, *[(F.col(f"_n_{v}") / total).alias(f"{prefix}{v}") for v in values])


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and percent of each target value."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    return counts.select(target, "n", percent_of("n", row_total(df), None).alias("pct"))


# --- event rates ----------------------------------------------------------------------------------

def _rate(target: str) -> Column:
    return F.avg(target).alias("event_rate")


def event_rate_by(df: DataFrame, target: str, *by: str) -> DataFrame:
    """Mean target and volume per group."""
    return df.groupBy(*by).agg(_rate(target), F.count("*").alias("volume"))


def event_rate_by_cohort_and_variable(df: DataFrame, target: str, cohort: str, variable: str) -> DataFrame:
    """Mean target and volume per cohort and category, with the cohort's whole volume."""
    rates = event_rate_by(df.where(F.col(variable).isNotNull()), target, cohort, variable)
    volumes = rates.groupBy(cohort).agg(F.sum("volume").alias("cohort_volume"))
    return rates.join(volumes, cohort)


def category_event_rates(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Mean target per value of each column, NULLs left out."""
    rows = long_text(df, columns, [target]).where(F.col("value").isNotNull() & F.col(target).isNotNull())
    return event_rate_by(rows, target, "variable", "value")


def group_event_rate_with_nulls(df: DataFrame, target: str, group: str) -> DataFrame:
    """NULL is a group of its own; ``volume`` counts the group column, so it is 0 there."""
    return df.groupBy(group).agg(F.count(group).alias("volume"), F.avg(target).alias("target_mean"))


# --- numeric distributions ------------------------------------------------------------------------

def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum of each column."""
    cuts = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    plain = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{k}__{c}") for c in columns for k, f in plain.items()])

    def line(c: str) -> Column:
        quartiles = cuts.get(c, [None] * 3)
        values = {k: F.col(f"{k}__{c}") for k in ("mean", "std", "min")}
        values |= {q: F.lit(v).cast("double") for q, v in zip(("q25", "q50", "q75"), quartiles)}
        values["max"] = F.col(f"max__{c}")
        return F.struct(
            F.lit(c).alias("variable"), F.col(f"n__{c}").alias("n"),
            *[F.round(v, digits).alias(k) for k, v in values.items()],
        )

    return row.select(F.inline(F.array(*[line(c) for c in columns])))


def equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Left-closed equal-width bin 0..bins-1, the last bin closed on both sides.

    Edges are ``low + i * step`` and compared with the value itself, so a value on an edge is never
    moved by the rounding of a division.
    """
    step = (high - low) / bins
    passed = [F.when(x >= low + step * i, 1).otherwise(0) for i in range(1, bins)]
    total = passed[0] if passed else F.lit(0)
    for p in passed[1:]:
        total = total + p
    return F.when(x.isNotNull(), total)


def column_limits(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum of each column; two numbers per column reach the driver."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo__{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"hi__{c}") for c in columns],
    ).first()
    return {c: (row[f"lo__{c}"], row[f"hi__{c}"]) for c in columns if row[f"lo__{c}"] is not None}


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram of each column over its whole range, optionally split by other columns."""
    limits = column_limits(df, columns)
    binned = df.select(
        *by,
        *[
            equal_width_bin(F.col(c).cast("double"), F.lit(lo), F.lit(hi), bins).alias(f"_b_{c}")
            for c, (lo, hi) in limits.items()
        ],
    ).unpivot(list(by), [f"_b_{c}" for c in limits], "variable", "bin")
    counts = binned.where(F.col("bin").isNotNull()).groupBy("variable", *by, "bin").agg(F.count("*").alias("n"))
    lower = F.lit(None).cast("double")
    for c, (lo, hi) in limits.items():
        lower = F.when(F.col("variable") == f"_b_{c}", F.lit(lo) + F.col("bin") * ((hi - lo) / bins)).otherwise(lower)
    return counts.select(F.substring("variable", 4, 10_000).alias("variable"), *by, "bin", lower.alias("lower"), "n")


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and number of outliers."""
    groups = ["variable", *by]
    values = value_sums(long_numeric(df, columns, by), "value", {"_n": F.lit(1)}, groups)
    cuts = written(
        quantiles_of(values, "value", [0.25, 0.5, 0.75], groups).select(
            *groups, *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))]
        ),
        "quartiles",
    )
    x, spread = F.col("value"), (F.col("q3") - F.col("q1")) * 1.5
    inside = (x >= F.col("q1") - spread) & (x <= F.col("q3") + spread)
    return null_safe_join(values, cuts, groups).groupBy(*groups, "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("low_whisker"),
        F.max(F.when(inside, x)).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
        F.sum("_n").alias("n"),
    )
