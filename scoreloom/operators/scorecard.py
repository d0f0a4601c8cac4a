"""Scorecard statistics: weight of evidence, information value, log-odds, population stability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.session import written
from scoreloom.operators.banding import band_above, edges_between, equal_width_edges, quantile_edges
from scoreloom.operators.profile import column_limits, equal_width_bin, long_text, numeric_columns, text_columns

# Share used in place of zero, and the limits and labels of information value and stability.
ZERO_SHARE = 1e-6
IV_LABELS = (
    (0.02, "Inútil para a predição"),
    (0.1, "Preditor Fraco"),
    (0.3, "Preditor Moderado"),
)
IV_STRONG = "Preditor Forte"
PSI_LABELS = ((0.1, "stable"), (0.25, "moderate shift"))
PSI_SHIFTED = "shifted"
USE_AS_IS, CATEGORIZE = "Usar como contínua", "Categorizar"


def _label(c: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    out = F.lit(rest)
    for limit, name in reversed(limits):
        out = F.when(c < limit, name).otherwise(out)
    return out


def _round2(c: Column) -> Column:
    """Round to two digits, halves to even, as the tables' chained roundings expect."""
    return F.rint(c * 100) / 100


def bin_counts(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10, kind: str = "quantile") -> DataFrame:
    """Events and non-events per column and bin, NULLs left out: one pass for edges, one for counts.

    Numeric columns are cut, others are their own bins.
    """
    numeric = [c for c in columns if c in numeric_columns(df)]
    edges_of = quantile_edges if kind == "quantile" else equal_width_edges
    rows = df.where(F.col(target).isNotNull())
    edges = edges_of(rows, numeric, bins) if numeric else {}
    banded = rows.select(
        F.col(target).alias("_y"),
        *[band_above(F.col(c), edges.get(c, [])).alias(c) if c in numeric else F.col(c) for c in columns],
    )
    long = long_text(banded, columns, ["_y"]).where(F.col("value").isNotNull())
    return long.groupBy("variable", F.col("value").alias("bin")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("_y") == 1, 1)).alias("events"),
        F.count(F.when(F.col("_y") == 0, 1)).alias("nonevents"),
    )


def with_totals(counts: DataFrame) -> DataFrame:
    """Add each variable's totals by a join, so no variable's bins are gathered in one task."""
    totals = counts.groupBy("variable").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "events", "nonevents")])
    return counts.join(totals, "variable")


def woe_table(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Weight of evidence and information value of every bin."""

    def share(part: str) -> Column:
        s = F.try_divide(F.col(part), F.col(f"all_{part}"))
        return F.when(s == 0, ZERO_SHARE).otherwise(s)

    t = with_totals(bin_counts(df, columns, target, bins))
    good, bad = share("events"), share("nonevents")
    woe = F.ln(good / bad)
    return t.select(
        "variable", "bin", "n", "events", "nonevents", woe.alias("woe"), ((good - bad) * woe).alias("iv")
    )


def iv_table(df: DataFrame, target: str, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Information value and its label per column."""
    columns = [c for c in df.columns if c != target] if columns is None else columns
    out = woe_table(df, columns, target, bins).groupBy("variable").agg(F.sum("iv").alias("iv"))
    return out.withColumn("label", _label(F.col("iv"), IV_LABELS, IV_STRONG))


def bivariate_table(df: DataFrame, target: str, bins: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """Counts, shares, odds and information value per range, every step rounded to two digits.

    Zero shares of non-events and zero odds become 0.01, and such odds carry no information value.
    """
    if columns is None:
        columns = [c for c in numeric_columns(df) + text_columns(df) if c != target]
    t = with_totals(bin_counts(df, columns, target, bins))

    def pct(part: str, whole: str) -> Column:
        return _round2(F.col(part) / F.col(whole) * 100)

    def floored(c: Column) -> Column:
        return F.when(c == 0, 0.01).otherwise(c)

    t = t.select(
        "variable", F.col("bin").alias("range"), "events", "nonevents", F.col("n").alias("total"),
        pct("n", "all_n").alias("pct_freq"),
        pct("events", "all_events").alias("pct_events"),
        floored(pct("nonevents", "all_nonevents")).alias("pct_nonevents"),
        pct("events", "n").alias("event_rate"),
    )
    t = t.withColumn("odds", floored(_round2(F.col("pct_events") / F.col("pct_nonevents"))))
    t = t.withColumn("ln_odds", _round2(F.ln("odds")))
    value = _round2((F.col("pct_events") / 100 - F.col("pct_nonevents") / 100) * F.col("ln_odds"))
    return t.withColumn("iv", F.when(F.col("odds") == 0.01, 0.0).otherwise(value))


def iv_list(bivariate: DataFrame) -> DataFrame:
    """Summed information value per variable of a bivariate table."""
    return bivariate.groupBy("variable").agg(_round2(F.sum("iv")).alias("iv"))


def _simple_iv(counts: DataFrame) -> DataFrame:
    t = with_totals(counts)

    def pct(part: str) -> Column:
        return _round2(F.col(part) / F.col(f"all_{part}") * 100)

    t = t.select(
        "variable", "bin", "events", "nonevents", pct("events").alias("pct_events"),
        pct("nonevents").alias("pct_nonevents"),
        _round2(F.col("events") / (F.col("events") + F.col("nonevents")) * 100).alias("pct_row"),
    )
    ratio = F.try_divide(F.col("pct_events"), F.col("pct_nonevents"))
    information = (F.col("pct_events") / 100 - F.col("pct_nonevents") / 100) * F.ln(ratio)
    return t.select("*", ratio.alias("woe_ratio"), F.when(ratio > 0, information).otherwise(0.0).alias("iv"))


def iv_category(df: DataFrame, column: str, target: str) -> DataFrame:
    """Shares, odds ratio and information value per category."""
    return _simple_iv(bin_counts(df.withColumn(column, F.col(column).cast("string")), [column], target))


def iv_bin(df: DataFrame, column: str, target: str, bins: int = 10) -> DataFrame:
    """The same per equal-width bin of a numeric column."""
    return _simple_iv(bin_counts(df, [column], target, bins, kind="equal"))


def log_odds_r2(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    threshold: float = 0.85,
    clip: float | None = None,
    most_bins: int = 10,
) -> DataFrame:
    """How straight a line the log-odds follow over up to ten equal-width bins of each column.

    Bins without events or without non-events are left out, or with ``clip`` their rate is moved
    that far from 0 and 1. Text columns use their sorted categories as positions 0, 1, 2, ...
    Constant columns do not appear.
    """
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    texts = [c for c in columns if c not in numeric]
    parts = []
    if numeric:
        limits = column_limits(df, numeric)
        distinct = _few_distinct(df, numeric, most_bins)
        bands = {
            c: band_above(F.col(c).cast("double"), edges_between(lo, hi, min(most_bins, distinct.get(c, most_bins))))
            for c, (lo, hi) in limits.items()
            if lo != hi
        }
        pairs = F.array(*[
            F.struct(F.lit(c).alias("variable"), b.cast("string").alias("bin"), F.col(c).cast("double").alias("x"))
            for c, b in bands.items()
        ])
        if bands:
            parts.append(df.select(F.col(target).alias("_y"), F.inline(pairs)))
    if texts:
        rows = long_text(df, texts, [target]).select(
            F.col(target).alias("_y"), "variable", F.col("value").alias("bin"), F.lit(None).cast("double").alias("x")
        )
        parts.append(rows)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    points = rows.where(F.col("bin").isNotNull()).groupBy("variable", "bin").agg(
        F.avg("_y").alias("rate"), F.avg("x").alias("x")
    )
    if texts:
        points = _with_positions(points)
    rate = F.col("rate")
    if clip is not None:
        rate = F.greatest(F.least(rate, F.lit(1 - clip)), F.lit(clip))
    points = points.select("variable", "x", rate.alias("rate")).where((F.col("rate") > 0) & (F.col("rate") < 1))
    out = points.groupBy("variable").agg(
        F.regr_r2(F.ln(F.col("rate") / (1 - F.col("rate"))), F.col("x")).alias("r2"), F.count("*").alias("points")
    )
    advice = F.when(F.col("r2") > threshold, USE_AS_IS).otherwise(CATEGORIZE)
    return out.where("points >= 2").select("variable", "r2", advice.alias("advice"))


def _with_positions(points: DataFrame) -> DataFrame:
    """Fill ``x`` with the place of each category in its variable's order.

    Categories are counted by their first two characters, which sort as the whole text does, and numbered within
    them, so that no variable's categories are all sorted in one task.
    """
    points = written(points.withColumn("_start", F.substring("bin", 1, 2)), "categories")
    before = Window.partitionBy("variable").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = points.groupBy("variable", "_start").agg(F.count("*").alias("_n"))
    offsets = counts.select("variable", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("variable", "_start").orderBy("bin")) - 1
    placed = points.withColumn("_in", inside).join(offsets, ["variable", "_start"])
    return placed.withColumn("x", F.coalesce("x", (F.col("_off") + F.col("_in")).cast("double"))).drop("_start", "_in", "_off")


def _few_distinct(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, int]:
    """Distinct count of columns that have at most ``most`` values; others do not appear."""
    rough = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    near = [c for c in columns if rough[c] <= 2 * most + 10]
    if not near:
        return {}
    values = long_text(df, near).where(F.col("value").isNotNull()).distinct()
    found = {r["variable"]: r["count"] for r in values.groupBy("variable").count().collect()}
    return {c: n for c, n in found.items() if n <= most}


def psi_table(
    df: DataFrame, score: str, part: str, expected: str, actual: str, bins: int = 10, epsilon: float | None = None
) -> DataFrame:
    """Shares and stability term of every equal-width bin over the joint range of both parts.

    A bin without expected rows gives infinity, or with ``epsilon`` both shares are at least that.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(part).isin(expected, actual))
    limits = column_limits(rows, [score])
    lo, hi = limits.get(score, (0.0, 1.0))
    counts = rows.groupBy(
        equal_width_bin(F.col(score).cast("double"), F.lit(lo), F.lit(hi), bins).alias("bin")
    ).agg(*[F.count(F.when(F.col(part) == p, 1)).alias(n) for n, p in (("e", expected), ("a", actual))])
    whole = rows.agg(
        F.count(F.when(F.col(part) == expected, 1)).alias("e"), F.count(F.when(F.col(part) == actual, 1)).alias("a")
    ).select(F.struct("e", "a").alias("w")).scalar()
    t = counts.withColumn("_w", whole).select(
        "bin", (F.col("e") / F.col("_w.e")).alias("expected"), (F.col("a") / F.col("_w.a")).alias("actual")
    )
    if epsilon is not None:
        t = t.select("bin", *[F.greatest(F.col(c), F.lit(epsilon)).alias(c) for c in ("expected", "actual")])
    e, a = F.col("expected"), F.col("actual")
    term = F.when(a == 0, 0.0).when(e == 0, float("inf")).otherwise((a - e) * F.ln(F.try_divide(a, e)))
    return t.select("bin", "expected", "actual", term.alias("term"))


def psi(df: DataFrame, score: str, part: str, expected: str, actual: str, **options) -> DataFrame:
    """Population stability index with its reading."""
    out = psi_table(df, score, part, expected, actual, **options).agg(F.sum("term").alias("psi"))
    return out.withColumn("reading", _label(F.col("psi"), PSI_LABELS, PSI_SHIFTED))
