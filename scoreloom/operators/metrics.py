"""Model quality as aggregates: curves, ranking statistics, tables, losses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.banding import band_above, edges_between
from scoreloom.operators.ordered import quantiles, running_totals

SMALLEST = 2.220446049250313e-16


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _number_of(copies: str | None) -> Column:
    """How many rows a row stands for."""
    return F.lit(1) if copies is None else F.col(copies).cast("long")


def score_totals(df: DataFrame, score: str, target: str, groups: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """Per distinct score, best first: rows and events with running and overall totals. ``copies`` names a column with
    the number of rows that a row stands for."""
    rows = df.where(F.col(target).isNotNull()).select(
        *groups, F.col(score).alias("_score"), _number_of(copies).alias("_rows"),
        F.when(F.col(target) == 1, _number_of(copies)).otherwise(0).alias("_event"),
    )
    return running_totals(rows, "_score", {"_n": F.col("_rows"), "_pos": F.col("_event")}, groups, descending=True)


def gain_curve(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    """Cumulative share of events and non-events by descending score; equal scores are one point."""
    events = _ratio(F.col("cum__pos"), F.col("all__pos"))
    others = _ratio(F.col("cum__n") - F.col("cum__pos"), F.col("all__n") - F.col("all__pos"))
    return score_totals(df, score, target, groups).select(
        *groups, F.col("_score").alias(score), F.col("_n").alias("n"), F.col("_pos").alias("pos"), events.alias("cum_event_share"), others.alias("cum_nonevent_share")
    )


def ranking_metrics(df: DataFrame, score: str, target: str, groups: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """AUC (ties count half), Gini, KS and average precision of the whole table or of each group."""
    t = score_totals(df, score, target, groups, copies)
    pos, neg = F.col("_pos").cast("double"), (F.col("_n") - F.col("_pos")).cast("double")
    all_pos, all_neg = F.col("all__pos"), F.col("all__n") - F.col("all__pos")
    pairs = neg * (F.col("cum__pos") - pos / 2)
    gap = F.abs(_ratio(F.col("cum__pos"), all_pos) - _ratio(F.col("cum__n") - F.col("cum__pos"), all_neg))
    out = t.groupBy(*groups).agg(
        F.sum(pairs).alias("_pairs"),
        F.max(all_pos).alias("_all_pos"),
        F.max(all_neg).alias("_all_neg"),
        F.max(gap).alias("ks"),
        F.sum(pos * _ratio(F.col("cum__pos"), F.col("cum__n"))).alias("_ap"),
    )
    auc = _ratio(F.col("_pairs"), F.col("_all_pos").cast("double") * F.col("_all_neg"))
    return out.select(
        *groups,
        auc.alias("auc"),
        (auc * 2 - 1).alias("gini"),
        "ks",
        _ratio(F.col("_ap"), F.col("_all_pos")).alias("average_precision"),
    )


def ks_statistic(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, score, target, groups).select(*groups, "ks")


def auc_gini(df: DataFrame, score: str, target: str, groups: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, score, target, groups).select(*groups, "auc", "gini")


def ks_gini_by_cohort(df: DataFrame, score: str, target: str, cohort: str) -> DataFrame:
    """KS and Gini in percent per cohort."""
    found = ranking_metrics(df, score, target, [cohort])
    return found.select(cohort, (F.col("ks") * 100).alias("ks"), (F.col("gini") * 100).alias("gini"))


def roc_curve(df: DataFrame, score: str, target: str) -> DataFrame:
    """False and true positive rate at every distinct threshold (predict 1 from the threshold up).

    The curve begins at (0, 0), where the threshold is infinite.
    """
    t = score_totals(df, score, target)
    others = _ratio(F.col("cum__n") - F.col("cum__pos"), F.col("all__n") - F.col("all__pos"))
    curve = t.select(
        F.col("_score").alias("threshold"), others.alias("fpr"),
        _ratio(F.col("cum__pos"), F.col("all__pos")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in (("threshold", float("inf")), ("fpr", 0.0), ("tpr", 0.0))])
    return curve.unionByName(start)


def pr_curve(df: DataFrame, score: str, target: str) -> DataFrame:
    """Precision and recall at every distinct threshold; the curve ends at recall 0, precision 1."""
    curve = score_totals(df, score, target).select(
        F.col("_score").alias("threshold"),
        _ratio(F.col("cum__pos"), F.col("cum__n")).alias("precision"),
        _ratio(F.col("cum__pos"), F.col("all__pos")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in (("threshold", float("inf")), ("precision", 1.0), ("recall", 0.0))])
    return curve.unionByName(end)


def normalized_gini(df: DataFrame, score: str, target: str) -> DataFrame:
    """Gini of the Lorenz curve by score, over that of the perfect order.

    Rows with equal scores count as their average order, so the result does not depend on how ties
    happen to be sorted.
    """

    def area(order: str) -> DataFrame:
        t = running_totals(rows, order, {"_n": F.lit(1), "_sum": F.col("_y")}, descending=True)
        n, s = F.col("_n").cast("double"), F.col("_sum").cast("double")
        rows_before, sum_before = F.col("cum__n") - n, F.col("cum__sum") - s
        even = (n * rows_before + n * (n + 1) / 2) / F.col("all__n")
        lorenz = _ratio(n * sum_before + s * (n + 1) / 2, F.col("all__sum"))
        return t.agg(F.sum(even - lorenz).alias("area"))

    y = F.col(target).cast("double")
    rows = df.select(y.alias("_y"), y.alias("_order"), F.col(score).alias("_score")).dropna()
    by_score = area("_score").scalar()
    return area("_order").select(F.try_divide(by_score, F.col("area")).alias("normalized_gini"))


# --- at a cut-off ---------------------------------------------------------------------------------

def confusion_matrix(df: DataFrame, target: str, predicted: Column) -> DataFrame:
    return df.groupBy(F.col(target).alias("actual"), predicted.alias("predicted")).agg(F.count("*").alias("n"))


def _cells(target: str, predicted: Column, copies: str | None = None) -> dict[str, Column]:
    y, p = F.col(target), predicted
    pairs = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    if copies is None:
        return {k: F.count(F.when((y == a) & (p == b), 1)) for k, (a, b) in pairs.items()}
    return {k: F.coalesce(F.sum(F.when((y == a) & (p == b), _number_of(copies))), F.lit(0)) for k, (a, b) in pairs.items()}


def fbeta_of(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b = beta * beta
    return F.coalesce(_ratio(tp * (1 + b), tp * (1 + b) + fn * b + fp), F.lit(0.0))


def classification_metrics(
    df: DataFrame, target: str, predicted: Column, score: str | None = None, groups: Sequence[str] = (), beta: float = 1.3,
    copies: str | None = None,
) -> DataFrame:
    """Accuracy, precision, recall, F1, F-beta, and with a score AUC, Gini and KS."""
    counts = df.groupBy(*groups).agg(*[c.alias(k) for k, c in _cells(target, predicted, copies).items()])
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    out = counts.select(
        *groups,
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        F.coalesce(_ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(_ratio(tp, tp + fn), F.lit(0.0)).alias("recall"),
        fbeta_of(tp, fp, fn, 1.0).alias("f1"),
        fbeta_of(tp, fp, fn, beta).alias("fbeta"),
    )
    if score is None:
        return out
    ranking = ranking_metrics(df, score, target, groups, copies).drop("average_precision")
    if groups:
        return out.join(ranking, list(groups))
    one = ranking.select(F.struct("auc", "gini", "ks").alias("r")).scalar()
    return out.withColumn("_r", one).select(*out.columns, "_r.auc", "_r.gini", "_r.ks")


# --- tables ---------------------------------------------------------------------------------------

def _edges_by_group(
    df: DataFrame, score: str, bands: int, kind: str, groups: Sequence[str]
) -> list[tuple[dict, list[float]]]:
    """Band edges of every group, found in one pass."""
    if kind == "quantile":
        found = quantiles(df, score, [i / bands for i in range(bands + 1)], groups).collect()
        return [({g: r[g] for g in groups}, sorted(set(r["quantiles"]))) for r in found]
    x = F.col(score).cast("double")
    found = df.groupBy(*groups).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")).collect()
    return [({g: r[g] for g in groups}, edges_between(r["_lo"], r["_hi"], bands)) for r in found]


def decile_table(
    df: DataFrame, score: str, target: str, bands: int = 10, kind: str = "quantile", groups: Sequence[str] = ()
) -> DataFrame:
    """Lowest and highest score, event rate and volume per score band ("quantile" or "equal" width).

    ``groups`` are a few sets such as train and test, each cut by its own edges.
    """
    x = F.col(score)
    rows = df.where(x.isNotNull())
    band = F.lit(None).cast("int")
    for values, edges in _edges_by_group(rows, score, bands, kind, groups):
        same = F.lit(True)
        for g, v in values.items():
            same = same & F.col(g).eqNullSafe(F.lit(v))
        band = F.when(same, band_above(x, edges)).otherwise(band)
    return rows.groupBy(*groups, band.alias("band")).agg(
        F.min(x).alias("min_score"), F.max(x).alias("max_score"), F.avg(target).alias("event_rate"),
        F.count("*").alias("volume"),
    )


def calibration_table(df: DataFrame, probability: str, target: str, bins: int = 10) -> DataFrame:
    """Mean prediction against observed rate in equal bins of [0, 1]; empty bins do not appear."""
    p = F.col(probability)
    return df.groupBy(band_above(p, edges_between(0.0, 1.0, bins)).alias("bin")).agg(
        F.avg(p).alias("mean_predicted"), F.avg(target).alias("observed_rate"), F.count("*").alias("n")
    )


def probability_losses(df: DataFrame, probability: str, target: str) -> DataFrame:
    """ROC AUC, Brier score, average precision and log-loss."""
    p, y = F.col(probability).cast("double"), F.col(target).cast("double")
    clipped = F.greatest(F.least(p, F.lit(1 - SMALLEST)), F.lit(SMALLEST))
    losses = df.agg(
        F.avg((p - y) * (p - y)).alias("brier"),
        F.avg(-(y * F.ln(clipped) + (1 - y) * F.ln(1 - clipped))).alias("log_loss"),
    )
    one = ranking_metrics(df, probability, target).select(F.struct("auc", "average_precision").alias("r")).scalar()
    return losses.withColumn("_r", one).select(
        F.col("_r.auc").alias("roc_auc"), "brier", F.col("_r.average_precision"), "log_loss"
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, groups: Sequence[str] = ()) -> DataFrame:
    """R2, MAE, MSE, RMSE and MAPE in percent, in one pass."""
    y, error = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted)
    out = df.groupBy(*groups).agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(F.try_divide(error, y))) * 100).alias("mape"),
        F.var_pop(y).alias("_v"),
    )
    return out.select(
        *groups, (1 - F.try_divide(F.col("mse"), F.col("_v"))).alias("r2"), "mae", "mse",
        F.sqrt("mse").alias("rmse"), "mape",
    )
