"""Model quality queries. Scores stand in for model outputs; see catalog.modelling for fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bands import band_sql, edges_sql, width_edges_sql
from catalog.inputs import EVENTS, SCORED, event_scores, scored, table
from catalog.profiles import histogram_sql
from catalog.registry import register
from scoreloom.operators import metrics, profile


def curve_sql(rows: str, groups: str = "") -> str:
    """Per distinct score with running and overall totals, highest score first."""
    by = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    return f"""g AS (SELECT {lead}score, count(*) AS n, sum(y) AS pos FROM {rows} GROUP BY {lead}score),
curve AS (SELECT *, sum(n) OVER ({by} ORDER BY score DESC) AS cum_n, sum(pos) OVER ({by} ORDER BY score DESC) AS cum_pos,
  sum(n) OVER ({by}) AS all_n, sum(pos) OVER ({by}) AS all_pos FROM g)"""


def as_double(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)"


AUC = "sum(CAST(n - pos AS DOUBLE) * (cum_pos - pos / 2.0::DOUBLE)) / (CAST(max(all_pos) AS DOUBLE) * CAST(max(all_n - all_pos) AS DOUBLE))"
KS = f"max(abs({as_double('cum_pos', 'all_pos')} - {as_double('cum_n - cum_pos', 'all_n - all_pos')}))"
AP = f"sum(CAST(pos AS DOUBLE) * {as_double('cum_pos', 'cum_n')}) / CAST(max(all_pos) AS DOUBLE)"


def rounded(df, digits=9, leave=()):
    out = {
        f.name: F.round(f.name, digits)
        for f in df.schema.fields
        if f.dataType.typeName() == "double" and f.name not in leave
    }
    return df.withColumns(out)


@register("cumulative_gain_curve", f"""
WITH {SCORED}, {curve_sql('scored')}
SELECT score, n, CAST(pos AS BIGINT) AS pos, {as_double('cum_pos', 'all_pos')} AS cum_event_share,
  {as_double('cum_n - cum_pos', 'all_n - all_pos')} AS cum_nonevent_share FROM curve""")
def cumulative_gain_curve(spark, folder):
    return metrics.gain_curve(scored(spark, folder), "score", "y")


@register("roc_curve", f"""
WITH {EVENTS}, {curve_sql('ev')} SELECT score AS threshold, {as_double('cum_n - cum_pos', 'all_n - all_pos')} AS fpr,
  {as_double('cum_pos', 'all_pos')} AS tpr FROM curve
UNION ALL SELECT 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_curve(spark, folder):
    return metrics.roc_curve(event_scores(spark, folder), "score", "y")


@register("pr_curve", f"""
WITH {EVENTS}, {curve_sql('ev')} SELECT score AS threshold, {as_double('cum_pos', 'cum_n')} AS precision,
  {as_double('cum_pos', 'all_pos')} AS recall FROM curve
UNION ALL SELECT 'infinity'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE""")
def pr_curve(spark, folder):
    return metrics.pr_curve(event_scores(spark, folder), "score", "y")


@register("auc_gini", f"""
WITH {SCORED}, {curve_sql('scored')} SELECT round({AUC}, 9) AS auc, round(({AUC}) * 2 - 1, 9) AS gini FROM curve""")
def auc_gini(spark, folder):
    return rounded(metrics.auc_gini(scored(spark, folder), "score", "y"))


@register("ks_statistic", f"WITH {EVENTS}, {curve_sql('ev')} SELECT round({KS}, 9) AS ks FROM curve")
def ks_statistic(spark, folder):
    return rounded(metrics.ks_statistic(event_scores(spark, folder), "score", "y"))


@register("ks_gini_by_cohort", f"""
WITH {SCORED}, {curve_sql('scored', 'safra')}
SELECT safra, round({KS} * 100, 7) AS ks, round((({AUC}) * 2 - 1) * 100, 7) AS gini FROM curve
GROUP BY safra""")
def ks_gini_by_cohort(spark, folder):
    return rounded(metrics.ks_gini_by_cohort(scored(spark, folder), "score", "y", "safra"), 7)


def area_sql(order: str) -> str:
    return f"""(SELECT sum((n * (cn - n) + n * (n + 1) / 2) / all_n - (n * (cs - s) + s * (n + 1) / 2) / all_s) FROM (
  SELECT n, s, sum(n) OVER (ORDER BY v DESC) AS cn, sum(s) OVER (ORDER BY v DESC) AS cs,
    sum(n) OVER () AS all_n, sum(s) OVER () AS all_s
  FROM (SELECT {order} AS v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(score AS DECIMAL(12,2))) AS DOUBLE) AS s
        FROM scored GROUP BY 1)))"""


@register("normalized_gini", f"""
WITH {SCORED} SELECT round({area_sql('qty')} / {area_sql('score')}, 7) AS normalized_gini""")
def normalized_gini(spark, folder):
    return rounded(metrics.normalized_gini(scored(spark, folder), "qty", "score"), 7)


# --- at a cut-off -----------------------------------------------------------------------------------

@register("confusion_matrix", f"""
WITH {SCORED} SELECT y AS actual, CASE WHEN score >= 50000 THEN 1 ELSE 0 END AS predicted, count(*) AS n
FROM scored GROUP BY 1, 2""")
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(scored(spark, folder), "y", F.when(F.col("score") >= 50000, 1).otherwise(0))


def rates_sql(rows, cut, groups=""):
    lead = f"{groups}, " if groups else ""
    tail = f"GROUP BY {groups}" if groups else ""
    return f"""cells AS (SELECT {lead}
  CAST(count(CASE WHEN y = 1 AND score >= {cut} THEN 1 END) AS DOUBLE) AS tp,
  CAST(count(CASE WHEN y = 0 AND score >= {cut} THEN 1 END) AS DOUBLE) AS fp,
  CAST(count(CASE WHEN y = 1 AND score < {cut} THEN 1 END) AS DOUBLE) AS fn,
  CAST(count(CASE WHEN y = 0 AND score < {cut} THEN 1 END) AS DOUBLE) AS tn FROM {rows} {tail}),
rates AS (SELECT {lead} round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision,
  round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fn + fp), 9) AS f1,
  round(tp * 2.69::DOUBLE / (tp * 2.69::DOUBLE + fn * 1.69::DOUBLE + fp), 9) AS fbeta FROM cells)"""


@register("classification_metrics", f"""
WITH {EVENTS}, {rates_sql('ev', 40, 'part')}, {curve_sql('ev', 'part')},
ranks AS (SELECT part, round({AUC}, 9) AS auc, round(({AUC}) * 2 - 1, 9) AS gini, round({KS}, 9) AS ks FROM curve GROUP BY part)
SELECT * FROM rates JOIN ranks USING (part)""")
def classification_metrics(spark, folder):
    predicted = F.when(F.col("score") >= 40, 1).otherwise(0)
    return rounded(metrics.classification_metrics(event_scores(spark, folder), "y", predicted, "score", ["part"]))


@register("fbeta", f"WITH {SCORED}, {rates_sql('scored', 50000)} SELECT accuracy, precision, recall, f1, fbeta FROM rates")
def fbeta(spark, folder):
    predicted = F.when(F.col("score") >= 50000, 1).otherwise(0)
    return rounded(metrics.classification_metrics(scored(spark, folder), "y", predicted))


# --- tables -----------------------------------------------------------------------------------------

def decile_sql(part, edges):
    return f"""SELECT part, {band_sql('score', 'edges')} AS band, min(score) AS min_score, max(score) AS max_score,
  CAST(sum(y) AS DOUBLE) / count(*) AS event_rate, count(*) AS volume
  FROM ev, (SELECT {edges} AS edges) WHERE part = '{part}' GROUP BY 1, 2"""


@register("decile_table", f"""
WITH {EVENTS}, tr AS (SELECT * FROM ev WHERE part = 'train'), te AS (SELECT * FROM ev WHERE part = 'test')
{decile_sql('train', edges_sql('tr', 'score', 10))} UNION ALL {decile_sql('test', edges_sql('te', 'score', 10))}""")
def decile_table(spark, folder):
    return metrics.decile_table(event_scores(spark, folder), "score", "y", 10, "quantile", ["part"])


@register("decile_table_equal_width", f"""
WITH {EVENTS}, tr AS (SELECT * FROM ev WHERE part = 'train'), te AS (SELECT * FROM ev WHERE part = 'test')
{decile_sql('train', width_edges_sql('tr', 'score', 10))} UNION ALL {decile_sql('test', width_edges_sql('te', 'score', 10))}""")
def decile_table_equal_width(spark, folder):
    return metrics.decile_table(event_scores(spark, folder), "score", "y", 10, "equal", ["part"])


PROB = f"{SCORED}, pr AS (SELECT y, (score / 200000) AS p, score FROM scored)"


def probabilities(spark, folder):
    return scored(spark, folder).select("y", (F.col("score") / 200000).alias("p"), "score")


@register("calibration_table", f"""
WITH {PROB} SELECT CAST(len(list_filter(range(1, 10), lambda i: p > 0.1::DOUBLE * i)) AS INTEGER) AS bin,
  round(avg(p), 9) AS mean_predicted, CAST(sum(y) AS DOUBLE) / count(*) AS observed_rate, count(*) AS n FROM pr GROUP BY 1""")
def calibration_table(spark, folder):
    found = metrics.calibration_table(probabilities(spark, folder), "p", "y")
    return rounded(found, 9, ["observed_rate"])


@register("probability_losses", f"""
WITH {PROB}, {curve_sql('pr')}, l AS (SELECT avg((p - y) * (p - y)) AS brier,
  avg(-(y * ln(greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
    + (1 - y) * ln(1 - greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16)))) AS log_loss FROM pr)
SELECT round((SELECT {AUC} FROM curve), 9) AS roc_auc, round(brier, 9) AS brier,
  round((SELECT {AP} FROM curve), 9) AS average_precision, round(log_loss, 9) AS log_loss FROM l""")
def probability_losses(spark, folder):
    return rounded(metrics.probability_losses(probabilities(spark, folder), "p", "y"))


@register("regression_metrics", """
WITH r AS (SELECT l_linestatus AS part, l_extendedprice AS y, l_quantity * p_retailprice AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT part, round(1 - avg((y - p) * (y - p)) / var_pop(y), 7) AS r2, round(avg(abs(y - p)), 7) AS mae,
  round(avg((y - p) * (y - p)) / 1e6, 7) AS mse_millions, round(sqrt(avg((y - p) * (y - p))), 7) AS rmse,
  round(avg(abs((y - p) / nullif(y, 0))) * 100, 7) AS mape FROM r GROUP BY part""")
def regression_metrics(spark, folder):
    p = table(spark, folder, "part")
    rows = table(spark, folder, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_linestatus").alias("part"), F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
    )
    found = metrics.regression_metrics(rows, "y", "p", ["part"])
    return rounded(found.withColumn("mse", F.col("mse") / 1e6).withColumnRenamed("mse", "mse_millions"), 7)


@register("score_distribution", f"WITH {EVENTS} {histogram_sql(['score'], 'ev', 50, ['y'])}")
def score_distribution(spark, folder):
    return profile.histogram(event_scores(spark, folder), ["score"], 50, ["y"])
