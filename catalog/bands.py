"""Banding and scorecard statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import EVENTS, PEOPLE, SCORED, event_scores, people, scored
from catalog.registry import register
from scoreloom.operators import banding, scorecard


def edges_sql(rows: str, column: str, bands: int) -> str:
    """Distinct interpolated quantile edges as a sorted list, written out by rank like the library does."""
    probabilities = ", ".join(repr(i / bands) for i in range(bands + 1))
    return f"(SELECT list_sort(list_distinct(quantile_cont({column}, [{probabilities}]))) FROM {rows})"


def band_sql(column: str, edges: str) -> str:
    return f"CAST(len(list_filter({edges}[2:len({edges})-1], lambda e: e < {column})) AS INTEGER)"


def width_edges_sql(rows: str, column: str, bands: int) -> str:
    return (
        f"(SELECT list_transform(range(0, {bands}), lambda i: lo + (hi - lo) / {bands} * i) || [hi] "
        f"FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM {rows}))"
    )


@register("quantile_bands", f"""
WITH {EVENTS}, e AS (SELECT {edges_sql('ev', 'score', 10)} AS edges)
SELECT event_id, score, {band_sql('score', 'edges')} AS "FAIXA" FROM ev, e""")
def quantile_bands(spark, folder):
    return banding.quantile_bands(event_scores(spark, folder).select("event_id", "score"), "score", 10)


@register("equal_width_bands", f"""
WITH {EVENTS}, e AS (SELECT {width_edges_sql('ev', 'score', 10)} AS edges)
SELECT event_id, {band_sql('score', 'edges')} AS "FAIXA" FROM ev, e""")
def equal_width_bands(spark, folder):
    df = event_scores(spark, folder).select("event_id", "score")
    return banding.equal_width_bands(df, "score", 10).drop("score")


@register("digitize_bins", f"""
WITH {EVENTS} SELECT event_id, CAST(len(list_filter([10.0, 25.5, 50.0, 90.0], lambda b: score >= b)) AS INTEGER) AS "TFT_score"
FROM ev""")
def digitize_bins(spark, folder):
    df = event_scores(spark, folder).select("event_id", "score")
    return banding.apply_tree_bins(df, "score", [25.5, 10, 90, 50])


@register("bin_all_numeric", f"""
WITH {SCORED}, e AS (SELECT {edges_sql('scored', 'score', 10)} AS es, {edges_sql('scored', 'qty', 10)} AS eq,
  {edges_sql('scored', 'disc', 10)} AS ed)
SELECT {band_sql('score', 'es')} AS "BIN_score", {band_sql('qty', 'eq')} AS "BIN_qty",
  {band_sql('disc', 'ed')} AS "BIN_disc", flag, y FROM scored, e""")
def bin_all_numeric(spark, folder):
    df = scored(spark, folder).select("score", "qty", "disc", "flag", "y")
    return banding.band_all_numeric(df, 10, leave=["y"])


# --- scorecard --------------------------------------------------------------------------------------

BINNED = f"""{SCORED}, e AS (SELECT {edges_sql('scored', 'score', 10)} AS es, {edges_sql('scored', 'disc', 10)} AS ed),
long AS (SELECT 'score' AS variable, CAST({band_sql('score', 'es')} AS VARCHAR) AS bin, y FROM scored, e
  UNION ALL SELECT 'disc', CAST({band_sql('disc', 'ed')} AS VARCHAR), y FROM scored, e
  UNION ALL SELECT 'grp', grp, y FROM scored),
counts AS (SELECT variable, bin, count(*) AS n, count(CASE WHEN y = 1 THEN 1 END) AS events,
  count(CASE WHEN y = 0 THEN 1 END) AS nonevents FROM long GROUP BY variable, bin),
totals AS (SELECT *, CAST(sum(n) OVER (PARTITION BY variable) AS BIGINT) AS all_n,
  CAST(sum(events) OVER (PARTITION BY variable) AS BIGINT) AS all_events,
  CAST(sum(nonevents) OVER (PARTITION BY variable) AS BIGINT) AS all_nonevents FROM counts)"""
WOE = f"""{BINNED}, shares AS (SELECT *,
  CASE WHEN events = 0 THEN 0.000001::DOUBLE ELSE events / CAST(all_events AS DOUBLE) END AS g,
  CASE WHEN nonevents = 0 THEN 0.000001::DOUBLE ELSE nonevents / CAST(all_nonevents AS DOUBLE) END AS b FROM totals)"""
COLUMNS = ["score", "disc", "grp"]


@register("woe_iv", f"""
WITH {WOE} SELECT variable, bin, n, events, nonevents, round(ln(g / b), 9) AS woe, round((g - b) * ln(g / b), 9) AS iv
FROM shares""")
def woe_iv(spark, folder):
    t = scorecard.woe_table(scored(spark, folder), COLUMNS, "y")
    return t.withColumns({"woe": F.round("woe", 9), "iv": F.round("iv", 9)})


@register("iv_table", f"""
WITH {WOE}, v AS (SELECT variable, sum((g - b) * ln(g / b)) AS iv FROM shares GROUP BY variable)
SELECT variable, round(iv, 9) AS iv, CASE WHEN iv < 0.02 THEN 'Inútil para a predição' WHEN iv < 0.1 THEN 'Preditor Fraco'
  WHEN iv < 0.3 THEN 'Preditor Moderado' ELSE 'Preditor Forte' END AS label FROM v""")
def iv_table(spark, folder):
    t = scorecard.iv_table(scored(spark, folder), "y", COLUMNS)
    return t.withColumn("iv", F.round("iv", 9)).orderBy(F.desc("iv"))


def r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


BIVARIATE = f"""{BINNED}, s1 AS (SELECT variable, bin AS range, events, nonevents, n AS total,
  {r2('n / CAST(all_n AS DOUBLE) * 100')} AS pct_freq, {r2('events / CAST(all_events AS DOUBLE) * 100')} AS pct_events,
  {r2('nonevents / CAST(all_nonevents AS DOUBLE) * 100')} AS raw_non,
  {r2('events / CAST(n AS DOUBLE) * 100')} AS event_rate FROM totals),
s2 AS (SELECT * EXCLUDE (raw_non), CASE WHEN raw_non = 0 THEN 0.01::DOUBLE ELSE raw_non END AS pct_nonevents FROM s1),
s3 AS (SELECT *, CASE WHEN {r2('pct_events / pct_nonevents')} = 0 THEN 0.01::DOUBLE ELSE {r2('pct_events / pct_nonevents')} END AS odds FROM s2),
s4 AS (SELECT *, {r2('ln(odds)')} AS ln_odds FROM s3),
bivariate AS (SELECT *, CASE WHEN odds = 0.01::DOUBLE THEN 0
  ELSE {r2('(pct_events / 100 - pct_nonevents / 100) * ln_odds')} END AS iv FROM s4)"""


@register("bivariate_table", f"WITH {BIVARIATE} SELECT * FROM bivariate")
def bivariate_table(spark, folder):
    return scorecard.bivariate_table(scored(spark, folder), "y", 10, COLUMNS)


@register("bivariate_iv_list", f"""
WITH {BIVARIATE} SELECT variable, {r2('sum(iv)')} AS iv FROM bivariate GROUP BY variable""")
def bivariate_iv_list(spark, folder):
    return scorecard.iv_list(scorecard.bivariate_table(scored(spark, folder), "y", 10, COLUMNS))


def simple_iv_sql(counts: str) -> str:
    return f"""{counts}, t AS (SELECT *, sum(events) OVER (PARTITION BY variable) AS ae,
  sum(nonevents) OVER (PARTITION BY variable) AS an FROM c),
s AS (SELECT variable, bin, events, nonevents, {r2('events / CAST(ae AS DOUBLE) * 100')} AS pct_events,
  {r2('nonevents / CAST(an AS DOUBLE) * 100')} AS pct_nonevents,
  {r2('events / CAST(events + nonevents AS DOUBLE) * 100')} AS pct_row FROM t)
SELECT *, pct_events / nullif(pct_nonevents, 0) AS woe_ratio,
  round(CASE WHEN pct_events > 0 AND pct_nonevents > 0
    THEN (pct_events / 100 - pct_nonevents / 100) * ln(pct_events / pct_nonevents) ELSE 0 END, 9) AS iv FROM s"""


@register("iv_category", f"""
WITH {PEOPLE}, {simple_iv_sql('''c AS (SELECT 'segment' AS variable, segment AS bin,
  count(CASE WHEN y = 1 THEN 1 END) AS events, count(CASE WHEN y = 0 THEN 1 END) AS nonevents
  FROM people WHERE segment IS NOT NULL GROUP BY segment)''')}""")
def iv_category(spark, folder):
    return scorecard.iv_category(people(spark, folder), "segment", "y").withColumn("iv", F.round("iv", 9))


@register("iv_bin", f"""
WITH {EVENTS}, e AS (SELECT {width_edges_sql('ev', 'score', 8)} AS edges), {simple_iv_sql(f'''c AS (
  SELECT 'score' AS variable, CAST({band_sql('score', 'edges')} AS VARCHAR) AS bin,
  count(CASE WHEN y = 1 THEN 1 END) AS events, count(CASE WHEN y = 0 THEN 1 END) AS nonevents FROM ev, e GROUP BY 2)''')}""")
def iv_bin(spark, folder):
    return scorecard.iv_bin(event_scores(spark, folder), "score", "y", 8).withColumn("iv", F.round("iv", 9))


def log_odds_sql(columns, rate):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {band_sql(c, 'edges')} AS bin, y, {c} AS x FROM scored, "
        f"(SELECT {width_edges_sql('scored', c, 10)} AS edges)"
        for c in columns
    )
    return f"""long AS ({parts}),
p AS (SELECT variable, bin, CAST(sum(y) AS DOUBLE) / count(*) AS r, avg(x) AS x FROM long GROUP BY variable, bin),
q AS (SELECT variable, x, {rate} AS r FROM p)
SELECT variable, round(regr_r2(ln(r / (1 - r)), x), 6) AS r2,
  CASE WHEN regr_r2(ln(r / (1 - r)), x) > 0.85 THEN 'Usar como contínua' ELSE 'Categorizar' END AS advice
FROM q WHERE r > 0 AND r < 1 GROUP BY variable"""


@register("log_odds_r2", f"WITH {SCORED}, {log_odds_sql(['score', 'qty', 'tax'], 'r')}")
def log_odds_r2(spark, folder):
    found = scorecard.log_odds_r2(scored(spark, folder), ["score", "qty", "tax"], "y")
    return found.withColumn("r2", F.round("r2", 6))


@register("log_odds_r2_with_categories", f"""
WITH {PEOPLE}, p AS (SELECT segment, CAST(sum(y) AS DOUBLE) / count(*) AS r,
  row_number() OVER (ORDER BY segment) - 1 AS x FROM people WHERE segment IS NOT NULL GROUP BY segment),
q AS (SELECT x, greatest(least(r, 1 - 0.000001::DOUBLE), 0.000001::DOUBLE) AS r FROM p)
SELECT 'segment' AS variable, round(regr_r2(ln(r / (1 - r)), x), 6) AS r2,
  CASE WHEN regr_r2(ln(r / (1 - r)), x) > 0.85 THEN 'Usar como contínua' ELSE 'Categorizar' END AS advice FROM q""")
def log_odds_r2_with_categories(spark, folder):
    found = scorecard.log_odds_r2(people(spark, folder), ["segment"], "y", clip=1e-6)
    return found.withColumn("r2", F.round("r2", 6))


PSI = f"""{EVENTS}, l AS (SELECT min(score) AS lo, max(score) AS hi FROM ev),
b AS (SELECT part, CAST(len(list_filter(range(1, 10), lambda i: score >= lo + (hi - lo) / 10 * i)) AS INTEGER) AS bin FROM ev, l),
t AS (SELECT bin, count(CASE WHEN part = 'train' THEN 1 END) / CAST((SELECT count(*) FROM ev WHERE part = 'train') AS DOUBLE) AS expected,
  count(CASE WHEN part = 'test' THEN 1 END) / CAST((SELECT count(*) FROM ev WHERE part = 'test') AS DOUBLE) AS actual
  FROM b GROUP BY bin)"""


@register("psi", f"""
WITH {PSI}, f AS (SELECT bin, greatest(expected, 0.0001::DOUBLE) AS e, greatest(actual, 0.0001::DOUBLE) AS a FROM t),
s AS (SELECT sum((a - e) * ln(a / e)) AS psi FROM f)
SELECT round(psi, 9) AS psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate shift' ELSE 'shifted' END AS reading
FROM s""")
def psi(spark, folder):
    found = scorecard.psi(event_scores(spark, folder), "score", "part", "train", "test", epsilon=1e-4)
    return found.withColumn("psi", F.round("psi", 9))


@register("psi_table", f"""
WITH {PSI} SELECT bin, expected, actual, round(CASE WHEN actual = 0 THEN 0 WHEN expected = 0 THEN 'inf'::DOUBLE
  ELSE (actual - expected) * ln(actual / expected) END, 9) AS term FROM t""")
def psi_table(spark, folder):
    found = scorecard.psi_table(event_scores(spark, folder), "score", "part", "train", "test")
    return found.withColumn("term", F.round("term", 9))
