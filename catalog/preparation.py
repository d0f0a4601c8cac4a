"""Feature preparation queries: fitted on one part, applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import PEOPLE, SCORED, hash_sql, people, scored
from catalog.registry import register
from scoreloom.operators import prep

NUMBERS = ["balance", "tier", "rare"]


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@register("impute_mean", f"""
WITH {PEOPLE}, m AS (SELECT avg(balance) AS b, avg(CASE WHEN tier <> 1 THEN tier END) AS t FROM people)
SELECT cust, round(coalesce(balance, b), 6) AS balance, round(coalesce(CASE WHEN tier <> 1 THEN tier END, t), 6) AS tier
FROM people, m""")
def impute_mean(spark, folder):
    """The marker is 1 here; the usual -1 does not occur in the given tables."""
    df = people(spark, folder).select("cust", "balance", "tier")
    return rounded(prep.fit_means(df, ["balance", "tier"], marker=1).apply(df), ["balance", "tier"])


MODE = "(SELECT segment FROM people WHERE segment IS NOT NULL {where} GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)"


@register("impute_mode", f"""
WITH {PEOPLE} SELECT cust, coalesce(segment, {MODE.format(where='')}) AS segment FROM people""")
def impute_mode(spark, folder):
    df = people(spark, folder).select("cust", "segment")
    return prep.fit_modes(df).apply(df)


@register("impute_apply", f"""
WITH {PEOPLE}, m AS (SELECT avg(balance) AS b FROM people WHERE installed = 1)
SELECT cust, round(coalesce(balance, b), 6) AS balance, coalesce(segment, 'VERIFICAR') AS segment FROM people, m""")
def impute_apply(spark, folder):
    """Means of the installed customers fill all; text without a fitted value becomes the unknown text."""
    df = people(spark, folder).select("cust", "balance", "segment", "installed")
    fill = prep.fit_means(df.where("installed = 1"), ["balance"], marker=None)
    return rounded(fill.apply(df, unknown_texts=True).drop("installed"), ["balance"])


@register("impute_median", f"""
WITH {PEOPLE}, m AS (SELECT quantile_cont(balance, 0.5) AS b, quantile_cont(tier, 0.5) AS t, quantile_cont(rare, 0.5) AS r FROM people)
SELECT cust, round(coalesce(balance, b), 6) AS balance, round(coalesce(tier, t), 6) AS tier, round(coalesce(rare, r), 6) AS rare,
  coalesce(segment, {MODE.format(where='')}) AS segment FROM people, m""")
def impute_median(spark, folder):
    df = people(spark, folder).select("cust", *NUMBERS, "segment")
    filled = prep.fit_modes(df, ["segment"]).apply(prep.fit_medians(df, NUMBERS).apply(df))
    return rounded(filled, NUMBERS)


@register("route_by_cardinality", f"""
WITH {PEOPLE} SELECT 'segment' AS feature, CASE WHEN count(DISTINCT segment) < 20 THEN 'onehot' ELSE 'target' END AS route, count(segment) AS filled FROM people
UNION ALL SELECT 'nation_text', CASE WHEN count(DISTINCT nation_text) < 20 THEN 'onehot' ELSE 'target' END, count(nation_text) FROM people
UNION ALL SELECT 'balance', 'numeric', count(balance) FROM people
UNION ALL SELECT 'tier', 'numeric', count(tier) FROM people
UNION ALL SELECT 'rare', 'numeric', count(rare) FROM people""")
def route_by_cardinality(spark, folder):
    df = people(spark, folder)
    route = prep.route_by_cardinality(df, 20, ["cust", "name", "nation", "installed", "y"])
    filled = df.agg(*[F.count(c).alias(c) for c in route])
    items = [
        F.struct(F.lit(c).alias("feature"), F.lit(r).alias("route"), F.col(c).alias("filled")) for c, r in route.items()
    ]
    return filled.select(F.inline(F.array(*items)))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@register("one_hot", f"""
WITH {PEOPLE} SELECT cust, {', '.join(f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in SEGMENTS)},
  {', '.join(f"CASE WHEN tier = {t} THEN 1 ELSE 0 END AS tier_{t}" for t in (1, 2, 3))} FROM people""")
def one_hot(spark, folder):
    """Fitted on installed customers; the second encoder drops its first category."""
    df = people(spark, folder).select("cust", "segment", F.col("tier").cast("int").cast("string").alias("tier"), "installed")
    seen = df.where("installed = 1")
    both = prep.fit_one_hot(seen, ["tier"], drop_first=True).apply(prep.fit_one_hot(seen, ["segment"]).apply(df))
    return both.drop("installed")


@register("ordinal_encode", f"""
WITH {PEOPLE} SELECT cust, CASE coalesce(segment, 'none') WHEN 'none' THEN 0 WHEN 'FURNITURE' THEN 1 WHEN 'BUILDING' THEN 2
  WHEN 'MACHINERY' THEN 3 WHEN 'AUTOMOBILE' THEN 4 END::DOUBLE AS segment FROM people""")
def ordinal_encode(spark, folder):
    df = people(spark, folder).select("cust", F.coalesce("segment", F.lit("none")).alias("segment"))
    return prep.ordinal_encode(df, {"segment": ["none", "FURNITURE", "BUILDING", "MACHINERY", "AUTOMOBILE"]})


def shrunk_sql(mean, variance):
    return f"""(n * {variance} / (n * {variance} + greatest(q / n - (s / n) * (s / n), 0))) * s / n
  + (1 - n * {variance} / (n * {variance} + greatest(q / n - (s / n) * (s / n), 0))) * {mean}"""


@register("target_encode", f"""
WITH {PEOPLE}, t AS (SELECT * FROM people WHERE installed = 1),
o AS (SELECT avg(y) AS m, var_pop(y) AS v FROM t),
c AS (SELECT nation_text, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s, CAST(sum(y * y) AS DOUBLE) AS q FROM t GROUP BY 1),
e AS (SELECT nation_text, {shrunk_sql('m', 'v')} AS enc FROM c, o)
SELECT cust, round(coalesce(enc, m), 9) AS nation_text FROM people LEFT JOIN e USING (nation_text), o""")
def target_encode(spark, folder):
    df = people(spark, folder).select("cust", "nation_text", "installed", "y")
    encoding = prep.fit_target_encoding(df.where("installed = 1"), ["nation_text"], "y")
    return rounded(encoding.apply(df.drop("installed", "y")), ["nation_text"], 9)


@register("target_encode_cross_fit", f"""
WITH {PEOPLE}, f AS (SELECT cust, nation_text, y,
  CAST(CAST(('0x' || substr({hash_sql('cust')}, 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM people),
o AS (SELECT k.fold, avg(f.y) AS m, var_pop(f.y) AS v FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
c AS (SELECT k.fold, nation_text, CAST(count(*) AS DOUBLE) AS n, CAST(sum(f.y) AS DOUBLE) AS s, CAST(sum(f.y * f.y) AS DOUBLE) AS q
  FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold, nation_text),
e AS (SELECT fold, nation_text, {shrunk_sql('m', 'v')} AS enc FROM c JOIN o USING (fold))
SELECT cust, nation_text, y, round(coalesce(enc, m), 9) AS nation_text_encoded
FROM f LEFT JOIN e USING (fold, nation_text) JOIN o USING (fold)""")
def target_encode_cross_fit(spark, folder):
    df = people(spark, folder).select("cust", "nation_text", "y")
    return rounded(prep.cross_fit_target_encode(df, "nation_text", "y", ["cust"]), ["nation_text_encoded"], 9)


@register("standard_scale", f"""
WITH {SCORED}, m AS (SELECT avg(score) AS ms, stddev_pop(score) AS ss, avg(qty) AS mq, stddev_pop(qty) AS sq FROM scored)
SELECT id, line, part, round((score - ms) / ss, 6) AS score, round((qty - mq) / sq, 6) AS qty FROM scored, m""")
def standard_scale(spark, folder):
    df = scored(spark, folder).select("id", "line", "part", "score", "qty")
    return rounded(prep.fit_standard_scale(df, ["score", "qty"]).apply(df), ["score", "qty"])


def iqr(c):
    return f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS w_{c}"


@register("robust_scale", f"""
WITH {SCORED}, m AS (SELECT {iqr('score')}, {iqr('qty')} FROM scored)
SELECT id, line, part, round((score - m_score) / w_score, 6) AS score, round((qty - m_qty) / w_qty, 6) AS qty FROM scored, m""")
def robust_scale(spark, folder):
    df = scored(spark, folder).select("id", "line", "part", "score", "qty")
    return rounded(prep.fit_robust_scale(df, ["score", "qty"]).apply(df), ["score", "qty"])


@register("prep_pipeline", f"""
WITH {PEOPLE}, t AS (SELECT * FROM people WHERE installed = 1),
m AS (SELECT quantile_cont(balance, 0.5) AS b, quantile_cont(tier, 0.5) AS t FROM t),
mode AS (SELECT segment AS top FROM t WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1),
ft AS (SELECT coalesce(balance, b) AS balance, coalesce(tier, m.t) AS tier, coalesce(segment, top) AS segment, nation_text, y FROM t, m, mode),
w AS (SELECT {iqr('balance')}, quantile_cont(tier, 0.5) AS m_tier,
  CASE WHEN quantile_cont(tier, 0.75) = quantile_cont(tier, 0.25) THEN 1 ELSE quantile_cont(tier, 0.75) - quantile_cont(tier, 0.25) END AS w_tier FROM ft),
o AS (SELECT avg(y) AS mean, var_pop(y) AS v FROM ft),
c AS (SELECT nation_text, CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS s, CAST(sum(y * y) AS DOUBLE) AS q FROM ft GROUP BY 1),
e AS (SELECT nation_text, {shrunk_sql('mean', 'v')} AS enc FROM c, o)
SELECT cust, y, {', '.join(f"CASE WHEN coalesce(segment, top) = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in SEGMENTS)},
  round(coalesce(enc, mean), 9) AS nation_text,
  round((coalesce(balance, b) - m_balance) / w_balance, 6) AS balance, round((coalesce(tier, m.t) - m_tier) / w_tier, 6) AS tier
FROM people LEFT JOIN e USING (nation_text), m, mode, w, o""")
def prep_pipeline(spark, folder):
    df = people(spark, folder).select("cust", "segment", "nation_text", "balance", "tier", "installed", "y")
    fitted = prep.fit_prep(df.where("installed = 1").drop("installed"), "y", ["cust"])
    return rounded(rounded(fitted.apply(df), ["balance", "tier"]), ["nation_text"], 9)


@register("drop_low_variance", f"""
WITH {SCORED} SELECT id, line, part, score, qty FROM scored
WHERE (SELECT var_samp(disc) < 0.1 AND var_samp(tax) < 0.1 AND var_samp(score) >= 0.1 AND var_samp(qty) >= 0.1 FROM scored)""")
def drop_low_variance(spark, folder):
    df = scored(spark, folder).select("id", "line", "part", "score", "qty", "disc", "tax")
    return df.drop(*prep.low_variance(df, ["score", "qty", "disc", "tax"], 0.1))


@register("drop_correlated", f"""
WITH {SCORED}, c AS (SELECT abs(corr(qty, score)) AS a, abs(corr(qty, disc)) AS b, abs(corr(score, disc)) AS c FROM scored)
SELECT id, line, part, CASE WHEN b > 0.5 OR c > 0.5 THEN NULL ELSE disc END AS disc, qty,
  CASE WHEN a > 0.5 THEN NULL ELSE score END AS score FROM scored, c""")
def drop_correlated(spark, folder):
    df = scored(spark, folder).select("id", "line", "part", "qty", "score", "disc").withColumn("qty_twice", F.col("qty") * 2 + 1)
    return df.drop(*prep.correlated(df, ["qty", "score", "disc", "qty_twice"], 0.5))


GAPS = ["score", "qty", "disc", "tax", "steady"]


@register("pairwise_correlations", f"""
WITH {SCORED}, g AS (
  SELECT CASE WHEN line % 3 = 0 THEN NULL ELSE CAST(score AS DOUBLE) END AS score, CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(qty AS DOUBLE) END AS qty,
    CASE WHEN line % 3 <> 0 THEN NULL ELSE CAST(disc AS DOUBLE) END AS disc, CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(tax AS DOUBLE) END AS tax,
    CAST(7 AS DOUBLE) AS steady
  FROM scored)
{" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, " + ("max(CAST(NULL AS DOUBLE))" if "steady" in (a, b) else f"round(corr({a}, {b}), 6)") + " AS r FROM g" for j, b in enumerate(GAPS) for a in GAPS[:j])}""")
def pairwise_correlations(spark, folder):
    """Every row has a null somewhere; score and disc have no row in common."""
    df = scored(spark, folder)
    gaps = df.select(
        F.when(F.col("line") % 3 != 0, F.col("score")).alias("score"), F.when(F.col("id") % 4 != 0, F.col("qty")).alias("qty"),
        F.when(F.col("line") % 3 == 0, F.col("disc")).alias("disc"), F.when(F.col("id") % 5 != 0, F.col("tax")).alias("tax"),
        F.lit(7.0).alias("steady"),
    )
    found = prep.correlations(gaps, GAPS, 4)
    return rounded(spark.createDataFrame([(*pair, r) for pair, r in found.items()], "a string, b string, r double"), ["r"])


@register("auto_preprocess", f"""
WITH {PEOPLE}, m AS (SELECT avg(balance) AS balance, avg(tier) AS tier FROM people)
SELECT cust, y, round(coalesce(people.balance, m.balance), 6) AS balance, round(coalesce(people.tier, m.tier), 6) AS tier FROM people, m""")
def auto_preprocess(spark, folder):
    """``rare`` is mostly NULL and the encoded texts hardly vary, so both numbers are left of all columns, in every row."""
    df = people(spark, folder).select("cust", "segment", "nation_text", "balance", "tier", "rare", "y")
    table = prep.auto_preprocess(df, "y", ["cust"]).table
    return table.withColumns({c: F.round(c, 6) for c in ("balance", "tier")})
