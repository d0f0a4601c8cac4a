"""Policy comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bands import band_sql, edges_sql
from catalog.inputs import POLICY, SCORED, THRESHOLD, policy, scored
from catalog.registry import register
from scoreloom.operators import assemble, banding
from scoreloom.operators import policy as policies

SWAPPED = f"""{POLICY}, swapped AS (SELECT *, CASE WHEN installed = 0 AND approved = 1 THEN 'swap_in'
  WHEN installed = 1 AND approved = 0 THEN 'swap_out' ELSE 'mantido' END AS grupo_swap
  FROM (SELECT *, CASE WHEN points >= {THRESHOLD} THEN 1 ELSE 0 END AS approved FROM policy)),
control AS (SELECT * FROM policy WHERE substr(name, 17, 1) IN ('4', '7'))"""


def control(spark, folder):
    return assemble.control_group(policy(spark, folder), "name", 17, 1, ("4", "7"))


def swapped(spark, folder):
    return policies.with_swap(policy(spark, folder), "points", THRESHOLD, "installed")


@register("install_rate_control", f"""
WITH {SWAPPED} SELECT installed, count(*) AS n, count(*) / CAST((SELECT count(*) FROM control) AS DOUBLE) AS rate
FROM control GROUP BY installed""")
def install_rate_control(spark, folder):
    return policies.install_rates(control(spark, folder), "installed")


@register("estimated_approvals", f"""
WITH {SWAPPED} SELECT CAST(sum(installed) AS BIGINT) AS installed, sum(installed) / (
    SELECT CAST(sum(installed) AS DOUBLE) / count(*) FROM control) AS baseline_approvals,
  CAST(sum(approved) AS BIGINT) AS model_approvals FROM swapped""")
def estimated_approvals(spark, folder):
    return policies.estimated_approvals(swapped(spark, folder), control(spark, folder), "installed")


@register("policy_default_rate", f"""
WITH {SWAPPED} SELECT 'baseline' AS policy, count(*) AS n, CAST(sum(fpd) AS DOUBLE) / count(fpd) AS default_rate
FROM swapped WHERE installed = 1
UNION ALL SELECT 'modelo', count(*), CAST(sum(fpd) AS DOUBLE) / count(fpd) FROM swapped WHERE installed = 1 AND approved = 1""")
def policy_default_rate(spark, folder):
    return policies.policy_default_rates(swapped(spark, folder), "fpd", "installed")


@register("swap_table", f"""
WITH {SWAPPED} SELECT grupo_swap, count(cust) AS volume,
  CAST(sum(CASE WHEN installed = 1 THEN fpd END) AS DOUBLE) / count(CASE WHEN installed = 1 THEN fpd END) AS fpd_real
FROM swapped GROUP BY grupo_swap""")
def swap_table(spark, folder):
    return policies.swap_table(swapped(spark, folder), "cust", "fpd", "installed")


@register("risk_by_group", f"""
WITH {SWAPPED} SELECT grupo_swap, round(avg(p_hat), 9) AS risk FROM swapped GROUP BY grupo_swap""")
def risk_by_group(spark, folder):
    found = policies.risk_by_group(swapped(spark, folder), "p_hat")
    return found.withColumn("risk", F.round("risk", 9))


@register("swap_volume", f"WITH {SWAPPED} SELECT grupo_swap, count(*) AS volume FROM swapped GROUP BY grupo_swap")
def swap_volume(spark, folder):
    return policies.swap_volume(swapped(spark, folder))


def bands_sql(flag, name):
    return f"""SELECT '{name}' AS part, {band_sql('points', 'edges')} AS faixa, round(avg(score_01), 9) AS score_01,
  round(avg(points), 9) AS points, round(avg(fpd), 9) AS fpd, count(*) AS volume
FROM policy, (SELECT {edges_sql(f'(SELECT * FROM policy WHERE installed = {flag})', 'points', 10)} AS edges)
WHERE installed = {flag} GROUP BY 2"""


@register("band_summary", f"""
WITH {POLICY} {bands_sql(1, 'approved')} UNION ALL {bands_sql(0, 'rejected')}""")
def band_summary(spark, folder):
    df = policy(spark, folder)

    def part(flag, name):
        rows = banding.quantile_bands(df.where(F.col("installed") == flag), "points", 10, "faixa")
        return rows.withColumn("part", F.lit(name))

    both = part(1, "approved").unionByName(part(0, "rejected"))
    found = policies.band_summary(both, "faixa", ["score_01", "points", "fpd"], "part")
    return found.withColumns({c: F.round(c, 9) for c in ("score_01", "points", "fpd")})


@register("sort_rows", f"""
WITH {POLICY} SELECT cust, points, installed FROM policy ORDER BY points DESC, cust""")
def sort_rows(spark, folder):
    return policy(spark, folder).select("cust", "points", "installed").orderBy(F.desc("points"), "cust")


@register("custom_order", f"""
WITH {SWAPPED} SELECT grupo_swap, installed, count(*) AS n FROM swapped GROUP BY grupo_swap, installed
ORDER BY CASE grupo_swap WHEN 'mantido' THEN 0 WHEN 'swap_in' THEN 1 ELSE 2 END, installed""")
def custom_order(spark, folder):
    counts = swapped(spark, folder).groupBy("grupo_swap", "installed").agg(F.count("*").alias("n"))
    return policies.in_group_order(counts)


@register("top_features", f"""
WITH {SCORED}, r AS (SELECT supp, CAST(sum(y) AS DOUBLE) / count(*) AS rate FROM scored GROUP BY supp)
SELECT supp, rate FROM r ORDER BY rate DESC, supp LIMIT 15""")
def top_features(spark, folder):
    rates = scored(spark, folder).groupBy("supp").agg(F.avg("y").alias("rate"))
    return policies.top_features(rates, "rate", 15)
