"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import ORDERS, PEOPLE, SCORED, orders, people, scored, table
from catalog.registry import register
from scoreloom.operators import profile
from scoreloom.operators.dedup import duplicate_key_count
from scoreloom.operators.prep import as_category


@register("count_by_cohort", f"WITH {ORDERS} SELECT safra, count(*) AS n FROM orders_ GROUP BY safra")
def count_by_cohort(spark, folder):
    return profile.count_by(orders(spark, folder), "safra")


@register("count_and_distinct_by_cohort", f"""
WITH {ORDERS} SELECT safra, count(*) AS n, count(DISTINCT cust) AS n_keys FROM orders_ GROUP BY safra""")
def count_and_distinct_by_cohort(spark, folder):
    return profile.count_and_distinct_by(orders(spark, folder), "safra", "cust")


@register("cohort_summary_with_target", f"""
WITH {SCORED} SELECT safra, count(*) AS n, count(DISTINCT id) AS n_keys,
  round(sum(y) * 100 / CAST(count(y) AS DOUBLE), 2) AS pct_target FROM scored GROUP BY safra""")
def cohort_summary_with_target(spark, folder):
    return profile.cohort_summary(scored(spark, folder), "safra", "id", "y")


@register("frequency_table", f"""
WITH {PEOPLE} SELECT segment, count(*) AS n, round(count(*) * 100 / CAST((SELECT count(*) FROM people) AS DOUBLE), 2) AS pct
FROM people GROUP BY segment""")
def frequency_table(spark, folder):
    return profile.frequency_table(people(spark, folder), "segment")


def null_sql(columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, "
        f"round((count(*) - count({c})) * 100 / CAST(count(*) AS DOUBLE), 2) AS pct_nulls FROM people"
        for c in columns
    )


PEOPLE_COLUMNS = "cust name nation nation_text segment balance tier rare installed y".split()
PEOPLE_TYPES = "bigint string int string string double double double int int".split()


@register("null_report", f"WITH {PEOPLE} SELECT * FROM ({null_sql(PEOPLE_COLUMNS)}) WHERE nulls > 0")
def null_report(spark, folder):
    return profile.null_report(people(spark, folder))


@register("drop_high_null_columns", f"""
WITH {PEOPLE} SELECT cust, name, nation, nation_text, segment, balance, tier, installed, y FROM people""")
def drop_high_null_columns(spark, folder):
    """Columns found sparse on one table (installed customers) are dropped from all rows."""
    df = people(spark, folder)
    _, dropped = profile.drop_high_null_columns(df.where("installed = 1"), 0.7)
    return df.drop(*dropped)


def metadata_sql():
    roles = {"cust": "ID", "name": "ID", "y": "Target"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{roles.get(c, 'Explicativa')}' AS role, count(*) - count({c}) AS nulls, "
        f"round((count(*) - count({c})) * 100 / CAST(count(*) AS DOUBLE), 2) AS pct_nulls, "
        f"count(DISTINCT {c}) AS cardinality, '{t}' AS type FROM people"
        for c, t in zip(PEOPLE_COLUMNS, PEOPLE_TYPES)
    )


@register("metadata_profile", f"WITH {PEOPLE} {metadata_sql()}")
def metadata_profile(spark, folder):
    return profile.metadata_profile(people(spark, folder), ids=["cust", "name"], targets=["y"])


@register("select_by_null_cutoff", f"""
WITH {PEOPLE} SELECT feature, pct_nulls FROM ({null_sql(PEOPLE_COLUMNS)}) WHERE pct_nulls >= 15""")
def select_by_null_cutoff(spark, folder):
    found = profile.null_report(people(spark, folder), only_with_nulls=False)
    return profile.select_by_null_cutoff(found, 15, inclusive=True)


RATE = "CAST(sum(y) AS DOUBLE) / count(y) AS event_rate, count(*) AS volume"


@register("event_rate_by_cohort", f"WITH {SCORED} SELECT safra, {RATE} FROM scored GROUP BY safra")
def event_rate_by_cohort(spark, folder):
    return profile.event_rate_by(scored(spark, folder), "y", "safra")


@register("event_rate_by_variable", f"""
WITH {SCORED} SELECT CAST(disc AS VARCHAR) AS disc, {RATE} FROM scored GROUP BY 1 ORDER BY event_rate DESC""")
def event_rate_by_variable(spark, folder):
    df = scored(spark, folder)
    rows = df.withColumn("disc", as_category(df, "disc"))
    return profile.event_rate_by(rows, "y", "disc").orderBy(F.desc("event_rate"))


@register("event_rate_by_cohort_and_variable", f"""
WITH {SCORED}, g AS (SELECT safra, grp, {RATE} FROM scored GROUP BY safra, grp)
SELECT *, CAST(sum(volume) OVER (PARTITION BY safra) AS BIGINT) AS cohort_volume FROM g""")
def event_rate_by_cohort_and_variable(spark, folder):
    return profile.event_rate_by_cohort_and_variable(scored(spark, folder), "y", "safra", "grp")


@register("category_event_rates_auto", f"""
WITH {PEOPLE} SELECT 'segment' AS variable, segment AS value, {RATE} FROM people WHERE segment IS NOT NULL GROUP BY 2
UNION ALL SELECT 'tier', CAST(tier AS VARCHAR), {RATE} FROM people WHERE tier IS NOT NULL GROUP BY 2
UNION ALL SELECT 'installed', CAST(installed AS VARCHAR), {RATE} FROM people GROUP BY 2""")
def category_event_rates_auto(spark, folder):
    df = people(spark, folder)
    columns = profile.category_columns(df, 20, 20, leave_out=["y", "cust", "name", "nation_text", "nation", "balance", "rare"])
    return profile.category_event_rates(df, "y", columns)


@register("group_event_rate_with_nulls", f"""
WITH {PEOPLE} SELECT segment, count(segment) AS volume, CAST(sum(y) AS DOUBLE) / count(y) AS target_mean
FROM people GROUP BY segment""")
def group_event_rate_with_nulls(spark, folder):
    return profile.group_event_rate_with_nulls(people(spark, folder), "y", "segment")


@register("category_counts_with_total", f"""
WITH {PEOPLE}, p AS (SELECT * FROM people WHERE segment IS NOT NULL)
SELECT segment, installed, count(*) AS n, count(*) * 100 / CAST((SELECT count(*) FROM p) AS DOUBLE) AS pct
FROM p GROUP BY segment, installed
UNION ALL SELECT 'Total', NULL, count(*), 100.0::DOUBLE FROM p""")
def category_counts_with_total(spark, folder):
    return profile.counts_with_total(people(spark, folder), ["segment", "installed"])


def describe_sql(columns, rows):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, "
        f"round(min({c}), 2) AS min, round(quantile_cont({c}, 0.25), 2) AS q25, round(quantile_cont({c}, 0.5), 2) AS q50, "
        f"round(quantile_cont({c}, 0.75), 2) AS q75, round(max({c}), 2) AS max FROM {rows}"
        for c in columns
    )


@register("describe_numeric", f"""
WITH {PEOPLE} {describe_sql(['balance', 'tier', 'rare'], 'people')}""")
def describe_numeric(spark, folder):
    return profile.describe_numeric(people(spark, folder), ["balance", "tier", "rare"])


@register("target_distribution", f"""
WITH {SCORED} SELECT y, count(*) AS n, count(*) * 100 / CAST((SELECT count(*) FROM scored) AS DOUBLE) AS pct
FROM scored GROUP BY y""")
def target_distribution(spark, folder):
    return profile.target_distribution(scored(spark, folder), "y")


@register("crosstab_share", f"""
WITH {SCORED} SELECT safra, count(CASE WHEN y = 0 THEN 1 END) / CAST(count(*) AS DOUBLE) AS share_0,
  count(CASE WHEN y = 1 THEN 1 END) / CAST(count(*) AS DOUBLE) AS share_1 FROM scored GROUP BY safra""")
def crosstab_share(spark, folder):
    return profile.crosstab_share(scored(spark, folder), "safra", "y")


@register("pivot_counts", f"""
WITH {SCORED} SELECT supp, count(CASE WHEN y = 0 THEN 1 END) AS target_0, count(CASE WHEN y = 1 THEN 1 END) AS target_1
FROM scored GROUP BY supp""")
def pivot_counts(spark, folder):
    return profile.pivot_counts(scored(spark, folder), "supp", "y")


def histogram_sql(columns, rows, bins, by=()):
    group = "".join(f", {b}" for b in by)
    parts = [
        f"SELECT '{c}' AS variable{group}, bin, lo + bin * ((hi - lo) / {bins}) AS lower, count(*) AS n FROM ("
        f"SELECT {c}{group}, lo, hi, CAST(len(list_filter(range(1, {bins}), lambda i: {c} >= lo + (hi - lo) / {bins} * i))"
        f" AS INTEGER) AS bin FROM {rows}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {rows}) WHERE {c} IS NOT NULL)"
        f" GROUP BY bin, lo, hi{group}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@register("histogram_bins", f"WITH {SCORED} {histogram_sql(['score', 'qty', 'disc'], 'scored', 30, ['y'])}")
def histogram_bins(spark, folder):
    return profile.histogram(scored(spark, folder), ["score", "qty", "disc"], 30, ["y"])


def box_sql(columns, rows, by):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, {by}, q1, median, q3,
  min(CASE WHEN {c} >= q1 - (q3 - q1) * 1.5 AND {c} <= q3 + (q3 - q1) * 1.5 THEN {c} END) AS low_whisker,
  max(CASE WHEN {c} >= q1 - (q3 - q1) * 1.5 AND {c} <= q3 + (q3 - q1) * 1.5 THEN {c} END) AS high_whisker,
  count(CASE WHEN {c} < q1 - (q3 - q1) * 1.5 OR {c} > q3 + (q3 - q1) * 1.5 THEN 1 END) AS outliers, count(*) AS n
FROM {rows} JOIN (SELECT {by}, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
  quantile_cont({c}, 0.75) AS q3 FROM {rows} GROUP BY {by}) USING ({by}) GROUP BY {by}, q1, median, q3"""
        for c in columns
    )


@register("box_stats", f"""
WITH {SCORED} SELECT * REPLACE (round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3)
FROM ({box_sql(['score', 'qty'], 'scored', 'grp')})""")
def box_stats(spark, folder):
    found = profile.box_stats(scored(spark, folder), ["score", "qty"], ["grp"])
    return found.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@register("category_frequency_auto", f"""
WITH {PEOPLE} SELECT 'segment' AS variable, segment AS value, count(*) AS n FROM people GROUP BY segment
UNION ALL SELECT 'nation_text', nation_text, count(*) FROM people GROUP BY nation_text""")
def category_frequency_auto(spark, folder):
    df = people(spark, folder)
    return profile.category_frequencies(df, profile.category_columns(df, 30))


@register("duplicate_key_count", """
SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS duplicates FROM lineitem""")
def duplicate_key_count_(spark, folder):
    return duplicate_key_count(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])

