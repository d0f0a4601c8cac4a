"""URL filter: allow and block rules by host and path, carried over redirects and canonical links.

1. Each url gets its own rule: the longest whose host is the url's host or a parent of it and whose path begins the
   url's path. Rules are a table, joined on the suffixes of the distinct hosts, so a long list costs no more per row.
2. Urls that lead to one page are linked: a url to its plain form (scheme, ``www.`` and ``m.``, fragment, tracking
   parameters, ``.html``, closing slash), to the canonical link or refresh target in its html, and by any given
   redirects. Connected components of these links are the sets of aliases.
3. A url with a rule of its own follows it. Any other is blocked if an alias of it is blocked by rule and none is
   explicitly allowed; otherwise it is allowed.

Null urls and those without ``://`` have an empty host and path, no rule and no alias: allow. Rows with equal urls get
equal verdicts, one row each. Empty tables give empty results. Columns beside those named are not read. Only DataFrame
functions are used. Equal long rules fitting one url: the longer host wins, then allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.ascii import lower_ascii
from scoreloom.llm.components import components
from scoreloom.session import written

CANONICAL = r"""(?is)<link\b(?=[^>]{0,2000}?\brel\s{0,9}=\s{0,9}["']?canonical\b)[^>]{0,2000}?\bhref\s{0,9}=\s{0,9}["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]{0,2000}?\bhttp-equiv\s{0,9}=\s{0,9}["']?refresh\b)[^>]{0,2000}?\burl\s{0,9}=\s{0,9}["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def plain_form(url: Column) -> Column:
    """The form that equivalent spellings of a url share."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"(?:/index)?\.html?$", ""), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(url, r"\?([^#]*)", 1), r"(?:^|&)(?:utm_[a-z]+|ref)=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    return F.concat(F.lit("https://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def absolute(target: Column, base: Column) -> Column:
    """A link's target as a whole url; null where there is none."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    site = F.regexp_extract(base, r"^[^/?#]*://[^/?#]*", 0)
    return (
        F.when(target == "", None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^([^/?#]*:)//", 1), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(site, F.coalesce(F.nullif(F.regexp_extract(path_of(base), r"^.*/", 0), F.lit("")), F.lit("/")), target))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(a, b)``: urls that lead to the same page, as far as the pages themselves say."""
    page = pages.select(F.col(f"`{url}`").alias("a"), F.col(f"`{html}`").alias("html")).where("a LIKE '%://%'")
    found = page.select(
        "a",
        F.array(
            plain_form(F.col("a")),
            F.when(F.col("html").rlike("(?i)canonical"), absolute(F.regexp_extract("html", CANONICAL, 1), F.col("a"))),
            F.when(F.col("html").rlike("(?i)http-equiv"), absolute(F.regexp_extract("html", REFRESH, 1), F.col("a"))),
        ).alias("to"),
    )
    one = found.select("a", F.explode("to").alias("b")).where("b LIKE '%://%'")
    targets = one.select(F.col("b").alias("a")).distinct()  # a target reaches its own plain form as well
    return one.unionByName(targets.select("a", plain_form(F.col("a")).alias("b"))).where("a != b").distinct()


def own_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) and the rule that fits best, as ``rule`` and ``own`` verdict, or null.

    ``rules``: ``host``, ``path`` and ``verdict`` (allow or block).
    """
    rules = rules.select(
        F.col("host").alias("suffix"),
        F.struct(
            F.length(F.concat("host", "path")).alias("length"),
            F.length("host").alias("host_length"),
            (F.col("verdict") == "allow").alias("allow"),
            F.col("path").alias("path"),
            F.concat("host", "path").alias("rule"),
        ).alias("r"),
    )
    labels = rules.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 1
    part = F.split("host", r"\.")
    from_end = F.sequence(F.lit(1), F.least(F.size(part), F.lit(labels)))
    suffixes = F.transform(from_end, lambda n: F.array_join(F.slice(part, F.size(part) - n + 1, n), "."))
    by_host = (
        urls.select("host").distinct()
        .select("host", F.explode(suffixes).alias("suffix"))
        .join(rules, "suffix")
        .groupBy("host").agg(F.collect_list("r").alias("rules"))
    )
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    return (
        urls.join(by_host, "host", "left")
        .withColumn("best", F.array_max(fitting))
        .withColumn("rule", F.col("best.rule"))
        .withColumn("own", F.when(F.col("best.allow"), "allow").when(F.col("best").isNotNull(), "block"))
        .drop("rules", "best")
    )


def judge(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """One row per row of ``pages``: ``key``, host, path, rule, verdict and the smallest url among its aliases.

    ``redirects``: further ``(a, b)`` pairs of whole urls.
    """
    edges = link_edges(pages, url, html)
    if redirects is not None:
        more = redirects.select("a", "b").where("a LIKE '%://%' AND b LIKE '%://%'")
        ends = more.select(F.explode(F.array("a", "b")).alias("a"))
        edges = edges.unionByName(more).unionByName(ends.select("a", plain_form(F.col("a")).alias("b")))
    groups = components(edges)

    page = F.col(f"`{url}`")
    rows = pages.select(F.col(f"`{key}`").alias(key), page.alias("url"), host_of(page).alias("host"), path_of(page).alias("path"))
    known = written(own_rules(rows, rules).join(groups, F.col("url") == F.col("node"), "left").select(
        key, "host", "path", "rule", "own", F.coalesce("component", "url").alias("alias_of")
    ), "judged")
    # Aliases that are no page of their own may still fall under a rule.
    others = own_rules(
        groups.select(F.col("node").alias("url"), F.col("component").alias("alias_of"))
        .unionByName(groups.select(F.col("component").alias("url"), F.col("component").alias("alias_of")).distinct())
        .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))),
        rules,
    ).where("own IS NOT NULL").select("alias_of", "own")
    blocked = (
        others.groupBy("alias_of")
        .agg(F.max((F.col("own") == "block").cast("int")).alias("block"), F.max((F.col("own") == "allow").cast("int")).alias("allow"))
        .where("block = 1 AND allow = 0").select("alias_of", F.lit("block").alias("carried"))
    )
    return known.join(blocked, "alias_of", "left").select(
        key, "host", "path", "rule",
        F.coalesce("own", "carried", F.lit("allow")).alias("verdict"),
        "alias_of",
    )
