"""Query of the URL filter."""

from scoreloom.llm.register import register
from scoreloom.llm.url_filter import judge

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
TABLE = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '://([^/?#]*)', 1))"  # the hosts given are plain ASCII


def path(url: str) -> str:
    return f"regexp_extract({url}, '://[^/?#]*([^?#]*)', 1)"


def form(url: str) -> str:
    plain = f"regexp_replace({host(url)}, '^(?:www|m)\\.', '')"
    short = f"regexp_replace(regexp_replace({path(url)}, '(?:/index)?\\.html?$', ''), '/+$', '')"
    query = f"regexp_replace(regexp_replace(regexp_extract({url}, '\\?([^#]*)', 1), '(?:^|&)(?:utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&', '')"
    return f"'https://' || {plain} || {short} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END"


@register("op8_url_filter", rf"""
WITH rules(rhost, rpath, verdict) AS (VALUES {TABLE}),
urls AS (
  SELECT DISTINCT url, {form('url')} AS form FROM pages WHERE url LIKE '%://%'
  UNION SELECT DISTINCT {form('url')}, {form('url')} FROM pages WHERE url LIKE '%://%'),
best AS (
  SELECT url, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS own
  FROM urls JOIN rules ON ({host('url')} = rhost OR ends_with({host('url')}, '.' || rhost)) AND starts_with({path('url')}, rpath)
  GROUP BY url),
aliases AS (
  SELECT form, min(url) AS alias_of, coalesce(bool_or(own = 'block'), false) AND NOT coalesce(bool_or(own = 'allow'), false) AS carried
  FROM urls LEFT JOIN best USING (url) GROUP BY form)
SELECT page_id, coalesce({host('p.url')}, '') AS host, coalesce({path('p.url')}, '') AS path, rule,
       coalesce(own, CASE WHEN carried THEN 'block' END, 'allow') AS verdict, coalesce(alias_of, p.url) AS alias_of
FROM pages p LEFT JOIN best b ON p.url = b.url LEFT JOIN aliases a ON p.url LIKE '%://%' AND a.form = {form('p.url')}""")
def op8_url_filter(spark, folder):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(spark.read.parquet(f"{folder}/pages.parquet"), rules)
