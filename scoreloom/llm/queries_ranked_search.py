"""Query of the ranked lexical search."""

from scoreloom.llm.ascii import LOWER, UPPER
from scoreloom.llm.ranked_search import Search, search
from scoreloom.llm.register import documents, register


def terms(table: str, key: str) -> str:
    return rf"""SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                 '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM {table}"""


SQL = rf"""
WITH held AS (SELECT doc_id, term, count(*) AS tf FROM ({terms("documents", "doc_id")}) GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
whole AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
wanted AS (SELECT DISTINCT item_id, term FROM ({terms("benchmark", "item_id")})),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term),
norms AS (SELECT doc_id, 100 - 50 + ((50 * n * documents) // terms) AS m FROM lengths, whole),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50"""


@register("op11_ranked_search", SQL)
def op11_ranked_search(spark, folder):
    return search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), Search(k=50))
