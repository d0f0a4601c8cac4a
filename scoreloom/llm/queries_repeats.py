"""Query of the passages that repeat."""

from pyspark.sql import functions as F

from scoreloom.llm.register import documents, register
from scoreloom.llm.repeats import repeats

SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, s, substring(x, 2 * s + 1, 200) AS g FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS s FROM d)),
gone AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
marked AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM gone),
numbered AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked),
spans AS (SELECT doc_id, span, min(s) AS b, max(s) + 100 AS e FROM numbered GROUP BY doc_id, span),
cuts AS (SELECT doc_id, e AS low, lead(b) OVER (PARTITION BY doc_id ORDER BY b) AS high FROM spans
         UNION ALL SELECT doc_id, 0, min(b) FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substring(x, 2 * low + 1, 2 * (coalesce(high, n) - low)), '' ORDER BY low) AS k
         FROM cuts JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@register("op13_repeats", SQL)
def op13_repeats(spark, folder):
    return repeats(documents(spark, folder), carry=["doc_id"]).select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed", F.size("repeats.spans").cast("long").alias("n_spans"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )
