"""Query of the exact copies."""

from scoreloom.llm.exact_dedup import copies
from scoreloom.llm.register import documents, register

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@register("op5_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
WINDOW g AS (PARTITION BY norm)""")
def op5_exact_dedup(spark, folder):
    return copies(documents(spark, folder))
