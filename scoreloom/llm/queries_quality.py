"""Query of the quality rules."""

from scoreloom.llm.quality import repetition
from scoreloom.llm.register import documents, register

WORDS = r"""words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
)"""


def covered(n: int) -> str:
    """Words that lie in n-word windows which their text has at least twice."""
    tail = ", ".join(f"lead(word, {k}) OVER o" for k in range(1, n))
    gram = f"CASE WHEN lead(word, {n - 1}) OVER o IS NOT NULL THEN concat_ws(' ', word, {tail}) END"
    return f"""g{n} AS (
  SELECT doc_id, sum(hit) AS words{n}, sum(hit * length(word)) AS chars{n} FROM (
    SELECT doc_id, word, max(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS hit
    FROM (
      SELECT doc_id, word, pos, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 THEN 1 ELSE 0 END AS twice
      FROM (SELECT doc_id, word, pos, {gram} AS gram FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)))
  ) GROUP BY doc_id)"""


SQL = rf"""
WITH {WORDS}, {covered(3)}, {covered(5)}, {covered(7)}, {covered(10)},
w AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY doc_id),
l AS (
  SELECT doc_id, sum(length(line)) AS line_chars, sum(CASE WHEN earlier > 0 THEN 1 ELSE 0 END) AS n_dup_lines,
         sum(CASE WHEN earlier > 0 THEN length(line) ELSE 0 END) AS dup_line_chars
  FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) - 1 AS earlier
        FROM (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(words3, 0) AS n_repeat_words,
         coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars,
         coalesce(chars5, 0) AS dup_5gram_chars, coalesce(chars7, 0) AS dup_7gram_chars,
         coalesce(chars10, 0) AS dup_10gram_chars
  FROM documents d LEFT JOIN w USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN g3 USING (doc_id)
       LEFT JOIN g5 USING (doc_id) LEFT JOIN g7 USING (doc_id) LEFT JOIN g10 USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(line_chars AS BIGINT) AS line_chars,
       CAST(dup_line_chars AS BIGINT) AS dup_line_chars, CAST(dup_5gram_chars AS BIGINT) AS dup_5gram_chars,
       CAST(dup_7gram_chars AS BIGINT) AS dup_7gram_chars, CAST(dup_10gram_chars AS BIGINT) AS dup_10gram_chars,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * dup_line_chars <= 20 * line_chars
         AND 100 * dup_5gram_chars <= 30 * word_chars AND 100 * dup_7gram_chars <= 26 * word_chars
         AND 100 * dup_10gram_chars <= 20 * word_chars AS kept
FROM m"""


@register("op10_quality_rules", SQL)
def op10_quality_rules(spark, folder):
    return repetition(documents(spark, folder), carry=["doc_id"]).select("doc_id", "quality.*")
