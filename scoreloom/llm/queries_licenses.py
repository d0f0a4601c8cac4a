"""Query of the license scan."""

from pyspark.sql import functions as F

from scoreloom.llm.licenses import scan
from scoreloom.llm.register import documents, register


@register("op6_licenses")
def op6_licenses(spark, folder):
    # The documents' place in a tree of directories: source, language, file.
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan(documents(spark, folder), path, all_terms=True)
