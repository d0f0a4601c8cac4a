"""Query of the personal data."""

from pyspark.sql import functions as F

from scoreloom.llm.pii import BASE, found, joined
from scoreloom.llm.register import documents, register


@register("op4_pii")
def op4_pii(spark, folder):
    rows = found(documents(spark, folder), carry=["doc_id"])
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *(count(kind) for kind in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )
