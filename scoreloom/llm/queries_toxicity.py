"""Query of the toxicity scores."""

from pyspark.sql import functions as F

from scoreloom.llm.register import documents, register
from scoreloom.llm.toxicity import fit, held_out, scored, training_rows


@register("op1_toxicity")
def op1_toxicity(spark, folder):
    docs = documents(spark, folder)
    model = fit(training_rows(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
