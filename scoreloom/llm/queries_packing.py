"""Query of the packed sequences."""

import public_tokenizers
from pyspark.sql import functions as F

from scoreloom.llm.packing import packed, vocabulary
from scoreloom.llm.register import documents, register


@register("op7_packing")
def op7_packing(spark, folder):
    pieces = packed(documents(spark, folder), vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
