"""Query of byte-level BPE."""

import public_tokenizers
from pyspark.sql import functions as F

from scoreloom.llm.bpe import Codec, read_ranks
from scoreloom.llm.register import documents, register


@register("op2_bpe")
def op2_bpe(spark, folder):
    codec = Codec(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    coded = codec.encode(documents(spark, folder).select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(codec.packed(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(codec.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )
