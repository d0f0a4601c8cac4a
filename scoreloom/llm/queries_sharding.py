"""Query of the shards."""

from pyspark.sql import functions as F

from scoreloom.llm.register import documents, register
from scoreloom.llm.sharding import SlotMap, balanced, placed, records, slot_sizes
from scoreloom.session import fresh_path

SHARDS = 24


@register("op9_virtual_slots")
def op9_virtual_slots(spark, folder):
    rows = records(documents(spark, folder))
    sizes = slot_sizes(rows)
    stored = fresh_path(spark, "slot_maps")
    balanced(sizes, SHARDS).save(spark, stored)
    return placed(rows, SlotMap.load(spark, stored), sizes).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
