"""From a raw feed to its typed, de-duplicated, partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.dedup import dedup_full_row, dedup_latest
from scoreloom.sources.feeds import Feed, read_parquet, typed
from scoreloom.sources.sinks import append_audit, write_partitioned


def silver(raw: DataFrame, feed: Feed, run_stamp: int) -> DataFrame:
    """Typed rows, one per key of the feed; a feed without a key loses exact duplicates only."""
    rows = typed(raw, feed, run_stamp)
    return dedup_latest(rows, feed.key) if feed.key else dedup_full_row(rows)


def silver_job(
    spark: SparkSession, feed: Feed, raw_path: str, table_path: str, audit_path: str, run_stamp: int
) -> None:
    """Write the table by cohort, then count what was written instead of computing it again."""
    write_partitioned(silver(read_parquet(spark, raw_path), feed, run_stamp), table_path)
    append_audit(spark.read.parquet(table_path), feed.name, audit_path)


def duplicate_lookup(rows: DataFrame, customer: str, line: str, moment: str) -> DataFrame:
    """All recharges of one line at one moment, to look at duplicates."""
    hit = (F.col("NUM_CPF") == customer) & (F.col("DW_NUM_NTC") == line)
    hit = hit & (F.col("DAT_INSERCAO_CREDITO") == F.lit(moment).cast("timestamp"))
    return rows.where(hit).orderBy("DW_NUM_NTC", "DAT_INSERCAO_CREDITO", "HOR_INSERCAO_CREDITO")
