"""Writers: partitioned overwrite, keyed upsert, audit rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.session import fresh_path


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("SAFRA",),
    only_touched: bool = False,
    files_per_partition: int | None = None,
) -> None:
    """Overwrite a partitioned table; with ``only_touched`` just the partitions present in ``df``.

    Without ``files_per_partition`` the write needs no shuffle. With it, rows are spread over that
    many writers per partition value, so a cohort holding most rows is never written by one task.
    The spread follows the row's content, so a repeated task sends every row the same way.
    """
    if files_per_partition:
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition)))
    mode = "dynamic" if only_touched else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = ("SAFRA",),
    fmt: str = "parquet",
    buckets: int | None = None,
    bucket_by: Sequence[str] = ("NUM_CPF",),
    **options: str,
) -> None:
    """Overwrite a catalog table; ``fmt`` and options (``overwriteSchema``, ``mergeSchema``) are the catalog's.

    With ``buckets`` every cohort is stored hashed by customer, so that later joins and books on that
    key need no shuffle (joins on customer and cohort also need
    ``spark.sql.requireAllClusterKeysForCoPartition=false``). Rows are brought into that layout first,
    one file per cohort and bucket.
    """
    if buckets:
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).options(**options)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a parquet table at ``path``."""
    try:
        spark.read.parquet(path).schema  # noqa: B018  (a Connect session looks only when asked)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same keys; the rest of both stays.

    NULL keys are equal to each other. Both sides are read once: rows of one key meet in one group. A key that the
    source holds twice is an error, as it would be in a MERGE.
    """
    both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    new = F.sum("_new").over(Window.partitionBy(*keys))
    twice = F.raise_error(F.lit("the source of an upsert holds a key twice")).cast("boolean")
    both = both.withColumn("_news", new)
    return both.where(F.when(F.col("_news") > 1, twice).otherwise((F.col("_new") == 1) | (F.col("_news") == 0))).drop("_new", "_news")


def upsert_by_key(
    source: DataFrame,
    path: str,
    keys: Sequence[str] = ("NUM_CPF", "SAFRA"),
    partition_by: str = "SAFRA",
    values: Sequence | None = None,
) -> None:
    """Update or insert ``source`` into a partitioned parquet table; repeating it changes nothing.

    ``partition_by`` must be one of ``keys``, so only partitions present in ``source`` can change.
    Those are rewritten to a staging folder first and only then replace the old ones: the target is
    never read and overwritten at once, and a failed run can simply be repeated. ``values``: the
    partitions that the source holds, where the caller knows them; it is then computed just once.
    """
    spark = source.sparkSession
    if partition_by not in keys:
        raise ValueError("the partition column must be part of the key")
    if not path_exists(spark, path):
        write_partitioned(merged(source.limit(0), source, keys), path, [partition_by])
        return
    result = fresh_path(spark, "merged")
    if values is None:
        # The source may be an expensive book: compute it once, then only read it.
        incoming = fresh_path(spark, "incoming")
        write_partitioned(source, incoming, [partition_by])
        source = spark.read.schema(source.schema).parquet(incoming)
        # One value per partition of the source, so that untouched partitions are not even listed.
        values = [r[0] for r in source.select(partition_by).distinct().collect()]
    touched = F.col(partition_by).isin([v for v in values if v is not None])
    if None in values:
        touched = touched | F.col(partition_by).isNull()
    target = spark.read.option("mergeSchema", "true").parquet(path).where(touched)
    write_partitioned(merged(target, source, keys), result, [partition_by])
    write_partitioned(spark.read.parquet(result), path, [partition_by], only_touched=True)


def audit_rows(df: DataFrame, table: str, cohort: str = "SAFRA") -> DataFrame:
    """One control row per cohort: table name, cohort, row count."""
    return df.groupBy(F.col(cohort).alias("safra")).agg(F.count("*").alias("qtd_registros")).select(
        F.lit(table).alias("nome_tabela"), "safra", "qtd_registros"
    )


def append_audit(df: DataFrame, table: str, path: str, cohort: str = "SAFRA") -> None:
    """Append the control rows of a written table, stamped with the time of writing."""
    rows = audit_rows(df, table, cohort).withColumn("datproc", F.current_timestamp())
    rows.write.mode("append").parquet(path)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of every stage. Each branch reads only what its count needs, and a retried
    task cannot be counted twice, unlike with accumulator-based observation."""
    counts = [df.agg(F.lit(name).alias("stage"), F.count("*").alias("n")) for name, df in stages.items()]
    out = counts[0]
    for nxt in counts[1:]:
        out = out.unionByName(nxt)
    return out
