"""The one big table: scores, usage and registration data of every customer and cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.scalars import age_in_cohort, postal_region
from scoreloom.operators.assemble import KEYS, star_join
from scoreloom.operators.dedup import dedup_full_row
from scoreloom.operators.profile import cohort_summary
from scoreloom.sources.sinks import append_audit, write_partitioned

# The table's leading columns and those that are not carried over as they are.
LEADING = ("NUM_CPF", "SAFRA", "FLAG_INSTALACAO", "FPD", "PROD", "flag_mig2", "SCORE_01", "SCORE_02")
NOT_CARRIED = ("DATADENASCIMENTO", "DATPROC", "rn")


def one_big_table(bureau: DataFrame, telco: DataFrame, registration: DataFrame, run_stamp: int) -> DataFrame:
    """Bureau rows with the telco and registration columns they lack, age instead of birth date."""
    wide = star_join(bureau.drop("rn", "DATPROC"), [t.drop("rn", "DATPROC") for t in (telco, registration)], KEYS)
    rest = [c for c in wide.columns if c not in LEADING and c not in NOT_CARRIED]
    return dedup_full_row(
        wide.select(
            *LEADING, *rest, age_in_cohort(F.col("SAFRA"), F.col("DATADENASCIMENTO")).alias("IDADE"),
            F.lit(run_stamp).cast("bigint").alias("DATPROC"),
        )
    )


def one_big_table_job(
    bureau: DataFrame, telco: DataFrame, registration: DataFrame, table_path: str, audit_path: str, run_stamp: int
) -> None:
    write_partitioned(one_big_table(bureau, telco, registration, run_stamp), table_path)
    append_audit(bureau.sparkSession.read.parquet(table_path), "one_big_table_publico", audit_path)


def with_region(table: DataFrame) -> DataFrame:
    return table.withColumn("regiao", postal_region(F.col("CEP_3_digitos")))


def public_summary(table: DataFrame) -> DataFrame:
    """Rows, customers and default percent per cohort."""
    return cohort_summary(table, "SAFRA", "NUM_CPF", "FPD")
