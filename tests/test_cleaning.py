import datetime as dt

import pytest
from pyspark.sql import functions as F

from scoreloom.functions import cleaning, scalars


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_stamps_and_sentinels(spark):
    texts = ["null", " NULL ", "", "-3", "-1", "xx", " 06OCT2023:00:00:00 "]
    found = values(spark, texts, lambda c: cleaning.parse_stamp(c, cleaning.EXTENDED_SENTINELS))
    assert found == [None] * 6 + [dt.datetime(2023, 10, 6)]


def test_days(spark):
    assert values(spark, ["xx", "31/02/2020", "29/02/2020"], cleaning.parse_day) == [None, None, dt.date(2020, 2, 29)]
    with pytest.raises(Exception):
        values(spark, ["xx"], lambda c: cleaning.parse_day(c, strict=True))


def test_clock(spark):
    assert values(spark, ["93015", "0", "null", "ab"], cleaning.clock_to_seconds) == [34215, 0, None, None]


def test_cohorts(spark):
    df = spark.createDataFrame([(202401,), (202412,)], "c int")
    found = df.select(cleaning.shift_cohort(F.col("c"), -1), cleaning.shift_cohort(F.col("c"), 13)).collect()
    assert [tuple(r) for r in found] == [(202312, 202502), (202411, 202601)]
    assert cleaning.shifted(202410, -12) == 202310 and cleaning.shifted(202503, -5) == 202410
    assert cleaning.shifted(202401, -1) == 202312 and cleaning.shifted(202412, 1) == 202501


def test_region(spark):
    texts = ["12", "399", "400", "659-1", "66000000", "CEP 700", "800", "999", None]
    found = values(spark, texts, scalars.postal_region)
    assert found == [None, "Sudeste", "Nordeste", "Nordeste", "Norte", "Centro-Oeste", "Sul", "Sul", None]


def test_age(spark):
    df = spark.createDataFrame([(202410, "1990-12-31"), (202410, "-1"), (202410, "1990"), (202410, None)], "c int, d string")
    assert [r[0] for r in df.select(scalars.age_in_cohort(F.col("c"), F.col("d"))).collect()] == [34, None, None, None]


def test_late_and_swap(spark):
    df = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (0, 0)], "b int, m int")
    found = [r[0] for r in df.select(scalars.swap_group(F.col("b"), F.col("m"))).collect()]
    assert found == ["swap_in", "swap_out", "mantido", "mantido"]
    late = spark.sql("SELECT timestamp'2024-01-02' AS p, CAST(NULL AS timestamp) AS d").select(
        scalars.late_flag(F.col("p"), F.col("d"))
    )
    assert late.first()[0] == 0


def test_hash_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = df.coalesce(1).select("id", scalars.unit_hash(F.col("id")).alias("u"))
    many = df.repartition(7).select("id", scalars.unit_hash(F.col("id")).alias("u"))
    a, b = ({r["id"]: r["u"] for r in x.collect()} for x in (one, many))
    assert a == b and all(0 <= u < 1 for u in a.values())
    assert 0.45 < sum(a.values()) / 1000 < 0.55
