"""Column cleaning: sentinels, tolerant parsing, cohort months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in the raw feeds, and the raw date formats.
BASIC_SENTINELS = ("null", "NULL", "")
EXTENDED_SENTINELS = ("null", "NULL", "", "-3", "-2", "-1")
STAMP_FORMAT = "ddMMMyyyy:HH:mm:ss"
DAY_FORMAT = "dd/MM/yyyy"


def null_sentinels(c: Column, sentinels: tuple[str, ...] = BASIC_SENTINELS) -> Column:
    """NULL where the trimmed text is a sentinel, else the text unchanged."""
    return F.when(F.trim(c).isin(*sentinels), F.lit(None)).otherwise(c)


def parse_stamp(c: Column, sentinels: tuple[str, ...] = BASIC_SENTINELS, fmt: str = STAMP_FORMAT) -> Column:
    """Text such as ``06OCT2023:00:00:00`` to TIMESTAMP; anything unreadable is NULL."""
    return F.try_to_timestamp(F.trim(null_sentinels(c, sentinels)), F.lit(fmt))


def parse_day(c: Column, fmt: str = DAY_FORMAT, strict: bool = False) -> Column:
    """Text such as ``31/12/2020`` to DATE; unreadable text is NULL, or an error if ``strict``."""
    text = F.trim(null_sentinels(c))
    return F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)


def clock_to_seconds(c: Column, sentinels: tuple[str, ...] = EXTENDED_SENTINELS) -> Column:
    """HHMMSS text without leading zeros to seconds of the day."""
    digits = F.lpad(F.trim(null_sentinels(c, sentinels)), 6, "0")
    hours, minutes, seconds = (F.substring(digits, at, 2).try_cast("int") for at in (1, 3, 5))
    return hours * 3600 + minutes * 60 + seconds


def cohort_of(moment: Column) -> Column:
    """Month of a date or timestamp as INT yyyyMM."""
    return (F.year(moment) * 100 + F.month(moment)).cast("int")


def cohort_start(cohort: Column) -> Column:
    """First day of a yyyyMM cohort."""
    return F.make_date(F.floor(cohort / 100).cast("int"), (cohort % 100).cast("int"), F.lit(1))


def shift_cohort(cohort: Column, months: Column | int) -> Column:
    """Cohort moved by a number of months."""
    return cohort_of(F.add_months(cohort_start(cohort), months))


def shifted(cohort: int, months: int) -> int:
    """The same on a plain integer, for building filters."""
    index = (cohort // 100) * 12 + cohort % 100 - 1 + months
    return index // 12 * 100 + index % 12 + 1


def month_index(cohort: Column) -> Column:
    """Months since year 0, so that differences of cohorts are differences of months."""
    return (F.floor(cohort / 100) * 12 + cohort % 100).cast("int")
