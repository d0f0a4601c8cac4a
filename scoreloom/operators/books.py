"""Feature books: one wide row per customer and reference cohort.

Work is done in two aggregations. Rows are first reduced to one per customer and month (with the
plain and per-indicator sums, counts and extremes), which combines map-side and leaves at most
13 rows per customer whatever the feed's density. Windows relative to the customer's last month and
all window aggregates are then computed from those few rows, which are gathered per customer.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.cleaning import month_index, shifted
from scoreloom.session import written

# Window names with their months, and the name part of every aggregate.
WINDOWS = {"U1M": 1, "U3M": 3, "U6M": 6, "U9M": 9, "U12M": 12}
AGGREGATE_NAMES = {"avg": "VL_MED", "max": "VL_MAX", "min": "VL_MIN", "sum": "VL_TOT", "count": "VL_QT"}
RATIO_NAME = "RAZ_MED"


@dataclass(frozen=True)
class Indicator:
    column: str
    alias: str
    values: tuple


def _literal(value: str | int) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class BookSpec:
    """What a book computes. ``anchor`` says where windows end: at each customer's last active
    month in the slice ("customer") or at the reference cohort ("cohort"). Both ends count, so
    window UnM spans n+1 months."""

    name: str
    suffix: str
    values: tuple[str, ...]
    aggregates: tuple[str, ...]
    indicators: tuple[Indicator, ...] = ()
    windows: dict[str, int] = field(default_factory=lambda: dict(WINDOWS))
    key: str = "NUM_CPF"
    cohort: str = "SAFRA"
    anchor: str = "customer"
    keep_customers_without_features: bool = True

    def conditions(self) -> list[tuple[str, str | None]]:
        """Name part and row condition of the plain aggregates and of each indicator value."""
        out: list[tuple[str, str | None]] = [("", None)]
        for ind in self.indicators:
            out += [(f"{ind.alias}_{v}_", f"`{ind.column}` = {_literal(v)}") for v in ind.values]
        return out

    def ratio_pairs(self) -> list[tuple[str, str]]:
        order = list(self.windows)
        return list(zip(order[:-1], order[1:]))

    def layer1_name(self, aggregate: str, window: str, part: str, value: str) -> str:
        return f"{AGGREGATE_NAMES[aggregate]}_{window}_{part}{value}_{self.suffix}"

    def ratio_name(self, num: str, den: str, part: str, value: str) -> str:
        """Every occurrence of the suffix is removed from the middle part, as downstream names expect."""
        middle = f"{part}{value}_{self.suffix}".replace(f"_{self.suffix}", "")
        return f"{RATIO_NAME}_{num}_{den}_{middle}_{self.suffix}"


def window_flags(df: DataFrame, spec: BookSpec, reference: int | None = None) -> DataFrame:
    """Add a 1/0 column per window to the rows themselves. The last month per customer is an
    aggregate joined back, so no customer's rows are collected in one place."""
    if spec.anchor == "cohort":
        return df.select("*", *_flags(spec, F.lit(reference)))
    last = df.groupBy(spec.key).agg(F.max(spec.cohort).alias("_last"))
    return df.join(last, spec.key).select("*", *_flags(spec, F.col("_last"))).drop("_last")


def _flags(spec: BookSpec, last: Column) -> list[Column]:
    age = month_index(last) - month_index(F.col(spec.cohort))
    return [F.when((age >= 0) & (age <= n), 1).otherwise(0).alias(w) for w, n in spec.windows.items()]


def _parts(aggregates: Iterable[str]) -> list[str]:
    needed = set(aggregates)
    if "avg" in needed:
        needed |= {"sum", "count"}
    return [a for a in ("sum", "count", "max", "min") if a in needed]


def in_hundredths(df: DataFrame, spec: BookSpec) -> DataFrame:
    """Amounts of up to 12 digits, two of them decimals, as whole hundredths: their sums take no decimal arithmetic.

    They hold 9 million rows of the largest amount for one customer; beyond that ANSI mode raises an error.
    """
    small = {v for v in spec.values if _is_amount(df.schema[v].dataType)}
    return df.select(*[F.expr(f"CAST(`{c}` * 100 AS bigint) AS `{c}`" if c in small else f"`{c}`") for c in df.columns])


def _is_amount(value_type: T.DataType) -> bool:
    return isinstance(value_type, T.DecimalType) and value_type.scale == 2 and value_type.precision <= 12


def customer_months(df: DataFrame, spec: BookSpec) -> DataFrame:
    """One row per customer and month with ``<part>__<condition><value>`` columns.

    Books have up to thousands of generated columns; as SQL text each is one call to build.
    """
    out = []
    for label, condition in spec.conditions():
        for value in spec.values:
            c = f"`{value}`" if condition is None else f"CASE WHEN {condition} THEN `{value}` END"
            out += [F.expr(f"{p}({c}) AS `{p}__{label}{value}`") for p in _parts(spec.aggregates)]
    return df.groupBy(spec.key, spec.cohort).agg(*out)


def window_features(
    months: DataFrame, spec: BookSpec, types: dict[str, T.DataType], reference: int, only_active: bool = False,
    ratios: bool = False,
) -> DataFrame:
    """Layer 1 from customer-months: every aggregate over every window, plain and per indicator
    value, rounded to 2. ``only_active`` keeps the customers seen in the reference cohort; ``ratios``
    adds the columns of ``ratio_features``.

    The windows are nested: a customer's months are added up once, newest first, and a window is the total at its oldest
    month. The parts are elements of arrays, one array for each kind of values, so expressions stay few and small: the
    code of one for each feature takes every task longer to compile than its rows take to run.
    """
    cells, parts = _cells(months, spec, types), _parts(spec.aggregates)
    arrays = []
    for k, kind in enumerate(cells):
        of_cell = (", ".join(f"`{p}__{label}{value}` AS {p}" for p in parts) for label, value in kind)
        arrays.append(F.expr(f"array({', '.join(f'struct({c})' for c in of_cell)}) AS _c{k}"))
    # At most one row per customer and month is left here, so these arrays are small.
    gathered = months.select(spec.key, F.col(spec.cohort).alias("_cohort"), *arrays).groupBy(spec.key).agg(
        F.sort_array(F.collect_list(F.struct("_cohort", *[f"_c{k}" for k in range(len(cells))])), asc=False).alias("_months")
    )
    last = F.get("_months", F.lit(0))["_cohort"]
    if only_active:
        gathered = gathered.where(last == reference)
    end = month_index(F.lit(reference) if spec.anchor == "cohort" else last)
    totals = gathered.select(
        spec.key, F.transform("_months", lambda m: F.struct((end - month_index(m["_cohort"])).alias("_age"), m.alias("_parts"))).alias("_months"),
        *[_nothing(months, kind, parts, k).alias(f"_t{k}") for k, kind in enumerate(cells)],
    )
    reached, before = -1, None
    for window, n in sorted(spec.windows.items(), key=lambda w: w[1]):
        added = F.filter("_months", lambda m: (m["_age"] > reached) & (m["_age"] <= n))
        done = [c for c in totals.columns if c != "_added"]
        totals = totals.select(*done, added.alias("_added")).withColumns(
            {f"_t{k}": F.aggregate("_added", F.col(f"_t{k}"), _adding(totals, k)) for k in range(len(cells))}
        )
        layer1 = {
            f"_l{k}_{window}": F.expr(f"transform(_t{k}, c -> {_layer1(months, spec, types, kind)})") for k, kind in enumerate(cells)
        }
        if before:  # without a further month the features are those of the window before
            layer1 = {
                c: F.when(F.size("_added") > 0, feature).otherwise(F.col(f"{c.partition('_' + window)[0]}_{before}"))
                for c, feature in layer1.items()
            }
        totals = totals.withColumns(layer1)
        reached, before = n, window

    place = {cell: (k, i) for k, kind in enumerate(cells) for i, cell in enumerate(kind)}
    out = []
    for window in spec.windows:
        for label, _ in spec.conditions():
            for value in spec.values:
                k, i = place[label, value]
                for aggregate in spec.aggregates:
                    feature = f"get(`_l{k}_{window}`, {i}).{aggregate}"
                    feature = f"coalesce({feature}, 0L)" if aggregate == "count" else feature
                    out.append(F.expr(f"{feature} AS `{spec.layer1_name(aggregate, window, label, value)}`"))
    pairs = spec.ratio_pairs() if ratios else []
    for num, den in pairs:
        for label, _ in spec.conditions():
            for value in spec.values:
                k, i = place[label, value]
                out.append(F.expr(f"get(`_r{k}_{num}_{den}`, {i}) AS `{spec.ratio_name(num, den, label, value)}`"))
    quotients = [
        _quotients(totals, f"_l{k}_{num}", f"_l{k}_{den}").alias(f"_r{k}_{num}_{den}") for num, den in pairs for k in range(len(cells))
    ]
    return totals.select("*", *quotients).select(spec.key, *out)


def _cells(months: DataFrame, spec: BookSpec, types: dict[str, T.DataType]) -> list[list[tuple[str, str]]]:
    """Name part of the condition and value of every cell, by the kind of the value."""
    kinds: dict[tuple, list[tuple[str, str]]] = {}
    for label, _ in spec.conditions():
        for value in spec.values:
            kinds.setdefault((types[value], _held_in_hundredths(months, spec, value, types[value])), []).append((label, value))
    return list(kinds.values())


def _nothing(months: DataFrame, kind: list[tuple[str, str]], parts: list[str], k: int) -> Column:
    """The totals of no month: an array of cells without values."""
    value = "".join(kind[0])
    sums = months.select(*[(F.max if p in ("max", "min") else F.sum)(f"`{p}__{value}`").alias(p) for p in parts]).schema
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in sums])
    return F.array_repeat(empty, len(kind))


def _adding(totals: DataFrame, k: int):
    """Totals and one month's parts, cell by cell; a part without a value changes nothing."""
    fields = totals.schema[f"_t{k}"].dataType.elementType.fields

    def added(a: Column, b: Column) -> Column:
        both = {
            "sum": lambda p: F.coalesce(a[p] + b[p], a[p], b[p]), "count": lambda p: F.coalesce(a[p] + b[p], a[p], b[p]),
            "max": lambda p: F.greatest(a[p], b[p]), "min": lambda p: F.least(a[p], b[p]),
        }
        return F.struct(*[both[f.name](f.name).cast(f.dataType).alias(f.name) for f in fields])

    return lambda acc, m: F.zip_with(acc, m["_parts"][f"_c{k}"], added)


def _quotients(totals: DataFrame, num: str, den: str) -> Column:
    """The ratios of two windows; many are of equal amounts, which need no division."""
    plain = f"zip_with(`{num}`, `{den}`, (a, b) -> {_ratio('a.avg', 'b.avg')})"
    quotient = totals.select(F.expr(plain).alias("q")).schema["q"].dataType.elementType
    if not isinstance(quotient, T.DecimalType):
        return F.expr(plain)
    one = f"CASE WHEN a.avg = b.avg THEN cast(1 AS {quotient.simpleString()}) ELSE a.avg / b.avg END"
    return F.expr(f"zip_with(`{num}`, `{den}`, (a, b) -> CASE WHEN b.avg <> 0 THEN {one} END)")


def _layer1(months: DataFrame, spec: BookSpec, types: dict[str, T.DataType], kind: list[tuple[str, str]]) -> str:
    value = kind[0][1]
    combined = _combined_hundredths if _held_in_hundredths(months, spec, value, types[value]) else _combined
    part = {p: f"c.{p}" for p in _parts(spec.aggregates)}
    features = ", ".join(f"{combined(a, part, types[value])} AS {a}" for a in spec.aggregates)
    some = "c.count > 0" if "count" in part else f"c.{next(iter(part))} IS NOT NULL"
    return f"CASE WHEN {some} THEN struct({features}) END"


def _combined(aggregate: str, part: dict[str, str], value_type: T.DataType) -> str:
    """The window aggregate from the window's totals."""
    if aggregate == "count":
        return f"coalesce({part['count']}, 0L)"
    if aggregate in ("max", "min", "sum"):
        return f"round({part[aggregate]}, 2)"
    average = f"{part['sum']} / nullif({part['count']}, 0L)"
    if isinstance(value_type, T.DecimalType):
        # The built-in decimal average keeps four more digits before it is rounded to two.
        average = f"cast({average} AS decimal({value_type.precision + 4},{value_type.scale + 4}))"
    return f"round({average}, 2)"


def _held_in_hundredths(months: DataFrame, spec: BookSpec, value: str, value_type: T.DataType) -> bool:
    """Whether customer-months hold an amount in hundredths, as ``in_hundredths`` gives it, or as a decimal."""
    held = {months.schema[f"{p}__{value}"].dataType for p in _parts(spec.aggregates) if p != "count"}
    return _is_amount(value_type) and held == {T.LongType()}


def _combined_hundredths(aggregate: str, part: dict[str, str], value_type: T.DecimalType) -> str:
    """As ``_combined`` gives it, value and type, from totals in whole hundredths."""
    digits = value_type.precision
    if aggregate == "count":
        return f"coalesce({part['count']}, 0L)"
    if aggregate == "sum":
        return f"cast({part['sum']} * 0.01BD AS decimal({digits + 21},2))"
    if aggregate in ("max", "min"):
        return f"cast({part[aggregate]} * 0.01BD AS decimal({digits + 1},2))"
    # An average is rounded half away from zero to six digits and then to two: its rest goes up from 0.4999 5 on.
    rest = f"20000 * ({part['sum']} % {part['count']})"
    up = f"CASE WHEN {rest} >= 9999 * {part['count']} THEN 1 WHEN {rest} <= -9999 * {part['count']} THEN -1 ELSE 0 END"
    whole = f"CASE WHEN {part['count']} > 0 THEN {part['sum']} div {part['count']} + {up} END"
    return f"cast({whole} * 0.01BD AS decimal({digits + 1},2))"


def ratio_features(df: DataFrame, spec: BookSpec) -> DataFrame:
    """Layer 2: average of a window over the average of the next longer one, NULL over zero."""
    out = []
    for num, den in spec.ratio_pairs():
        for label, _ in spec.conditions():
            for value in spec.values:
                top, bottom = (f"`{spec.layer1_name('avg', w, label, value)}`" for w in (num, den))
                name = spec.ratio_name(num, den, label, value)
                out.append(F.expr(f"{_ratio(top, bottom)} AS `{name}`"))
    return df.select("*", *out)


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} <> 0 THEN {top} / {bottom} END"


def cohort_slice(df: DataFrame, reference: int, spec: BookSpec, months: int = 12) -> DataFrame:
    """Rows of the reference cohort and the ``months`` before; a plain range on the partition column."""
    return df.where(F.col(spec.cohort).between(shifted(reference, -months), reference))


def cohort_keys(df: DataFrame, reference: int, spec: BookSpec) -> DataFrame:
    """Customers with any row in the reference cohort."""
    return df.where(F.col(spec.cohort) == reference).select(spec.key).distinct()


def with_reference_population(features: DataFrame, keys: DataFrame, spec: BookSpec) -> DataFrame:
    """Every customer of the reference cohort, with NULL features where there are none."""
    return keys.join(features, spec.key, "left")


def book_rows(feed: DataFrame, spec: BookSpec, row_filter: Column | None = None) -> DataFrame:
    """The feed's rows and columns a book needs."""
    rows = feed if row_filter is None else feed.where(row_filter)
    needed = [spec.key, spec.cohort, *spec.values, *[i.column for i in spec.indicators]]
    return rows.select(*dict.fromkeys(needed))


def _book(
    months: DataFrame, types: dict, reference: int, spec: BookSpec, run_stamp: int, population: DataFrame | None
) -> DataFrame:
    in_slice = cohort_slice(months, reference, spec)
    # Customers of the reference cohort are known from the months themselves, without a second scan.
    only_active = spec.keep_customers_without_features and population is None
    features = window_features(in_slice, spec, types, reference, only_active, ratios=True)
    if population is not None:
        features = with_reference_population(features, cohort_keys(population, reference, spec), spec)
    return features.select(
        "*", F.lit(reference).alias(spec.cohort), F.lit(run_stamp).cast("bigint").alias("DATPROC")
    )


def build_book(
    feed: DataFrame,
    reference: int,
    spec: BookSpec,
    run_stamp: int,
    row_filter: Column | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """The whole book of one reference cohort.

    The book's customers are those of the reference cohort, or of ``population`` in that cohort if
    given (then also customers without features); a spec without
    ``keep_customers_without_features`` takes every customer of the 13 months.
    """
    rows = cohort_slice(book_rows(feed, spec, row_filter), reference, spec)
    types = {f.name: f.dataType for f in rows.schema.fields}
    return _book(customer_months(in_hundredths(rows, spec), spec), types, reference, spec, run_stamp, population)


def backfill(
    feed: DataFrame,
    references: Sequence[int],
    spec: BookSpec,
    run_stamp: int,
    row_filter: Column | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """The book for several reference cohorts, one below the other.

    Their slices overlap, so the feed is read and reduced to customer-months once for all of them.
    """
    rows = book_rows(feed, spec, row_filter)
    rows = rows.where(F.col(spec.cohort).between(shifted(min(references), -12), max(references)))
    types = {f.name: f.dataType for f in rows.schema.fields}
    months = written(customer_months(in_hundredths(rows, spec), spec), "months")
    out = None
    for reference in references:
        book = _book(months, types, reference, spec, run_stamp, population)
        out = book if out is None else out.unionByName(book)
    return out


# --- books that grow --------------------------------------------------------------------------------

@dataclass(frozen=True)
class StoredMonths:
    """Customer-months kept under ``path``, a partition per cohort, so that a new month does not read the old ones.

    ``grow`` reduces the cohorts of the feed that are new or have rows of a later stamp than was seen, and replaces
    just their partitions; a book then reads its 13 partitions. Watermarks and value types are written last: a run that
    fails before them is repeated by the next one.
    """

    path: str
    spec: BookSpec
    row_filter: Column | None = None

    def _marks(self, spark: SparkSession) -> dict:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/marks")
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return {"watermarks": {}, "types": {}}
        latest = spark.read.parquet(f"{self.path}/marks").orderBy(F.desc("run")).first()
        return json.loads(latest["value"])

    def changed(self, feed: DataFrame, stamp: str) -> dict[int, int]:
        """Cohorts of the feed with rows newer than their watermark, and their newest stamp; one row per cohort is read."""
        known = self._marks(feed.sparkSession)["watermarks"]
        newest = feed.groupBy(self.spec.cohort).agg(F.max(stamp).alias("stamp")).collect()
        return {
            r[0]: r["stamp"] for r in newest
            if r[0] is not None and r["stamp"] is not None and r["stamp"] > known.get(str(r[0]), r["stamp"] - 1)
        }

    def grow(self, feed: DataFrame, stamp: str, cohorts: Sequence[int] | None = None) -> list[int]:
        """Bring the store up to the feed and return the cohorts that were reduced.

        ``cohorts`` names those that have changed, where the caller knows; only they are scanned then. ``stamp`` is a
        whole number that grows from load to load.
        """
        spark, marks = feed.sparkSession, self._marks(feed.sparkSession)
        part = feed if cohorts is None else feed.where(F.col(self.spec.cohort).isin(list(cohorts)))
        stamps = self.changed(part, stamp)
        if not stamps:
            return []
        rows = book_rows(feed.where(F.col(self.spec.cohort).isin(list(stamps))), self.spec, self.row_filter)
        months = customer_months(rows, self.spec)
        months.write.partitionBy(self.spec.cohort).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/months")
        marks = {
            "watermarks": marks["watermarks"] | {str(c): s for c, s in stamps.items()},
            "types": {f.name: f.dataType.jsonValue() for f in rows.schema.fields},
            "months": months.schema.jsonValue(),
        }
        run = spark.createDataFrame([(time.time_ns(), json.dumps(marks))], "run bigint, value string")
        run.coalesce(1).write.mode("append").parquet(f"{self.path}/marks")
        return sorted(stamps)

    def months(self, spark: SparkSession) -> DataFrame:
        """All stored customer-months; the cohort is the partition column."""
        schema = T.StructType.fromJson(self._marks(spark)["months"])
        return spark.read.schema(schema).parquet(f"{self.path}/months")

    def book(self, spark: SparkSession, reference: int, run_stamp: int, population: DataFrame | None = None) -> DataFrame:
        """The book of one reference cohort from 13 stored partitions, as ``build_book`` gives it from the feed."""
        types = {c: T._parse_datatype_json_value(t) for c, t in self._marks(spark)["types"].items()}
        return _book(self.months(spark), types, reference, self.spec, run_stamp, population)
