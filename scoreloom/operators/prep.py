"""Feature preparation: fitted on one table, applied to any.

Fitted values are small plain Python objects (a number or a few per column). Only per-category
tables, which may be long, stay DataFrames.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.scalars import hash_text, remap, round_to_category
from scoreloom.operators.ordered import column_quantiles, null_safe_join
from scoreloom.operators.profile import (
    category_columns,
    drop_high_null_columns,
    long_text,
    metadata_profile,
    numeric_columns,
    text_columns,
)
from scoreloom.operators.sampling import downsample
from scoreloom.session import written

# The number that stands for "missing", and the text for an empty category.
MISSING_NUMBER = -1
UNKNOWN_TEXT = "VERIFICAR"
FLOAT_LIMIT = 3.4028234663852886e38


# --- types and domains ----------------------------------------------------------------------------

def narrow_types(df: DataFrame) -> DataFrame:
    """Store whole numbers as INT and fractions as FLOAT where the observed range allows, in one pass."""
    kinds = {
        f.name: "int" if isinstance(f.dataType, T.IntegralType) else "float"
        for f in df.schema.fields
        if isinstance(f.dataType, (T.IntegralType, T.DoubleType, T.FloatType))
    }
    if not kinds:
        return df
    row = df.agg(
        *[F.min(c).alias(f"lo__{c}") for c in kinds], *[F.max(c).alias(f"hi__{c}") for c in kinds]
    ).first()
    limits = {"int": (-(2**31), 2**31 - 1), "float": (-FLOAT_LIMIT, FLOAT_LIMIT)}
    wide = {"int": "bigint", "float": "double"}
    casts = {}
    for c, kind in kinds.items():
        lo, hi = row[f"lo__{c}"], row[f"hi__{c}"]
        fits = lo is None or (limits[kind][0] <= lo and hi <= limits[kind][1])
        casts[c] = F.col(c).cast(kind if fits else wide[kind])
    return df.withColumns(casts)


def as_category(df: DataFrame, column: str) -> Column:
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    return round_to_category(F.col(column)) if numeric else F.col(column)


def domain_table(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Every occurring category and its new domain ``TFB_<column>``."""
    values = df.select(as_category(df, column).alias(column)).distinct()
    return values.withColumn(f"TFB_{column}", remap(F.col(column), mapping))


def apply_domain(df: DataFrame, domains: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by ``TFB_<column>``; categories unknown to ``domains`` keep their own name."""
    name = f"TFB_{column}"
    keyed = df.withColumn(column, as_category(df, column))
    joined = null_safe_join(keyed, written(domains.dropna(subset=[column]), "domains"), [column], "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.col(column))).drop(column)


# --- missing values -------------------------------------------------------------------------------

def _without_marker(c: Column, marker: float | None) -> Column:
    return c if marker is None else F.when(c != marker, c)


@dataclass(frozen=True)
class Fill:
    """Replacement of missing values per column; ``marker`` counts as missing in numeric columns."""

    numbers: dict[str, float] = field(default_factory=dict)
    texts: dict[str, str] = field(default_factory=dict)
    marker: float | None = None
    unknown_text: str = UNKNOWN_TEXT

    def apply(self, df: DataFrame, unknown_texts: bool = False) -> DataFrame:
        """Fill the fitted columns; ``unknown_texts`` gives other text columns the unknown text."""
        out = {
            c: F.coalesce(_without_marker(F.col(c), self.marker).cast("double"), F.lit(v))
            for c, v in self.numbers.items()
            if c in df.columns
        }
        texts = dict(self.texts)
        if unknown_texts:
            texts = {c: self.unknown_text for c in text_columns(df)} | texts
        out |= {c: F.coalesce(F.col(c), F.lit(v)) for c, v in texts.items() if c in df.columns}
        return df.withColumns(out) if out else df


def fit_means(df: DataFrame, columns: Sequence[str] | None = None, marker: float | None = MISSING_NUMBER) -> Fill:
    """Means of the numeric columns, computed without the marker. Pass columns without the target."""
    columns = numeric_columns(df) if columns is None else list(columns)
    row = df.agg(*[F.avg(_without_marker(F.col(c), marker).cast("double")).alias(c) for c in columns]).first()
    return Fill(numbers={c: row[c] for c in columns if row[c] is not None}, marker=marker)


def fit_medians(df: DataFrame, columns: Sequence[str] | None = None, marker: float | None = None) -> Fill:
    columns = numeric_columns(df) if columns is None else list(columns)
    rows = df.select(*[_without_marker(F.col(c), marker).alias(c) for c in columns])
    found = column_quantiles(rows, columns, [0.5])
    return Fill(numbers={c: q[0] for c, q in found.items()}, marker=marker)


def fit_modes(df: DataFrame, columns: Sequence[str] | None = None) -> Fill:
    """Most frequent text per column, the smallest on ties, the unknown text if there is none."""
    columns = text_columns(df) if columns is None else list(columns)
    if not columns:
        return Fill()
    counts = long_text(df, columns).where(F.col("value").isNotNull()).groupBy("variable", "value").count()
    top = counts.groupBy("variable").agg(F.min(F.struct(-F.col("count"), F.col("value"))).alias("top"))
    found = {r["variable"]: r["top"]["value"] for r in top.collect()}
    return Fill(texts={c: found.get(c, UNKNOWN_TEXT) for c in columns})


# --- encoders -------------------------------------------------------------------------------------

def route_by_cardinality(df: DataFrame, limit: int = 20, leave_out: Sequence[str] = ()) -> dict[str, str]:
    """Text columns below ``limit`` distinct values to "onehot", others to "target", the rest "numeric"."""
    low = set(category_columns(df, limit - 1, leave_out=leave_out))
    route = {}
    for f in df.schema.fields:
        if f.name in leave_out:
            continue
        if isinstance(f.dataType, T.StringType):
            route[f.name] = "onehot" if f.name in low else "target"
        elif isinstance(f.dataType, T.NumericType):
            route[f.name] = "numeric"
    return route


@dataclass(frozen=True)
class OneHot:
    """0/1 columns ``<column>_<value>``; unknown values give zeros everywhere.

    Dots and backticks, which column references would misread, become underscores in names.
    """

    categories: dict[str, list[str]]
    drop_first: bool = False

    def flags(self) -> list[tuple[str, str, str]]:
        """Column, value and output name, in output order."""
        return [
            (c, v, f"{c}_{v}".replace(".", "_").replace("`", "_"))
            for c, vs in self.categories.items()
            for v in vs[self.drop_first:]
        ]

    def apply(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c not in self.categories]
        return df.select(*kept, *[F.when(F.col(c) == v, 1).otherwise(0).alias(n) for c, v, n in self.flags()])


def one_hot_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The ones of a one-hot encoding as rows ``keys, feature``, for columns of any number of categories."""
    rows = long_text(df, columns, keys).where(F.col("value").isNotNull())
    return rows.select(*keys, F.concat_ws("_", "variable", "value").alias("feature"))


def fit_one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> OneHot:
    """Sorted categories of each column. Each becomes a column of the result, so this is for the columns that
    ``route_by_cardinality`` sends here; ``one_hot_long`` holds any number."""
    if not columns:
        return OneHot({}, drop_first)
    values = long_text(df, columns).where(F.col("value").isNotNull()).distinct()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in values.orderBy("variable", "value").collect():
        found[r["variable"]].append(r["value"])
    return OneHot(found, drop_first)


def ordinal_encode(df: DataFrame, orders: Mapping[str, Sequence[str]]) -> DataFrame:
    """Position of each value in the given order; a value outside it is an error."""
    out = {}
    for c, order in orders.items():
        positions = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(float(i)))])
        text = F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
        unknown = F.raise_error(F.concat(F.lit(f"unknown value in {c}: "), text)).cast("double")
        out[c] = F.coalesce(F.try_element_at(positions, F.col(c)), unknown)
    return df.withColumns(out)


@dataclass(frozen=True)
class TargetEncoding:
    """Smoothed mean target per category, one table ``category, encoded`` per column."""

    tables: dict[str, DataFrame]
    overall: float

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace each column by its encoding; categories without one get the overall mean."""
        out = df
        for c, found in self.tables.items():
            keyed = found.select(F.col("category").alias(c), F.col("encoded").alias("_encoded"))
            joined = null_safe_join(out, keyed, [c], "left")
            out = joined.withColumn(c, F.coalesce("_encoded", F.lit(self.overall))).drop("_encoded")
        return out


def _shrunk(n: Column, s: Column, q: Column, mean: Column, variance: Column) -> Column:
    """Mean of a category pulled to the overall mean by its own variance over its size: the weight is
    n·V / (n·V + v) with overall variance V and category variance v."""
    within = F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))
    weight = F.when(variance > 0, n * variance / (n * variance + within)).otherwise(1.0)
    return weight * s / n + (1 - weight) * mean


def _category_sums(df: DataFrame, column: str, target: str, *more: str) -> DataFrame:
    y = F.col(target).cast("double")
    return df.groupBy(F.col(column).cast("string").alias("category"), *more).agg(
        F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")
    )


def fit_target_encoding(df: DataFrame, columns: Sequence[str], target: str) -> TargetEncoding:
    y = F.col(target).cast("double")
    row = df.agg(F.avg(y).alias("mean"), F.var_pop(y).alias("variance")).first()
    mean, variance = F.lit(row["mean"]), F.lit(row["variance"])
    tables = {}
    for c in columns:
        sums = _category_sums(df, c, target)
        encoded = _shrunk(F.col("n"), F.col("s"), F.col("q"), mean, variance)
        tables[c] = written(sums.select("category", encoded.alias("encoded")), "encoding")
    return TargetEncoding(tables, row["mean"])


def cross_fit_target_encode(
    df: DataFrame, column: str, target: str, keys: Sequence[str], folds: int = 5, seed: int = 42
) -> DataFrame:
    """Encode training rows from the other folds only, so that no row sees its own target.

    Sums per category and fold are subtracted from the category's totals; rows are joined to the
    result by category and fold, which also spreads a hot category over the folds.
    """
    fold = F.conv(F.substring(hash_text(*[F.col(k) for k in keys], seed=seed), 1, 8), 16, 10).cast("bigint") % folds
    rows = df.withColumn("_fold", fold.cast("int"))
    per_fold = written(_category_sums(rows, column, target, "_fold"), "fold-sums")
    totals = per_fold.groupBy("category").agg(*[F.sum(x).alias(f"_{x}") for x in "nsq"])
    overall = {
        r["_fold"]: r
        for r in per_fold.groupBy("_fold").agg(*[F.sum(x).alias(x) for x in "nsq"]).collect()
    }
    n_all, s_all, q_all = (sum(r[x] for r in overall.values()) for x in "nsq")

    mean, variance = F.lit(None).cast("double"), F.lit(None).cast("double")
    for i, r in overall.items():
        n, s, q = n_all - r["n"], s_all - r["s"], q_all - r["q"]
        m = s / n if n else None
        mean = F.when(F.col("_fold") == i, F.lit(m)).otherwise(mean)
        variance = F.when(F.col("_fold") == i, F.lit(q / n - m * m if n else None)).otherwise(variance)

    others = null_safe_join(per_fold, totals, ["category"]).select(
        "category", "_fold", *[(F.col(f"_{x}") - F.col(x)).alias(x) for x in "nsq"]
    )
    encoded = F.when(F.col("n") > 0, _shrunk(F.col("n"), F.col("s"), F.col("q"), mean, variance)).otherwise(mean)
    table = written(
        others.select(F.col("category").alias(column), "_fold", encoded.alias(f"{column}_encoded")), "encoding"
    )
    return null_safe_join(rows, table, [column, "_fold"], "left").drop("_fold")


# --- scalers --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Scale:
    """(x - center) / width per column; a zero width divides by one."""

    centers: dict[str, float]
    widths: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c) - self.centers[c]) / (self.widths[c] or 1.0) for c in self.centers if c in df.columns
        })


def fit_standard_scale(df: DataFrame, columns: Sequence[str]) -> Scale:
    """Mean and population standard deviation."""
    row = df.agg(
        *[F.avg(c).alias(f"m__{c}") for c in columns], *[F.stddev_pop(c).alias(f"s__{c}") for c in columns]
    ).first()
    return Scale(
        {c: float(row[f"m__{c}"]) for c in columns if row[f"m__{c}"] is not None},
        {c: float(row[f"s__{c}"]) for c in columns if row[f"s__{c}"] is not None},
    )


def fit_robust_scale(df: DataFrame, columns: Sequence[str]) -> Scale:
    """Median and interquartile range."""
    found = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    return Scale({c: q[1] for c, q in found.items()}, {c: q[2] - q[0] for c, q in found.items()})


# --- the whole preparation ------------------------------------------------------------------------

@dataclass(frozen=True)
class Prep:
    """Missing values, encoders and scaler of every column group, applied by column name."""

    medians: Fill
    modes: Fill
    one_hot: OneHot
    target_encoding: TargetEncoding
    scale: Scale
    passthrough: tuple[str, ...] = ()
    #: The columns that the fit has seen, with their types; ``apply`` asks for them.
    expected: dict[str, str] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*[name for _, _, name in self.one_hot.flags()], *self.target_encoding.tables, *self.scale.centers]

    def check(self, df: DataFrame) -> None:
        """An error that names the columns which are absent or of another kind than at the fit."""
        have = {f.name: _kind(f.dataType) for f in df.schema.fields}
        absent = [c for c in self.expected if c not in have]
        other = [f"{c} ({have[c]}, not {k})" for c, k in self.expected.items() if c in have and have[c] != k]
        if absent or other:
            raise ValueError(f"columns absent: {absent}; of another kind: {other}")

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The passed-through columns, those of ``keep`` as they came, and the features."""
        self.check(df)
        kept = [c for c in dict.fromkeys([*self.passthrough, *keep]) if c in df.columns]
        held = df.withColumns({f"_keep_{c}": F.col(f"`{c}`") for c in kept}) if kept else df
        out = self.modes.apply(self.medians.apply(held))
        out = self.scale.apply(self.target_encoding.apply(self.one_hot.apply(out)))
        features = [c for c in self.features if c not in kept]
        return out.select(*[F.col(f"`_keep_{c}`").alias(c) for c in kept], *[F.col(f"`{c}`") for c in features])

    def save(self, path: str) -> None:
        """Store under ``path``: numbers and lists as one JSON text, all category tables as one parquet table."""
        values = {
            "version": VERSION, "medians": asdict(self.medians), "modes": asdict(self.modes), "one_hot": asdict(self.one_hot),
            "scale": asdict(self.scale), "overall": self.target_encoding.overall, "encoded": list(self.target_encoding.tables),
            "passthrough": list(self.passthrough), "expected": self.expected,
        }
        spark = SparkSession.active()
        tables = spark.createDataFrame([], "column string, category string, encoded double")
        for c, found in self.target_encoding.tables.items():
            tables = tables.unionByName(found.select(F.lit(c).alias("column"), "category", "encoded"))
        tables.write.parquet(f"{path}/categories")
        # the values come last: what they are missing from is no stored preparation
        spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.text(f"{path}/values")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Prep:
        """What ``save`` stored, in any session that reaches ``path``."""
        values = json.loads(spark.read.text(f"{path}/values", wholetext=True).first()[0])
        if values["version"] != VERSION:
            raise ValueError(f"{path} holds a preparation of version {values['version']}; this is version {VERSION}")
        tables = spark.read.schema("column string, category string, encoded double").parquet(f"{path}/categories")
        encodings = {c: tables.where(F.col("column") == c).select("category", "encoded") for c in values["encoded"]}
        return Prep(
            Fill(**values["medians"]), Fill(**values["modes"]), OneHot(**values["one_hot"]),
            TargetEncoding(encodings, values["overall"]), Scale(**values["scale"]), tuple(values["passthrough"]),
            values["expected"],
        )


#: Raised when the stored form changes.
VERSION = 1


def _kind(data_type: T.DataType) -> str:
    return "number" if isinstance(data_type, T.NumericType) else data_type.simpleString()


def fit_prep(df: DataFrame, target: str, ids: Sequence[str] = (), limit: int = 20) -> Prep:
    """Median and robust scale for numbers; most frequent value and one-hot or target encoding for text."""
    leave_out = [target, *ids]
    route = route_by_cardinality(df, limit, leave_out)
    by = {kind: [c for c, k in route.items() if k == kind] for kind in ("onehot", "target", "numeric")}
    medians = fit_medians(df, by["numeric"])
    modes = fit_modes(df, by["onehot"] + by["target"])
    filled = modes.apply(medians.apply(df))
    return Prep(
        medians,
        modes,
        fit_one_hot(filled, by["onehot"]),
        fit_target_encoding(filled, by["target"], target),
        fit_robust_scale(filled, [c for c in by["numeric"] if c in medians.numbers]),
        (*ids, target),
        {c: _kind(df.schema[c].dataType) for c in by["onehot"] + by["target"] + [c for c in by["numeric"] if c in medians.numbers]},
    )


# --- selection ------------------------------------------------------------------------------------

def low_variance(df: DataFrame, columns: Sequence[str], least: float = 0.1) -> list[str]:
    """Columns whose sample variance lies below ``least``."""
    row = df.agg(*[F.var_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] < least]


#: Pairs of columns in one aggregate, six sums each.
PAIRS_AT_ONCE = 400


def correlations(df: DataFrame, columns: Sequence[str], pairs_at_once: int = PAIRS_AT_ONCE) -> dict[tuple[str, str], float | None]:
    """Pearson's correlation of each pair of columns over the rows that have both, in order of ``columns``.

    Sums and products are taken from values less their column's mean, so that large values lose no digits. Each pair
    is a few sums of one aggregate, and pairs come in blocks; nothing of the size of all pairs is built per row. A pair
    without two rows in common, or with one side constant there, has None. NaN counts as absent.
    """
    columns = list(columns)
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns}
    rows = df.select(*[v.alias(c) for c, v in values.items()])
    means = rows.agg(*[F.avg(f"`{c}`").alias(c) for c in columns]).first() if columns else {}
    x = {c: F.col(f"`{c}`") - F.lit(means[c] or 0.0) for c in columns}
    pairs = [(a, b) for j, b in enumerate(columns) for a in columns[:j]]
    found: dict[tuple[str, str], float | None] = {}
    for at in range(0, len(pairs), pairs_at_once):
        part, sums = pairs[at : at + pairs_at_once], []
        for k, (a, b) in enumerate(part):
            both = F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull()
            terms = {"n": F.lit(1), "a": x[a], "b": x[b], "aa": x[a] * x[a], "bb": x[b] * x[b], "ab": x[a] * x[b]}
            sums += [F.sum(F.when(both, v)).alias(f"{name}{k}") for name, v in terms.items()]
        row = rows.agg(*sums).first()
        for k, pair in enumerate(part):
            n, a, b, aa, bb, ab = (row[f"{name}{k}"] for name in ("n", "a", "b", "aa", "bb", "ab"))
            wide = (aa - a * a / n) * (bb - b * b / n) if n and n > 1 else 0.0
            # what rounding leaves of the spread of a constant side is no spread
            flat = not n or aa - a * a / n <= 1e-12 * aa or bb - b * b / n <= 1e-12 * bb
            found[pair] = None if flat or wide <= 0 else max(-1.0, min(1.0, (ab - a * b / n) / wide**0.5))
    return found


def correlated(df: DataFrame, columns: Sequence[str], most: float = 0.5) -> list[str]:
    """Columns correlated with an earlier column by more than ``most`` in absolute value, over rows that have both."""
    found = correlations(df, columns)
    return [c for j, c in enumerate(columns) if any(abs(found[a, c] or 0.0) > most for a in columns[:j])]


@dataclass(frozen=True)
class AutoPrep:
    """Result of ``auto_preprocess``."""

    table: DataFrame
    dropped: list[str]
    metadata: DataFrame


def auto_preprocess(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    most_correlation: float = 0.5,
    most_null_pct: float = 70,
    least_variance: float | None = 0.1,
    sample: int | None = None,
) -> AutoPrep:
    """Null filter, imputation, target encoding, then low-variance and correlated columns dropped.

    The table holds every row of ``df``. ``sample`` bounds the rows that values are fitted on; all rows count
    by default, as each fit is an aggregate.
    """
    rows = df if sample is None else written(downsample(df, sample, keys), "sample")
    features = rows.drop(target, *keys)
    metadata = metadata_profile(features)
    _, sparse = drop_high_null_columns(features, most_null_pct / 100)
    rows = rows.drop(*sparse)
    numbers = [c for c in numeric_columns(rows, [target, *keys])]
    texts = text_columns(rows, [target, *keys])
    modes, means = fit_modes(rows, texts), fit_means(rows, numbers, marker=None)
    encoding = fit_target_encoding(modes.apply(means.apply(rows)), texts, target) if texts else None

    def prepared(part: DataFrame) -> DataFrame:
        part = modes.apply(means.apply(part))
        return encoding.apply(part) if encoding else part

    encoded = prepared(rows)
    left = numbers + texts
    flat = low_variance(encoded, left, least_variance) if least_variance is not None else []
    left = [c for c in left if c not in flat]
    twins = correlated(encoded, left, most_correlation) if len(left) > 1 else []
    return AutoPrep(prepared(df.drop(*sparse)).drop(*flat, *twins), flat + twins, metadata)
