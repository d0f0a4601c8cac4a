"""Order statistics over whole tables without sorting them in one task.

The shared idea: reduce to one row per distinct value, cut the value axis into buckets, sum each
bucket, and turn bucket sums into offsets. Running sums are then computed bucket by bucket, in
parallel, and are exact: the cut points only decide how evenly work is spread, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor, isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.scalars import hash_text
from scoreloom.session import written

ROWS_PER_BUCKET = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def value_sums(df: DataFrame, value: str, sums: Mapping[str, Column], groups: Sequence[str] = ()) -> DataFrame:
    """One written row per group and distinct value with the given sums; NULL values are left out."""
    rows = df.where(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias(value))
    return written(rows.agg(*[F.sum(c).alias(n) for n, c in sums.items()]), "values")


def running_totals_of(
    reduced: DataFrame,
    value: str,
    names: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    only_buckets: Column | None = None,
) -> DataFrame:
    """Add the running total ``cum_*`` and group total ``all_*`` of each sum in ``value_sums``' result.

    ``only_buckets`` keeps the buckets meeting a condition on their sums before (``_off_*``), their own
    sums (``_in_*``) and ``all_*``; the others are then neither shuffled nor sorted.
    """
    groups, names = list(groups), list(names)
    buckets = max(ceil(reduced.count() / rows_per_bucket), 1)
    cuts: list[float] = []
    if buckets > 1:
        probabilities = [i / buckets for i in range(1, buckets)]
        found = reduced.agg(F.percentile_approx(value, probabilities, 10 * buckets)).first()[0]
        cuts = sorted({v for v in found if isfinite(v)})
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol=value, outputCol="_b", handleInvalid="keep").transform(reduced)
    else:
        bucketed = reduced.withColumn("_b", F.lit(0.0))

    # One row per group and bucket is left for the offsets, so these windows stay small.
    order = F.desc if descending else F.asc
    before = Window.partitionBy(*groups).orderBy(order("_b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = (
        bucketed.groupBy(*groups, "_b")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(
            *groups,
            "_b",
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
            *[F.col(n).alias(f"_in_{n}") for n in names],
            *[F.sum(n).over(whole).alias(f"all_{n}") for n in names],
        )
    )
    if only_buckets is not None:
        offsets = offsets.where(only_buckets)
    inside = Window.partitionBy(*groups, "_b").orderBy(order(value)).rowsBetween(Window.unboundedPreceding, 0)
    joined = null_safe_join(bucketed, offsets, [*groups, "_b"])
    return joined.select(
        *groups,
        value,
        *names,
        *[(F.col(f"_off_{n}") + F.sum(n).over(inside)).alias(f"cum_{n}") for n in names],
        *[f"all_{n}" for n in names],
    )


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    groups: Sequence[str] = (),
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Per group and distinct value: each sum, its running total ``cum_*`` and group total ``all_*``.

    Equal values are one row, so ties are peers. The running totals follow the value downwards if
    ``descending``.
    """
    reduced = value_sums(df, value, sums, groups)
    return running_totals_of(reduced, value, list(sums), groups, descending, rows_per_bucket)


def _holds_rank(probabilities: Sequence[float], before: Column, own: Column) -> Column:
    """Whether any rank needed for the quantiles lies among ``own`` rows following ``before`` rows."""
    last, hit = F.col("all__n") - 1, F.lit(False)
    for p in probabilities:
        for rank in (F.floor(last * p), F.ceil(last * p)):
            hit = hit | ((rank >= before) & (rank < before + own))
    return hit


def quantiles_of(
    reduced: DataFrame,
    value: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact linearly interpolated quantiles from ``value_sums`` with counts ``_n``, as an array.

    Only the buckets that hold a needed rank are sorted.
    """
    ranked = running_totals_of(
        reduced, value, ["_n"], groups, rows_per_bucket=rows_per_bucket,
        only_buckets=_holds_rank(probabilities, F.col("_off__n"), F.col("_in__n")),
    )
    last = F.col("all__n") - 1

    def at(rank: Column) -> Column:
        hit = (rank < F.col("cum__n")) & (rank >= F.col("cum__n") - F.col("_n"))
        return F.max(F.when(hit, F.col(value)))

    picks = [F.max("all__n").alias("n")]
    for i, p in enumerate(probabilities):
        picks += [at(F.floor(last * p)).alias(f"_lo{i}"), at(F.ceil(last * p)).alias(f"_hi{i}")]
    found = ranked.groupBy(*groups).agg(*picks)

    def interpolate(i: int, p: float) -> Column:
        position = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return low + (high - low) * (position - F.floor(position))

    return found.select(
        *groups, "n", F.array(*[interpolate(i, p) for i, p in enumerate(probabilities)]).alias("quantiles")
    )


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, with the number of values ``n``."""
    reduced = value_sums(df, value, {"_n": F.lit(1)}, groups)
    return quantiles_of(reduced, value, probabilities, groups, rows_per_bucket)


def long_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``variable``, ``value`` as DOUBLE, plus the kept columns."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "variable", "value")


# Rank error of the sketch, and how far fences reach to either side of a wanted rank, as shares of all rows.
SKETCH_ACCURACY = 5_000
FENCE_SHARE = 0.001
# Columns with fewer values than this need no fences; columns are sketched in groups to bound memory.
FEW_VALUES = 20_000
SKETCHED_AT_ONCE = 200


def _fences(wide: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, tuple[int, list]]:
    """Per column: number of values, and disjoint intervals that should hold every wanted rank."""
    around = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-FENCE_SHARE, FENCE_SHARE)]
    found: dict[str, tuple[int, list]] = {}
    for start in range(0, len(columns), SKETCHED_AT_ONCE):
        part = columns[start : start + SKETCHED_AT_ONCE]
        row = wide.agg(
            *[F.count(c).alias(f"n__{c}") for c in part],
            *[F.percentile_approx(c, around, SKETCH_ACCURACY).alias(f"q__{c}") for c in part],
        ).first()
        for c in part:
            n, q = row[f"n__{c}"], row[f"q__{c}"]
            if n == 0:
                continue
            if n < FEW_VALUES:
                found[c] = (n, [(float("-inf"), float("inf"))])
                continue
            merged: list[list[float]] = []
            for low, high in sorted(zip(q[::2], q[1::2])):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            found[c] = (n, [tuple(m) for m in merged])
    return found


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Exact linearly interpolated quantiles of many columns without shuffling all their values.

    A first pass sketches each column and puts narrow fences around the wanted ranks. A second pass
    keeps the values inside fences and only counts those between them, which combines map-side. Ranks
    are then looked up among the few values kept. The counts prove whether each rank really lies in
    its fence; a column where one does not is ranked in full. Columns x probabilities numbers reach
    the driver.
    """
    columns = list(columns)
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    fences = _fences(wide, columns, probabilities)
    if not fences:
        return {}
    cells = []
    for c, (_, intervals) in fences.items():
        x, passed, inside = F.col(c), F.lit(0), F.lit(False)
        for low, high in intervals:
            passed = passed + F.when(x > high, 1).otherwise(0)
            inside = inside | ((x >= low) & (x <= high))
        cells.append(
            F.struct(
                F.lit(c).alias("variable"), F.when(x.isNotNull(), passed).alias("segment"), F.when(inside, x).alias("value")
            )
        )
    reduced = written(
        wide.select(F.inline(F.array(*cells))).where(F.col("segment").isNotNull())
        .groupBy("variable", "segment", "value").agg(F.count("*").alias("_n")),
        "fenced",
    )

    sizes: dict[tuple, int] = {}
    for r in reduced.groupBy("variable", "segment", F.col("value").isNotNull().alias("inside")).agg(
        F.sum("_n").alias("n")
    ).collect():
        sizes[r["variable"], r["segment"], r["inside"]] = r["n"]

    wanted, missed = [], []
    for c, (n, intervals) in fences.items():
        starts, before = [], 0
        for k in range(len(intervals)):
            before += sizes.get((c, k, False), 0)
            starts.append((before, before + sizes.get((c, k, True), 0)))
            before = starts[-1][1]
        for rank in sorted({r for p in probabilities for r in (floor((n - 1) * p), ceil((n - 1) * p))}):
            k = next((k for k, (first, end) in enumerate(starts) if first <= rank < end), None)
            if k is None:
                missed.append(c)
                break
            wanted.append((c, k, rank - starts[k][0], rank))
    wanted = [w for w in wanted if w[0] not in missed]

    at: dict[tuple[str, int], float] = {}
    if wanted:
        kept = reduced.where(F.col("value").isNotNull())
        ranked = running_totals_of(kept, "value", ["_n"], ["variable", "segment"])
        # One row per column and wanted rank, as many as the numbers asked for.
        places = df.sparkSession.createDataFrame(wanted, "variable string, segment int, place bigint, rank bigint")
        hit = (F.col("place") < F.col("cum__n")) & (F.col("place") >= F.col("cum__n") - F.col("_n"))
        for r in ranked.join(F.broadcast(places), ["variable", "segment"]).where(hit).collect():
            at[r["variable"], r["rank"]] = r["value"]

    out: dict[str, list[float]] = {}
    for c, (n, _) in fences.items():
        if c in missed:
            continue
        out[c] = []
        for p in probabilities:
            position = (n - 1) * float(p)
            low, high = at[c, floor(position)], at[c, ceil(position)]
            out[c].append(low + (high - low) * (position - floor(position)))
    if missed:
        found = quantiles(long_numeric(df, missed), "value", probabilities, ["variable"])
        out |= {r["variable"]: list(r["quantiles"]) for r in found.collect()}
    return out


def shuffled_rank(
    df: DataFrame, keys: Sequence[str], groups: Sequence[str] = (), seed: int = 42, name: str = "rank"
) -> DataFrame:
    """Number rows 0, 1, 2, ... per group in a repeatable random order given by their key's hash.

    Rows are numbered inside 4,096 hash ranges and shifted by the size of the ranges before, so a
    group of any size is spread over the cluster. ``keys`` should identify a row.
    """
    groups = list(groups)
    hashed = df.withColumn("_h", hash_text(*[F.col(k) for k in keys], seed=seed)).withColumn(
        "_b", F.substring("_h", 1, 3)
    )
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*groups, "_b")
        .agg(F.count("*").alias("_n"))
        .select(*groups, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    inside = Window.partitionBy(*groups, "_b").orderBy("_h", *keys)
    joined = null_safe_join(hashed, offsets, [*groups, "_b"])
    return joined.withColumn(name, F.col("_off") + F.row_number().over(inside) - 1).drop("_h", "_b", "_off")
