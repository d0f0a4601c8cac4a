"""Near copies by b-bit MinHash.

1. Signatures. The distinct word shingles of each text are hashed; ``HASHES`` minima are taken, of which a few bits
   each are kept and packed. Bands of whole minima give the keys of the candidate search. A digest of the whole set
   joins texts with equal sets into one class, so copies, however many, are one row from here on.
2. Candidates. Classes that share a band key are compared by counting equal lanes of their packed signatures; the count
   is corrected for lanes that agree by chance. Pairs whose estimate is over five standard errors below the threshold
   are dropped.
3. Confirmation. The remaining pairs are confirmed on the full sets, made again from both texts.
4. Components of the confirmed links, by alternating star joins.

Large buckets are not searched pair by pair. Round one compares the classes of a bucket with its first class only, which
resolves most groups of copies of one text. Round two deals what is left of buckets that still hold several components
into random blocks of about ``BLOCK`` classes and compares within blocks; buckets of that size are then done. Round
three takes the larger buckets that still hold several components, and compares every class outside a bucket's largest
component with all its classes of other components: block against block in numpy, on signatures of ``LONG_HASHES``
minima made for these classes alone, of which only the pairs near the threshold leave the task, each from the first band
that both share. A pair is left out only when both ends are already in one component, so components are what all pairs
would give, but for pairs that share no band: at the threshold of 0.85 with 25 bands of 5 rows, fewer than one in a
million.

Texts without words have no shingles and link with nothing; null is empty. Texts with fewer words than a shingle are one
shingle. Rows of equal id are one node and keep one row each in ``linked``; ``near_copies_removed`` takes only rows of
equal id and text for repeats, and leaves one of them. Rows with a null id link with nothing and stay. Columns beside those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.components import components
from scoreloom.llm.words import FOLDED, U64, map_texts, mix, parts, run_hashes, runs, windows
from scoreloom.session import written

BITS = 4
HASHES = 128
LANES = 64 // BITS
WORDS = HASHES // LANES  # 64-bit words of a packed signature
LOW = int("1" * LANES, 16)  # the lowest bit of each lane
MARGIN = 0.2
LONG_HASHES = 2048
LONG_MARGIN = 0.045
BLOCK = 8
LONG_BLOCK = 256

_random = np.random.Generator(np.random.PCG64(9_176_263))
MULTIPLY = _random.integers(0, 2**31, LONG_HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
FLIP = _random.integers(0, 2**32, LONG_HASHES, dtype=np.uint32)


@dataclass(frozen=True)
class Likeness:
    """Links are pairs with 100 * intersection >= percent * union of their sets of ``words``-word shingles."""

    words: int = 5
    percent: int = 80
    bands: int = 25
    rows: int = 5


def shingles(data: np.ndarray, bounds: np.ndarray, words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    start, end = runs(data, bounds)
    hashes, at = run_hashes(data, start, end, FOLDED), np.searchsorted(start, bounds)
    rolled, out = windows(hashes, words), []
    for i, j in zip(at[:-1], at[1:]):
        if j - i >= words:
            out.append(np.unique(rolled[i : j - words + 1]))
        else:
            out.append(windows(hashes[i:j], j - i) if j > i else hashes[:0])
    return out


def minima(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """The smallest of each hash function over each set that isn't empty: one row per set, one column per function."""
    filled = [s for s in sets if len(s)]
    if not filled:
        return np.zeros((0, hashes), np.uint32)
    flat = (np.concatenate(filled) >> U64(32)).astype(np.uint32)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in filled])[:-1]])
    out = np.empty((len(filled), hashes), np.uint32)
    for k in range(hashes):
        mixed = (flat ^ FLIP[k]) * MULTIPLY[k]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x85EBCA6B)
        out[:, k] = np.minimum.reduceat(mixed, begin)
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of minima, packed into 64-bit words."""
    lanes = (least & np.uint32((1 << BITS) - 1)).astype(U64).reshape(len(least), -1, LANES)
    return (lanes << (np.arange(LANES, dtype=U64) * U64(BITS))).sum(axis=2, dtype=U64)


def _lists(flat: np.ndarray, have: np.ndarray) -> pa.Array:
    """A list column: a row of the matrix ``flat`` where ``have`` holds, else an empty list."""
    lengths = np.where(have, flat.shape[1], 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(flat).reshape(-1).view(np.int64)))


def measure(like: Likeness):
    def of(data: np.ndarray, bounds: np.ndarray) -> list:
        sets = shingles(data, bounds, like.words)
        sizes = np.array([len(s) for s in sets], np.int64)
        least, have = minima(sets), sizes > 0
        keys = np.empty((len(least), like.bands), U64)
        for b in range(like.bands):
            key = np.full(len(least), b + 1, U64)
            for k in range(b * like.rows, (b + 1) * like.rows):
                key = mix(key * U64(0x2545F4914F6CDD1D) + least[:, k].astype(U64))
            keys[:, b] = key
        digest = np.zeros((2, len(sets)), U64)
        for i, s in enumerate(sets):
            if len(s):
                digest[0, i] = mix(s).sum(dtype=U64)
                digest[1, i] = mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64) + U64(len(s))
        return [sizes, digest[0].view(np.int64), digest[1].view(np.int64), _lists(packed(least), have), _lists(keys, have)]

    return of


FIELDS = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("h1", T.LongType()),
    T.StructField("h2", T.LongType()),
    T.StructField("packed", T.ArrayType(T.LongType())),
    T.StructField("bands", T.ArrayType(T.LongType())),
]


def estimate(a: str, b: str):
    """The similarity of two packed signatures: the share of equal lanes, corrected for agreement by chance."""
    differing = F.lit(0)
    for w in range(WORDS):
        x = F.col(a)[w].bitwiseXOR(F.col(b)[w])
        for shift in (1, 2)[: BITS.bit_length() - 1]:
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(LOW)))
    chance = 2.0**-BITS
    return ((1 - differing / F.lit(float(HASHES))) - chance) / (1 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are alike enough. ``texts``: ``(id, text)``, one row per id."""
    ends = pairs.select(F.col("a").alias("id")).distinct().unionByName(pairs.select(F.col("b").alias("id")).distinct())
    needed = written(_of(texts, ends), "pair_texts")
    both = pairs.join(needed.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
        needed.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"
    )

    def alike(batches):
        for batch in batches:
            keep = []
            left, right = parts(batch.column(2)), parts(batch.column(3))
            one = (s for _, _, data, bounds in left for s in shingles(data, bounds, like.words))
            two = (s for _, _, data, bounds in right for s in shingles(data, bounds, like.words))
            for x, y in zip(one, two):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= like.percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = texts.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return both.select("a", "b", "ta", "tb").mapInArrow(alike, schema)


def _of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids. The ids grow with the corpus, so they are not broadcast even where they are few."""
    return texts.join(ids.distinct().hint("merge"), "id", "left_semi")


def linked(docs: DataFrame, like: Likeness = Likeness(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id among all rows that links reach; ``kept`` says whether it is the row's own.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = written(map_texts(rows, measure(like), FIELDS, carry=["id"], out="m").select("id", "m.*"), "signatures")

    # a class: the texts with one set of shingles, named by their smallest id; their signatures are the same
    leaders = written(
        signed.where("n_shingles > 0 AND id IS NOT NULL").groupBy("h1", "h2").agg(
            F.min("id").alias("class"), F.first("packed").alias("packed"), F.first("bands").alias("bands")
        ),
        "classes",
    )

    in_band = leaders.select("class", F.posexplode("bands").alias("number", "band"))
    shared = in_band.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("first")).where("n > 1")
    members = written(in_band.join(shared.select("band", "first"), "band"), "members")
    signature = leaders.select("class", F.col("packed").alias("lanes"))
    candidates = members.select(F.col("class").alias("id"))
    texts = written(_of(rows, candidates).dropDuplicates(["id"]), "candidate_texts")

    def checked(pairs):
        near = pairs.join(signature.select(F.col("class").alias("a"), F.col("lanes").alias("pa")), "a").join(
            signature.select(F.col("class").alias("b"), F.col("lanes").alias("pb")), "b"
        )
        near = near.where(estimate("pa", "pb") >= like.percent / 100 - MARGIN).select("a", "b")
        return confirmed(written(near, "near"), texts, like)

    def joined_to(found, links):
        known = found.select(F.col("class").alias("a"), F.col("component").alias("b"))
        return components(known.unionByName(links)).withColumnRenamed("node", "class")

    others = members.where("class != first")
    links = checked(others.select(F.col("first").alias("a"), F.col("class").alias("b")).distinct())
    found = components(links).withColumnRenamed("node", "class")

    rest = written(_unresolved(others.select("band", "number", "class"), found), "unresolved")
    if rest.take(1):
        block = F.pmod(F.xxhash64("class", "band"), F.ceil(F.col("held") / BLOCK))
        dealt = rest.withColumn("block", block).select("band", "block", "class", "component")
        found = joined_to(found, checked(
            dealt.select("band", "block", F.col("class").alias("a"), F.col("component").alias("ca"))
            .join(dealt.select("band", "block", F.col("class").alias("b"), F.col("component").alias("cb")), ["band", "block"])
            .where("ca != cb AND a < b").select("a", "b").distinct()
        ))
        large = rest.where(F.col("held") > BLOCK).select("band", "number", "class")
        rest = written(_unresolved(large, found), "unresolved")
        if rest.take(1):
            near = written(_across_blocks(rest, leaders, texts, like), "near")
            found = joined_to(found, confirmed(near, texts, like))

    named = leaders.select("h1", "h2", "class").join(found, "class", "left").select(
        "h1", "h2", F.coalesce("component", "class").alias("component_id")
    )
    smallest = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return signed.select("id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        F.col("id").alias(key), "n_shingles", smallest.alias("component_id"),
        F.col("id").eqNullSafe(smallest).alias("kept"),
    )


def _unresolved(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that still hold several components, with their component and the number ``held``.

    ``main`` marks the members of a bucket's largest component.
    """
    grouped = members.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    counts = grouped.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("band").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("held"), F.max(F.struct("n", "component"))["component"].alias("most")
    ).where("parts > 1")
    return grouped.join(largest, "band").select(
        "band", "number", "class", "component", "held", (F.col("component") == F.col("most")).alias("main")
    )


def _across_blocks(rest: DataFrame, leaders: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """The pairs ``(a, b)`` of different components in one bucket that may be alike by their long signatures."""

    def long_signature(data, bounds):
        sets = shingles(data, bounds, like.words)
        rows, have = iter(packed(minima(sets, LONG_HASHES))), [len(s) > 0 for s in sets]
        return [pa.array([next(rows).tobytes() if h else None for h in have], pa.binary())]

    needed = rest.select(F.col("class").alias("id")).distinct()
    signed = map_texts(
        _of(texts, needed), long_signature, [T.StructField("lanes", T.BinaryType())], carry=["id"], out="m"
    ).select(F.col("id").alias("class"), "m.lanes")
    signed = written(signed.join(leaders.select("class", "bands"), "class"), "long_signatures")
    row = F.struct("class", F.xxhash64("component").alias("part"), F.col("main").cast("long").alias("main"), "lanes", "bands")
    blocks = written(
        rest.join(signed, "class")
        .withColumn("block", F.pmod(F.xxhash64("class", "band"), F.ceil(F.col("held") / LONG_BLOCK)))
        .groupBy("band", "number", "block", "main").agg(F.collect_list(row).alias("rows")),
        "blocks",
    )
    left = blocks.where("NOT main").select("band", "number", F.col("rows").alias("x"))
    right = blocks.select("band", F.col("rows").alias("y"))
    least = like.percent / 100 - LONG_MARGIN
    chance = 2.0**-BITS
    most_differing = int(LONG_HASHES * (1 - (least * (1 - chance) + chance)))
    low = U64(LOW)

    def columns(rows: pa.ListScalar):
        rows = rows.values
        part = rows.field("part").to_numpy(zero_copy_only=False)
        lanes = np.frombuffer(b"".join(rows.field("lanes").to_pylist()), U64).reshape(len(rows), -1)
        bands = np.array(rows.field("bands").to_pylist(), np.int64)
        return rows.field("class"), part, rows.field("main").to_numpy(zero_copy_only=False), lanes, bands

    def compare(batches):
        for batch in batches:
            for number, x, y in zip(batch.column("number").to_pylist(), batch.column("x"), batch.column("y")):
                ids, part, _, lanes, bands = columns(x)
                others, other_part, other_main, other_lanes, other_bands = columns(y)
                take, other_take = [], []
                for i in range(len(ids)):
                    # each of a pair's two orders is met unless one end is in the largest component: keep one
                    able = (other_part != part[i]) & ((other_main == 1) | (other_part > part[i]))
                    at = np.flatnonzero(able)
                    differing = other_lanes[at] ^ lanes[i]
                    differing |= differing >> U64(1)
                    differing |= differing >> U64(2)
                    at = at[np.bitwise_count(differing & low).sum(axis=1) <= most_differing]
                    at = at[(other_bands[at] == bands[i]).argmax(axis=1) == number]  # the first band both share
                    take += [i] * len(at)
                    other_take += at.tolist()
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(take, pa.int64())), others.take(pa.array(other_take, pa.int64()))], names=["a", "b"]
                )

    kind = texts.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return left.join(right, "band").select("number", "x", "y").mapInArrow(compare, schema)


def near_copies_removed(
    docs: DataFrame, like: Likeness = Likeness(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near copies, with the columns of ``docs``.

    Rows are told apart by id and text: of rows that are equal in both one stays, and rows of one id with different
    texts are linked and kept each by its own text.
    """
    node = "node"
    while node in docs.columns or f"{node}number" in docs.columns:
        node += "_"
    own = F.struct(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("sign"))
    rows = docs.withColumn(node, F.when(F.col(f"`{key}`").isNotNull(), own))
    linking = linked(rows.select(node, F.col(f"`{text}`").alias("text")), like, node)
    stays = linking.where("kept").select(node).distinct()
    # the texts are shuffled once: the join leaves them dealt and sorted by node, and repeats stand side by side
    number = F.row_number().over(Window.partitionBy(node).orderBy(node))
    named = rows.where(F.col(node).isNotNull()).join(stays.hint("merge"), node, "left_semi").withColumn(f"{node}number", number)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return named.where(F.col(f"{node}number") == 1).select(*columns).unionByName(docs.where(F.col(f"`{key}`").isNull()))
