"""Shards by fixed virtual slots.

A record's id is hashed into one of thousands of slots, for good. Bytes and rows are summed per slot, and a small map
says which shard has each slot. The map is versioned and stored; to rebalance, or to add shards, a few slots of the
map are edited and only their records move. What reaches the driver is one row per slot, a fixed number.

``balanced`` gives the slots, largest first, to the shard with the fewest bytes, so shards differ by about the
smallest slot. ``grown`` moves slots into new shards only. ``edited`` moves slots from the fullest to the emptiest
shard until they are within a tolerance.

A record's place within its shard is gapless from 0: the rows of the shard's earlier slots, plus its rank in its own
slot. So numbering sorts thousands of small groups, never a whole shard. Ids are keys: repeated rows share a slot.
Null texts have no bytes, null ids one slot of their own. An empty table gives an empty result; columns beside those
named are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import written

SLOTS = 8192
Sizes = dict[int, tuple[int, int]]  # slot: bytes, rows


@dataclass(frozen=True)
class SlotMap:
    version: int
    shards: int
    shard_of: tuple[int, ...]

    def loads(self, sizes: Sizes) -> list[int]:
        loads = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            loads[shard] += sizes.get(slot, (0, 0))[0]
        return loads

    def save(self, spark: SparkSession, folder: str) -> None:
        """Add this version to the maps stored in ``folder``."""
        rows = [(self.version, self.shards, slot, shard) for slot, shard in enumerate(self.shard_of)]
        spark.createDataFrame(rows, "version int, shards int, slot int, shard int").coalesce(1).write.mode("append").parquet(folder)

    @staticmethod
    def load(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
        """The stored version, the latest by default."""
        stored = spark.read.parquet(folder)
        if version is None:
            version = stored.agg(F.max("version")).first()[0]
        rows = stored.where(F.col("version") == version).orderBy("slot").collect()
        return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame) -> Sizes:
    """Bytes and rows by slot of a table with ``virtual_slot`` and ``size``."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()
    return {r[0]: (r[1], r[2]) for r in sums}


def _bytes(sizes: Sizes, slot: int) -> int:
    return sizes.get(slot, (0, 0))[0]


def balanced(sizes: Sizes, shards: int, slots: int = SLOTS) -> SlotMap:
    loads, shard_of = [(0, s) for s in range(shards)], [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-_bytes(sizes, s), s)):
        load, shard = heapq.heappop(loads)
        shard_of[slot] = shard
        heapq.heappush(loads, (load + _bytes(sizes, slot), shard))
    return SlotMap(0, shards, tuple(shard_of))


def grown(old: SlotMap, sizes: Sizes, shards: int) -> SlotMap:
    """The next version with more shards; slots move into the new shards only."""
    shard_of, loads = list(old.shard_of), old.loads(sizes) + [0] * (shards - old.shards)
    target = sum(loads) / shards
    for slot in sorted(range(len(shard_of)), key=lambda s: (-_bytes(sizes, s), s)):
        new, size = min(range(old.shards, shards), key=lambda s: (loads[s], s), default=None), _bytes(sizes, slot)
        if new is not None and loads[shard_of[slot]] - size >= target - size / 2 and loads[new] + size <= target + size / 2:
            loads[shard_of[slot]] -= size
            loads[new] += size
            shard_of[slot] = new
    return SlotMap(old.version + 1, shards, tuple(shard_of))


def edited(old: SlotMap, sizes: Sizes, tolerance: float = 0.01) -> SlotMap:
    """The next version after sizes have changed: as few slots move as bring all shards near the mean."""
    shard_of, loads = list(old.shard_of), old.loads(sizes)
    mean, by_shard = sum(loads) / old.shards, [[] for _ in loads]
    for slot, shard in enumerate(shard_of):
        by_shard[shard].append(slot)
    while True:
        full, empty = max(range(old.shards), key=lambda s: loads[s]), min(range(old.shards), key=lambda s: loads[s])
        gap = loads[full] - loads[empty]
        movable = [s for s in by_shard[full] if 0 < _bytes(sizes, s) < gap]
        if not movable or loads[full] <= mean * (1 + tolerance) and loads[empty] >= mean * (1 - tolerance):
            return SlotMap(old.version + 1, old.shards, tuple(shard_of))
        slot = min(movable, key=lambda s: abs(gap / 2 - _bytes(sizes, s)))
        by_shard[full].remove(slot)
        by_shard[empty].append(slot)
        loads[full] -= _bytes(sizes, slot)
        loads[empty] += _bytes(sizes, slot)
        shard_of[slot] = empty


def records(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Key, size, CRC and slot of every row, written once: the text is read a single time."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return written(
        docs.select(
            F.col(f"`{key}`").alias(key),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            slot_of(F.col(f"`{key}`"), slots).alias("virtual_slot"),
        ),
        "records",
    )


def placed(rows: DataFrame, slot_map: SlotMap, sizes: Sizes, key: str = "doc_id") -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the place within the shard."""
    at, before = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.shard_of):
        before.append((slot, shard, at[shard]))
        at[shard] += sizes.get(slot, (0, 0))[1]
    # one row of 16 bytes for each of the fixed number of slots
    table = F.broadcast(rows.sparkSession.createDataFrame(before, "virtual_slot int, shard int, before long"))
    rank = "row_number() OVER (PARTITION BY virtual_slot ORDER BY `%s`, text_crc32, size)" % key
    return (
        rows.withColumn("rank", F.expr(rank))
        .join(table, "virtual_slot")
        .withColumn("slot", F.col("before") + F.col("rank") - 1)
        .drop("before", "rank")
    )
