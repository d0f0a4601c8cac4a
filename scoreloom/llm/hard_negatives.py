"""Hard-negative mining by an STR-packed R-tree over inner products.

1. Rows take part when label and vector are there and all components finite; components become integers. Rows are dealt
   by a hash into blocks of some ``Mining.rows_at_once``, so equal vectors and frequent labels spread evenly.
2. A tree is built per block: rows are split by label, then sort-tile-recursively packed: sorted along one coordinate and
   cut into slabs, each slab along the next, the coordinates of the widest spread first. A leaf has rows of one label; a
   box keeps the least and greatest of every coordinate, a box above it those of its children.
3. For an anchor, a box gives an interval in each coordinate and so one of the inner product. A queue visits boxes by the
   upper end of theirs, best first. A box is left out when its interval misses the wanted scores or its upper end is
   strictly below the k-th best found; equal scores can still win by a smaller id, so they are visited.
4. The anchors, in blocks too, meet every block of rows: first for the positives (own label), then, with the positives'
   scores known, for the negatives of all positives in one descent. Each meeting gives at most k rows a search; a window
   picks the k best of all blocks, partly before the shuffle.

Ties of score go by smaller id; rows of the anchor's own id are never its positives. Rows with a null id take no part.
Vectors are compared with those of equal length; an anchor without positives gives no rows, nor does an empty table.
Repeated rows are each a row that can be
found; as anchors or positives equal rows count once. A score that does not fit 64 bits raises ValueError. Other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.session import written

EXACT = 2.0**53


@dataclass(frozen=True)
class Mining:
    """Negatives have a score of ``low`` to ``high`` percent of the positive's."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    rows_at_once: int = 8192
    anchors_at_once: int = 2048
    leaf: int = 32


class Tree:
    """An R-tree over integer vectors with labels; the boxes of all levels lie in one array, children next to each other."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int):
        spread = np.argsort(-(vectors.max(axis=0) - vectors.min(axis=0)), kind="stable")
        pieces = []
        for label in np.unique(labels):
            pieces += self._tiles(np.flatnonzero(labels == label), vectors, spread, leaf)
        order = np.concatenate(pieces)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        end = np.cumsum([len(p) for p in pieces])
        begin = end - [len(p) for p in pieces]
        low, high = (f.reduceat(self.vectors, begin, axis=0) for f in (np.minimum, np.maximum))
        first, own = self.labels[begin], self.labels[begin]
        #: Boxes from the root down; a leaf's children are rows, and every box knows its range of labels.
        levels = [(low, high, first, own, begin, end)]
        while len(levels[0][0]) > 1:
            low, high, first, last, *_ = levels[0]
            at = np.arange(0, len(low), leaf)
            levels.insert(0, (
                np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0),
                np.minimum.reduceat(first, at), np.maximum.reduceat(last, at), at, np.minimum(at + leaf, len(low)),
            ))
        sizes = [len(x[0]) for x in levels]
        shift = np.cumsum(sizes)  # where the boxes of the next level begin
        self.low, self.high, self.first, self.last = (np.concatenate([x[k] for x in levels]) for k in range(4))
        inner = [np.zeros_like(x[4]) + (s if i < len(levels) - 1 else 0) for i, (x, s) in enumerate(zip(levels, shift))]
        self.begin = np.concatenate([x[4] + s for x, s in zip(levels, inner)])
        self.end = np.concatenate([x[5] + s for x, s in zip(levels, inner)])
        self.leaves_from = sum(sizes[:-1])

    def _tiles(self, rows, vectors, spread, leaf, depth=0):
        if len(rows) <= leaf:
            return [rows]
        rows = rows[np.argsort(vectors[rows, spread[depth]], kind="stable")]
        if depth == len(spread) - 1 or len(rows) <= 2 * leaf:
            return [rows[i : i + leaf] for i in range(0, len(rows), leaf)]
        leaves = -(-len(rows) // leaf)
        slabs = max(2, round(leaves ** (1 / min(len(spread) - depth, max(1, int(np.log2(leaves)))))))
        size = leaf * -(-leaves // slabs)
        return [
            t for i in range(0, len(rows), size) for t in self._tiles(rows[i : i + size], vectors, spread, leaf, depth + 1)
        ]

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with any vector in each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class Search:
    """One of an anchor's searches: the ``k`` best scores of at least ``low`` and at most ``high``."""

    __slots__ = ("low", "high", "k", "best")

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k = low, high, k
        self.best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first

    def wants(self, least: int, most: int) -> bool:
        return most >= self.low and least <= self.high and (len(self.best) < self.k or most >= self.best[0][0])

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        low = max(self.low, self.best[0][0]) if len(self.best) == self.k else self.low
        for at in np.flatnonzero((scores >= low) & (scores <= self.high)):
            found = (int(scores[at]), -int(ids[at]))
            if len(self.best) < self.k:
                heapq.heappush(self.best, found)
            elif found > self.best[0]:
                heapq.heapreplace(self.best, found)


def descend(tree: Tree, anchor: np.ndarray, own: int, label: int, same: bool, searches: list[Search], least, most) -> None:
    """Fill ``searches`` with rows of the anchor's label (``same``; but none of its id) or of other labels."""
    queue = [(-most[0], 0)]
    while queue:
        bound, box = heapq.heappop(queue)
        if not any(s.wants(least[box], -bound) for s in searches):
            if all(len(s.best) == s.k and -bound < s.best[0][0] or -bound < s.low for s in searches):
                return  # no box that is left can do better
            continue
        begin, end = tree.begin[box], tree.end[box]
        if box >= tree.leaves_from:
            scores, ids = tree.vectors[begin:end] @ anchor, tree.ids[begin:end]
            if same:
                other = ids != own
                scores, ids = scores[other], ids[other]
            for s in searches:
                s.take(scores, ids)
            continue
        first, last = tree.first[begin:end], tree.last[begin:end]
        fits = (first <= label) & (last >= label) if same else (first != label) | (last != label)
        for child in (np.flatnonzero(fits) + begin).tolist():
            if any(s.wants(least[child], most[child]) for s in searches):
                heapq.heappush(queue, (-most[child], child))


def _vectors(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy().astype(np.int64)
    rows = flat.reshape(len(column), -1)
    if rows.size:
        largest = float(np.abs(rows).max()) ** 2 * rows.shape[1]
        if largest >= 2.0**63:
            raise ValueError("inner products of these vectors do not fit 64 bits")
        if largest < EXACT:
            return rows.astype(np.float64)  # exact, and much faster
    return rows


def _met(rows: DataFrame, anchors: DataFrame, parts: DataFrame, how: Mining, same: bool) -> DataFrame:
    """``NAMES``: what every block of rows has for every anchor of every block of anchors."""
    # every block of anchors goes to every block of rows of its length; parts has one row a vector length
    sent = anchors.join(F.broadcast(parts), "size").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = sent.drop("parts").join(rows.hint("merge"), ["size", "block"])

    def run(batches):
        held, tree = None, None
        for batch in batches:
            out = []
            for i in range(len(batch)):
                cell = {name: batch.column(name)[i] for name in batch.schema.names}
                place = (cell["size"].as_py(), cell["block"].as_py())
                if held != place:
                    held, block = place, cell["rows"].values
                    tree = Tree(
                        block.field("id").to_numpy(), block.field("label").to_numpy(), _vectors(block.field("vector")), how.leaf
                    )
                some = cell["anchors"].values
                vectors = _vectors(some.field("vector"))
                least, most = tree.intervals(vectors)
                askers, ids, labels, known = (some.field(x).to_pylist() for x in ("asker", "id", "label", "positives"))
                for k, (asker, anchor, label) in enumerate(zip(askers, ids, labels)):
                    if same:
                        searches = {(None, None): Search(-np.inf, np.inf, how.positives)}
                    else:
                        limits = {(p["id"], p["score"]): _window(p["score"], how) for p in known[k]}
                        searches = {p: Search(*w, how.negatives) for p, w in limits.items() if w[0] <= w[1]}
                    if searches:
                        descend(tree, vectors[k], anchor, label, same, list(searches.values()), least[k], most[k])
                    for (positive, score), search in searches.items():
                        out += [(asker, anchor, positive, score, s, -i) for s, i in search.best]
            columns = zip(*out) if out else [[]] * len(NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=NAMES)

    return pairs.mapInArrow(run, T.StructType([T.StructField(n, T.LongType()) for n in NAMES]))


#: ``asker`` tells apart anchors of one id; positive and its score are null while the positives are looked for.
NAMES = ["asker", "anchor", "positive", "positive_score", "score", "id"]


def _window(score: int, how: Mining) -> tuple[int, int]:
    """The whole scores s with low * score <= 100 * s <= high * score."""
    return -(-how.low * score // 100), how.high * score // 100


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each search, ranked; each task keeps its own k best before the shuffle."""
    order = Window.partitionBy(*NAMES[:4]).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    rows: DataFrame, is_anchor: Column, how: Mining = Mining(), key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for rows where ``is_anchor`` holds."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * how.scale).cast("long"))
    taking = written(
        rows.select(
            F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
            F.col(f"`{vector}`").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size("vector") > 0) & finite)
        .select("id", "label", whole.alias("vector"), "asks", F.size("vector").alias("size")),
        "vectors",
    )

    def parts(df: DataFrame, at_once: int) -> DataFrame:
        return df.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / at_once).alias("parts"))

    def blocks(df: DataFrame, at_once: int, cells: list[str], name: str) -> DataFrame:
        # rows are dealt by all they hold and a number of their own, so that repeats spread as well
        dealt = F.pmod(F.xxhash64(*cells[:3], F.monotonically_increasing_id()), F.col("parts"))
        return df.join(F.broadcast(parts(df, at_once)), "size").withColumn("block", dealt).groupBy("size", "block").agg(
            F.collect_list(F.struct(*cells)).alias(name)
        )

    cells = ["id", "label", "vector"]
    trees = written(blocks(taking, how.rows_at_once, cells, "rows"), "blocks")
    counts = parts(taking, how.rows_at_once)
    asking = written(taking.where("asks").drop("asks").distinct().withColumn("asker", F.xxhash64(*cells)), "anchors")

    def searched(anchors: DataFrame, same: bool, k: int) -> DataFrame:
        asked = blocks(anchors, how.anchors_at_once, [*cells, "asker", "positives"], "anchors").drop("block")
        return _best(_met(trees, written(asked, "anchor_blocks"), counts, how, same), k)

    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    near = searched(asking.withColumn("positives", none), True, how.positives)
    known = near.groupBy("asker", F.col("anchor").alias("id")).agg(F.collect_set(F.struct("id", "score")).alias("positives"))
    hard = searched(asking.join(known, ["asker", "id"]), False, how.negatives)
    return hard.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
