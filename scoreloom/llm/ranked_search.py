"""Ranked lexical search, term at a time with a limit on accumulators.

1. Queries are taken in blocks of ``Search.queries_at_once``; the terms of a block are a bounded vocabulary that goes to
   the tasks.
2. Index. One scan finds, per document, its number of terms and how often it holds each term of the vocabulary; terms
   are matched by a hash and confirmed byte by byte. The index is written once; document counts, lengths and document
   frequencies are aggregates over it.
3. Search. A task reads some of the index in blocks of documents and inverts each into postings. A query's terms are
   taken rarest first. A document gets an accumulator when a posting names it, but no more are made once the largest
   scores that the remaining terms can add fall below the k-th best partial score: no other document can then come in,
   not even by a tie. The accumulators that exist are updated to the end, so every score returned is exact. The k-th best
   score of the blocks before is the least partial score of the next block.
4. A task hands on at most k documents a query; a window picks the k best of all tasks, partly before the shuffle.

A term is a run of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A null text has no
terms and doesn't count as a document. Equal scores go by ascending id, null ids last; repeated rows are documents each
and equal queries are answered once. A document without any of a query's terms isn't returned, an empty table gives no
rows. Very long texts are read in segments. Columns beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.words import FOLDED, map_texts, run_hashes, runs
from scoreloom.session import written

#: Bytes that end a term, and A-Z as a-z.
GAP = np.zeros(256, bool)
GAP[:128] = [not chr(b).isalnum() for b in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Search:
    """``k`` documents a query; saturation and length norm are those of the score's formula in ``parts``."""

    k: int = 50
    queries_at_once: int = 1000
    documents_at_once: int = 32_768


def weight(documents: int, holding: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    return 100 - 50 + (50 * length * documents) // max(terms, 1)


def gain(times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What ``times`` occurrences of a term of weight 1 add to a score."""
    return (1_000_000_000 * times) // (1000 * times + 20 * norm)


def terms_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each term, and the terms' positions at the bounds between texts."""
    start, end = runs(data, bounds, GAP)
    return start, end, np.searchsorted(start, bounds)


class Vocabulary:
    """The distinct terms of some queries, to be found in many texts at once."""

    def __init__(self, queries: list[str | None]):
        texts = [(q or "").encode() for q in queries]
        data = np.frombuffer(b"".join(texts), np.uint8)
        start, end, at = terms_of(data, np.cumsum([0, *map(len, texts)]))
        folded = LOWER[data].tobytes()
        words = [folded[s:e] for s, e in zip(start, end)]
        self.terms = sorted(set(words))
        number = {w: i for i, w in enumerate(self.terms)}
        self.queries = [sorted({number[w] for w in words[i:j]}) for i, j in zip(at[:-1], at[1:])]
        self.data = np.frombuffer(b"".join(self.terms), np.uint8)
        self.end = np.cumsum([len(t) for t in self.terms], dtype=np.int64)
        self.start = self.end - [len(t) for t in self.terms]
        hashes = run_hashes(self.data, self.start, self.end, FOLDED)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        #: As many terms as share one hash; more than one only for terms made to do so.
        self.most_alike = int(np.unique(hashes, return_counts=True)[1].max(initial=0))

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which runs are terms of the vocabulary, and which terms."""
        hashes = run_hashes(data, start, end, FOLDED)
        first, found = np.searchsorted(self.hashes, hashes), []
        for k in range(self.most_alike):
            place = np.minimum(first + k, len(self.hashes) - 1)
            runs_at = np.flatnonzero(self.hashes[place] == hashes)
            term = self.order[place[runs_at]]
            size = end[runs_at] - start[runs_at]
            same = size == self.end[term] - self.start[term]
            runs_at, term, size = runs_at[same], term[same], size[same]
            if len(runs_at):
                begin = np.cumsum(size) - size
                step = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
                own = LOWER[data[np.repeat(start[runs_at], size) + step]]
                equal = np.logical_and.reduceat(own == self.data[np.repeat(self.start[term], size) + step], begin)
                found.append((runs_at[equal], term[equal]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


def index(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> DataFrame:
    """``(id, n, terms, times)``: a document's number of terms, its terms of the vocabulary and their occurrences."""

    def measure(data: np.ndarray, bounds: np.ndarray) -> list:
        start, end, at = terms_of(data, bounds)
        place, term = vocabulary.find(data, start, end)
        owner = np.searchsorted(at, place, "right") - 1
        width = max(len(vocabulary.terms), 1)
        pairs, times = np.unique(owner * width + term, return_counts=True)
        offsets = pa.array(np.searchsorted(pairs, np.arange(len(bounds)) * width).astype(np.int32))
        return [
            np.diff(at).astype(np.int64),
            pa.ListArray.from_arrays(offsets, pa.array((pairs % width).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
        ]

    fields = [
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ]
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return map_texts(rows, measure, fields, carry=["id"], out="m").select("id", "m.*").where("n > 0")


class Postings:
    """The postings of one block of documents, with what each adds to a score."""

    def __init__(self, block: pa.Table, weights: np.ndarray, documents: int, terms: int):
        block = block.take(pc.sort_indices(block, sort_keys=[("id", "ascending")])).combine_chunks()
        self.ids = block.column("id").combine_chunks()
        lists = block.column("terms").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(block), dtype=np.int32), sizes)
        term = lists.flatten().to_numpy()
        times = block.column("times").combine_chunks().flatten().to_numpy()
        norm = length_norm(block.column("n").to_numpy(), documents, terms)
        adds = weights[term] * gain(times, norm[owner])
        order = np.argsort(term, kind="stable")
        self.owner, self.adds = owner[order], adds[order]
        self.begin = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.begin))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.adds, self.begin[held])
        self.total = np.zeros(len(block), np.int64)
        self.made = np.zeros(len(block), bool)

    def best(self, terms: list[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The places and scores of the ``k`` best documents for terms given rarest first, scores from ``least`` on."""
        total, made = self.total, self.made
        total[:], made[:] = 0, False
        ahead = np.cumsum(self.most[terms][::-1])[::-1]  # the most that this term and those after it can add
        making, kth, count = True, least, 0
        for term, bound in zip(terms, ahead):
            posted = slice(self.begin[term], self.begin[term + 1])
            owner, adds = self.owner[posted], self.adds[posted]
            if making and bound <= ahead[0] - bound + least and count >= k:  # a partial score may be above the bound
                kth = max(least, int(np.partition(total[made], count - k)[count - k]))
            making = making and bound >= kth
            if making:
                total[owner] += adds
                made[owner] = True
                count = int(np.count_nonzero(made))
            else:
                kept = made[owner]
                total[owner[kept]] += adds[kept]
        at = np.flatnonzero(made & (total > 0) & (total >= least))
        if len(at) > k:
            at = at[total[at] >= np.partition(total[at], len(at) - k)[len(at) - k]]
        at = at[np.argsort(-total[at], kind="stable")][:k]  # places follow the ids
        return at, total[at]


def _search(vocabulary: Vocabulary, weights: np.ndarray, documents: int, terms: int, how: Search, kind: pa.DataType):
    rarest_first = [sorted(q, key=lambda t: (-weights[t], t)) for q in vocabulary.queries]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= how.documents_at_once:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held)

    def run(batches):
        best: list[list[tuple]] = [[] for _ in vocabulary.queries]  # (-score, id is null, id), best first
        for block in blocks(batches):
            postings = Postings(block, weights, documents, terms)
            for found, query in zip(best, rarest_first):
                if query:
                    least = -found[-1][0] if len(found) == how.k else 1
                    at, scores = postings.best(query, how.k, least)
                    ids = postings.ids.take(pa.array(at)).to_pylist()
                    found += [(-int(s), i is None, i) for s, i in zip(scores, ids)]
                    found.sort(key=lambda x: x[:2] if x[1] else x)
                    del found[how.k :]
        rows = [(q, i, -s) for q, found in enumerate(best) for s, _, i in found]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, (pa.int32(), kind, pa.int64()))], names=["query", "id", "score"]
        )

    return run


def _answers(docs: DataFrame, block: list, how: Search, key: str, text: str) -> DataFrame:
    """``(query, id, score, rank)`` for the queries of one block, numbered as they come."""
    spark = docs.sparkSession
    vocabulary = Vocabulary([q["text"] for q in block])
    indexed = written(index(docs, vocabulary, key, text), "index")
    documents, terms = indexed.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = dict(indexed.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([weight(documents, holding.get(t, 0)) for t in range(len(vocabulary.terms))], np.int64)
    kind = indexed.schema["id"]
    schema = T.StructType([T.StructField("query", T.IntegerType()), kind, T.StructField("score", T.LongType())])
    arrow = spark.createDataFrame([], T.StructType([kind])).toArrow().schema.field("id").type
    few = indexed.mapInArrow(_search(vocabulary, weights, documents, terms, how, arrow), schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.k)


def search(
    docs: DataFrame, queries: DataFrame, how: Search = Search(), key: str = "doc_id", text: str = "text",
    query_key: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """The ``how.k`` best rows of ``docs`` for each row of ``queries``: ``query_key``, ``rank``, ``key`` and ``score``."""
    spark = docs.sparkSession
    asked = queries.select(F.col(f"`{query_key}`").alias("item"), F.col(f"`{query_text}`").alias("text")).distinct()
    kind = T.StructType([T.StructField("query", T.IntegerType()), asked.schema["item"]])
    found, rows = [], asked.orderBy("item", "text").toLocalIterator()
    while block := list(islice(rows, how.queries_at_once)):
        names = spark.createDataFrame([(i, q["item"]) for i, q in enumerate(block)], kind)
        found.append(_answers(docs, block, how, key, text).join(F.broadcast(names), "query"))
    if not found:
        empty = docs.select(F.lit(0).alias("rank"), F.col(f"`{key}`").alias("id"), F.lit(0).cast("long").alias("score"))
        found.append(empty.crossJoin(asked.select("item")).where("false"))
    return reduce(DataFrame.unionByName, [
        f.select(F.col("item").alias(query_key), "rank", F.col("id").alias(key), "score") for f in found
    ])
