"""Byte-level BPE by higher-order functions.

Encoding. A text is split into pre-tokens. Each distinct word is a text of one character per token, at first one per
byte; a fold over it merges, step by step, the neighbouring pair with the lowest rank, the leftmost of equals. The ranks
of all neighbouring pairs are a second text, a rank being the character of the token that the pair becomes, so a merge
overlays one character of the first text and two of the second. Pairs are found in an array by their hash; it is one row in
the shared folder and read by scalar subquery: as a literal it would be in the text of every plan that Spark logs.
A token that the merges do not lead to is a word of its own and looked up.
The most frequent words of a sample are folded once, in many tasks, and read by the encoding tasks as one value of bounded
size, the result of a scalar subquery; all others are folded where they stand. Which words are kept changes the time, never
the ids. There is no shuffle but for counting the sample's words, and memory does not grow with the corpus.

Decoding looks the bytes of each id up in a literal array and joins them; it knows nothing of words.

A fold takes quadratic time in the length of a word; the distinct words of over ``longest_folded`` bytes go through a heap
instead, word by word: same ranks, same order, same ids. All other words of such a text are folded as everywhere.

Null is the empty text and has no ids. Repeated rows are encoded each; an empty table gives an empty result. Columns
of ``df`` that have the name of the result are replaced.
"""

from __future__ import annotations

import base64
import heapq
import json
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import written

#: Characters that are no token: no rank (above all ranks), the ends of a word, and between the parts of a bucket.
NONE, EDGE, SEP = "\U0010ffff", "\U0010fffe", "\U0010fffd"
#: The character of token 0; those of the others follow, but for the surrogates.
FIRST, SURROGATES = 0x100, range(0xD800, 0xE000)
#: Texts that may have a long word: a hundred characters in a row without white space, or of it.
LONG_RUN = r"[^ \t-\r]{100}|(?U:\s{100})"


@dataclass(frozen=True)
class Limits:
    sample_rows: int = 50_000
    kept_words: int = 524_288
    longest_kept: int = 32  # bytes
    longest_folded: int = 400  # bytes; at least 400, since shorter words are not looked for


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _char(rank: int) -> str:
    """The character that stands for a token."""
    return chr(FIRST + rank if FIRST + rank < SURROGATES.start else FIRST + rank + len(SURROGATES))


def _slot(key: Column, slots: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(slots - 1)).cast("int")


def _power_of_two(least: int) -> int:
    return 1 << max(0, least - 1).bit_length()


class Pairs:
    """An array of buckets of pairs, written as one row. A bucket is ``..N.`` and then ``ab.c.`` for each pair, where c is what ab becomes;
    so a pair is only found where it is one, and three characters before the rank of no pair is N."""

    def __init__(self, pairs: dict[str, str]):
        self.slots = _power_of_two(2 * len(pairs))
        buckets: list[str | None] = [None] * self.slots
        for pair, token in pairs.items():
            place = xxhash.xxh64_intdigest(pair.encode(), 42) & (self.slots - 1)  # as Spark's xxhash64
            buckets[place] = (buckets[place] or SEP + SEP + NONE + SEP) + pair + SEP + token + SEP
        self.buckets = buckets

    def row(self, spark: SparkSession) -> DataFrame:
        return written(spark.createDataFrame([(self.buckets,)], "buckets array<string>"), "pairs")

    def rank(self, buckets: Column, pair: Column) -> Column:
        bucket = F.get(buckets, _slot(pair, self.slots))
        return F.coalesce(F.substr(bucket, F.position(pair, bucket) + 3, F.lit(1)), F.lit(NONE))


class Known:
    """The tokens of kept words, as one row: an array with one word and its tokens, or null, at each hash. Of words of one
    hash the most frequent is in it; one value of bounded size is all that passes through the driver."""

    def __init__(self, words: DataFrame, slots: int):
        """``words``: word, n, tokens."""
        self.slots = slots
        entry = F.concat("word", F.lit(SEP), "tokens")
        found = (
            words.where(~F.contains("word", F.lit(SEP)))
            .groupBy(_slot(F.col("word"), slots).alias("slot"))
            .agg(F.max_by(entry, F.struct("n", "word")).alias("entry"))
        )
        every = words.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot")).join(found, "slot", "left")
        rows = F.sort_array(F.collect_list(F.struct("slot", "entry")))
        self.row = written(every.agg(rows.alias("rows")).select("rows.entry"), "known")

    def find(self, entries: Column, word: Column) -> Column:
        entry = F.get(entries, _slot(word, self.slots))
        return F.when(F.substring_index(entry, SEP, 1) == word, F.substring_index(entry, SEP, -1))


class Codec:
    """The vocabulary as literals, and what is computed with them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        halves = ((token[:k], token[k:], rank) for token, rank in ranks.items() for k in range(1, len(token)))
        self.pairs = Pairs({
            _char(ranks[left]) + _char(ranks[right]): _char(rank)
            for left, right, rank in halves if left in ranks and right in ranks
        })
        self.bytes = "".join(_char(ranks[bytes([b])]) for b in range(256))
        unmerged = {token: rank for token, rank in ranks.items() if merge_by_heap(token, ranks, merged=True) != [rank]}
        self.unmerged = {_text(token): _char(rank) for token, rank in unmerged.items() if _text(token) is not None}
        pieces = [""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token.hex().upper()
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
        little = [rank.to_bytes(4, "little").hex() for rank in range(len(pieces))]
        self.little = F.from_json(F.lit(json.dumps(little)), "array<string>")

    def words(self, text: Column) -> Column:
        """The pre-tokens; white space is that of Unicode."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + self.pattern), F.lit(0))

    def fold(self, pairs: Column, word: Column) -> Column:
        """The tokens of one word, a character each, by the buckets of the pairs."""
        one = F.lit(1)
        rank = lambda pair: self.pairs.rank(pairs, pair)
        bytes_of = F.translate(F.decode(word.cast("binary"), "ISO-8859-1"), "".join(map(chr, range(256))), self.bytes)
        start = _let(
            F.concat(F.lit(EDGE), bytes_of, F.lit(EDGE)),
            lambda p: F.struct(
                p.alias("p"),
                F.array_join(
                    F.transform(F.sequence(one, F.length(p) - 1), lambda at: rank(F.substr(p, at, F.lit(2)))), ""
                ).alias("r"),
            ),
        )

        def merged(p, r, best):  # i: the place of the pair's first token, from 1; there are ends on both sides

            def ranks(q, i):  # those of three pairs become those of two
                left = F.overlay(r, rank(F.substr(q, i - 1, F.lit(2))), i - 1, 2)
                return F.overlay(left, rank(F.substr(q, i, F.lit(2))), i, 1)

            return _let(
                F.position(best, r),
                lambda i: _let(F.overlay(p, best, i, 2), lambda q: F.struct(q.alias("p"), ranks(q, i).alias("r"))),
            )

        def step(acc, _):
            lowest = F.array_min(F.split(acc["r"], ""))
            return _let(lowest, lambda best: F.when(best < NONE, merged(acc["p"], acc["r"], best)).otherwise(acc))

        steps = F.sequence(one, F.greatest(F.octet_length(word) - 1, one))
        folded = F.aggregate(steps, start, step, lambda acc: F.substr(acc["p"], F.lit(2), F.length(acc["p"]) - 2))
        if not self.unmerged:
            return folded
        whole = F.from_json(F.lit(json.dumps(self.unmerged)), "map<string,string>")
        return F.coalesce(F.try_element_at(whole, word), folded)

    def ids(self, tokens: Column) -> Column:
        """The ids of tokens, a character each."""

        def of_one(char):
            code = F.ascii(char)
            if FIRST + max(self.ranks.values(), default=0) < SURROGATES.start:
                return code - FIRST
            return code - F.when(code < SURROGATES.start, FIRST).otherwise(FIRST + len(SURROGATES))

        none = F.array().cast("array<int>")
        return F.when(tokens == "", none).otherwise(F.transform(F.split(tokens, ""), of_one))

    def frequent(self, df: DataFrame, text: str, limits: Limits, pairs: DataFrame) -> Known | None:
        """The words that are most frequent in a sample: at most ``kept_words`` of them."""
        if not limits.kept_words:
            return None
        rows = df.count()
        part = int(min(1.0, limits.sample_rows / max(1, rows)) * 2**31)
        some = df.where(F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(2**31)) < part)
        top = (
            some.select(F.explode(self.words(F.col(f"`{text}`"))).alias("word"))
            .where(F.octet_length("word") <= limits.longest_kept)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .orderBy(F.desc("n"), "word").limit(limits.kept_words)
        )
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tokens = _let(F.col("pairs"), lambda buckets: self.fold(buckets, F.col("word")))
        top = top.repartition(tasks, "word").withColumn("pairs", pairs.scalar())
        kept = written(top.select("word", "n", tokens.alias("tokens")), "kept")
        return Known(kept, _power_of_two(2 * kept.count()))

    def encode(self, df: DataFrame, text: str = "text", out: str = "ids", limits: Limits = Limits()) -> DataFrame:
        """``df`` and the ids of each text as ``out``; the column ``text`` goes."""
        pairs_row = self.pairs.row(df.sparkSession)
        known = self.frequent(df, text, limits, pairs_row)
        body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        longest = max(400, limits.longest_folded)
        long_words = F.filter(F.array_distinct(self.words(body)), lambda w: F.octet_length(w) > longest)
        heaped = F.pandas_udf(_by_heap(self.ranks), "array<string>")
        columns = [F.col(f"`{c}`") for c in df.columns if c not in (text, out)]
        taken = {*df.columns, out}
        found, coded, kept, paired = (_free(name, taken) for name in ("words", "coded", "kept", "pairs"))

        def tokens(pairs, by_heap, entries=None):
            def of_word(w):
                folded = self.fold(pairs, w)
                folded = F.when(F.octet_length(w) > longest, F.try_element_at(by_heap, w)).otherwise(folded)
                return folded if entries is None else F.coalesce(known.find(entries, w), folded)

            return F.array_join(F.transform(self.words(body), of_word), "")

        def ids(pairs, by_heap):
            if known is None:
                return _let(tokens(pairs, by_heap), self.ids)
            return _let(F.col(kept), lambda entries: _let(tokens(pairs, by_heap, entries), self.ids))

        rows = df.withColumn(found, F.when(body.rlike(LONG_RUN), long_words).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn(coded, heaped(F.col(found)))
        # The optimizer puts the subqueries where their columns stand, so no row carries the pairs or the words.
        rows = rows.withColumn(paired, pairs_row.scalar())
        if known is not None:
            rows = rows.withColumn(kept, known.row.scalar())
        by_heap = F.map_from_arrays(F.col(found), F.col(coded))
        coding = _let(F.col(paired), lambda pairs: _let(by_heap, lambda heap: ids(pairs, heap)))
        return rows.select(*columns, coding.alias(out))

    def decode(self, ids: Column) -> Column:
        """The bytes of a sequence of ids."""
        return _let(self.pieces, lambda p: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")))

    def packed(self, ids: Column) -> Column:
        """A sequence of ids as little-endian unsigned 32-bit integers."""
        joined = lambda little: F.array_join(F.transform(ids, lambda i: F.get(little, i)), "")
        return _let(self.little, lambda little: F.unhex(joined(little)))


def merge_by_heap(word: bytes, ranks: dict[bytes, int], merged: bool = False) -> list[int]:
    """The ids of one word of any length. ``merged``: by merges alone, even if the word is a token."""
    if word in ranks and not merged:
        return [ranks[word]]
    end, after = list(range(1, len(word) + 1)), list(range(1, len(word) + 1))
    before, alive = list(range(-1, len(word) - 1)), [True] * len(word)
    queue = [(ranks[word[i : i + 2]], i, i + 2) for i in range(len(word) - 1) if word[i : i + 2] in ranks]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        if not alive[i] or after[i] >= len(word) or end[after[i]] != stop:
            continue
        gone = after[i]
        alive[gone], end[i], after[i] = False, stop, after[gone]
        if after[i] < len(word):
            before[after[i]] = i
            joined = word[i : end[after[i]]]
            if joined in ranks:
                heapq.heappush(queue, (ranks[joined], i, end[after[i]]))
        if before[i] >= 0:
            joined = word[before[i] : stop]
            if joined in ranks:
                heapq.heappush(queue, (ranks[joined], before[i], stop))
    return [ranks[word[i : end[i]]] for i in range(len(word)) if alive[i]]


def _by_heap(ranks: dict[bytes, int]):
    def run(words: pd.Series) -> pd.Series:
        return words.map(lambda some: ["".join(map(_char, merge_by_heap(w.encode(), ranks))) for w in some])

    return run


def _text(token: bytes) -> str | None:
    """The token as text, if it is one."""
    try:
        return token.decode()
    except UnicodeDecodeError:
        return None


def _free(name: str, taken: set[str]) -> str:
    """A column name like ``name`` that is not taken."""
    while name in taken:
        name += "_"
    return name
