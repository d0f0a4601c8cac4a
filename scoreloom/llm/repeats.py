"""Passages that repeat, by longest previous factors in suffix order.

A byte goes when a string of ``least`` bytes that covers it also starts earlier: in a document of smaller id or further
up in its own. The strings are judged on the input, so the first occurrence always stays.

1. Anchors. Of the hashes of all ``GRAM``-byte strings inside a window of ``least`` bytes the smallest is the window's
   anchor, so equal windows have equal anchors wherever they stand. Consecutive windows with one anchor form a phrase
   of at most ``2 * least - GRAM`` bytes; only (anchor, digest, place) of a phrase is shuffled, one row for some 36 bytes.
   Phrases that a batch of documents holds several times are settled in the batch, so a passage that a third of all
   documents share comes to the shuffle once a batch.
2. Names. Rows are dealt by anchor. A phrase that is not the first of its digest goes as a whole. What an anchor has
   alone stays. Only the first phrases of anchors with several different phrases go on, with their bytes.
3. Longest previous factors. The windows of such phrases are put in suffix order. Windows that share their whole length
   are neighbours there, and one has an earlier match of that length when the previous or the next smaller position in
   suffix order lies inside its run of neighbours. Positions are those of first phrases, so this decides every window.
   An anchor with very many different phrases is done in random groups of ``GROUP`` phrases. Windows that are first in
   their group are then compared across the groups by their digests, dealt in as many ranges of digests as groups.
4. The removed windows are gathered per document, at most as many as it has bytes, and cut out.

Null is the empty text; a text of less than ``least`` bytes loses nothing. Null ids come after all others. Rows of equal
id and text are one document and get one result each; rows of equal id and different texts are documents of their own,
in the order of a hash of the text. Very long texts are read in segments. Extra columns pass through; one that has the
name of the result is replaced. Phrases, and windows of different groups, are equal
when anchor and digest are, 128 bits together; within a group bytes are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.words import BYTES, SEGMENT, U64, mix, parts
from scoreloom.session import written

LEAST = 100
GRAM = 32
GROUP = 4096
PLACE_BITS = 24  # a place is (start << 24) + length
FLUSH = 1 << 21  # bytes of phrases put in order at once
_STEPS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    h, span = BYTES[data], 1
    for step in _STEPS:
        h = h[:-span] * U64(step) + h[span:]
        span *= 2
    return mix(h)


def phrases(data: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, start, end)`` of the phrases of some texts that lie back to back."""
    out = []
    for low in range(0, max(len(data) - least + 1, 0), SEGMENT):
        part = data[low : low + SEGMENT + least - 1]
        h = grams(part)
        # the smallest hash, the leftmost of equals: 40 bits of hash over 24 bits of position
        key = (h & ~U64((1 << 24) - 1)) | np.arange(len(h), dtype=U64)
        width, span = least - GRAM + 1, 1
        while 2 * span <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if width > span:
            key = np.minimum(key[: span - width], key[width - span :])
        at = (key & U64((1 << 24) - 1)).astype(np.int64)
        whole = np.ones(len(at) + 1, bool)  # windows that lie in one text
        whole[-1] = False
        for b in bounds[np.searchsorted(bounds, low, "right") : np.searchsorted(bounds, low + len(part), "left")] - low:
            whole[max(0, b - least + 1) : b] = False
        whole = whole[:-1]
        new = whole.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
        last = whole.copy()
        last[:-1] &= (at[1:] != at[:-1]) | ~whole[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(last)
        out.append((h[at[first]], first + low, last + low + least))
    if not out:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    view, digest = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    joined = b"".join([digest(view[s:e], digest_size=8).digest() for s, e in zip(start.tolist(), end.tolist())])
    return np.frombuffer(joined, np.int64)


def _order_of(ids: pa.Array, digests: np.ndarray) -> np.ndarray:
    """The place of each document among those of a batch, equal for equal documents."""
    rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
    order = np.lexsort((digests, rank))
    changes = np.ones(len(order), np.int64)
    changes[:1] = 0
    changes[1:] = (rank[order[1:]] != rank[order[:-1]]) | (digests[order[1:]] != digests[order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(changes)
    return number


def named(rows: DataFrame, least: int) -> DataFrame:
    """``(h, d, id, sign, at)``: the phrases of all documents; ``d`` is null where a batch holds the phrase earlier."""

    def run(batches):
        for batch in batches:
            ids, sign = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            found = []
            for i, _, data, bounds in parts(batch.column(2)):
                h, start, end = phrases(data, bounds, least)
                text = np.searchsorted(bounds, start, "right") - 1
                found.append((h, _digests(data, start, end), text + i, start - bounds[text], end - start))
            h, d, row, start, size = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 5
            h = h.astype(U64).view(np.int64)
            place = (_order_of(ids, sign)[row] << 40) + start
            order = np.lexsort((place, d, h))
            h, d, row, start, size, place = (x[order] for x in (h, d, row, start, size, place))
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            again = place > place[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(h) else first

            late = np.flatnonzero(again)
            late = late[np.argsort(place[late])]
            where, length = place[late], size[late]
            new = np.ones(len(late), bool)  # settled phrases that overlap are put together
            new[1:] = (where[1:] > where[:-1] + length[:-1]) | (where[1:] >> 23 != where[:-1] >> 23)
            lead = np.flatnonzero(new)
            tail = np.append(lead[1:], len(late))[: len(lead)] - 1
            length = where[tail] + length[tail] - where[lead]
            keep, lead = np.flatnonzero(first), late[lead]
            rows_of = np.concatenate([row[keep], row[lead]])
            at = np.concatenate([(start[keep] << PLACE_BITS) + size[keep], (start[lead] << PLACE_BITS) + length])
            # what is settled is spread evenly, whatever its anchor
            hashes = np.concatenate([h[keep], mix(place[lead].astype(U64) ^ h[lead].view(U64)).view(np.int64)])
            settled = np.arange(len(rows_of)) >= len(keep)
            digest = pa.array(np.concatenate([d[keep], d[lead]]), mask=settled)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), digest, ids.take(pa.array(rows_of)), pa.array(sign[rows_of]), pa.array(at)],
                names=["h", "d", "id", "sign", "at"],
            )

    schema = T.StructType([
        T.StructField("h", T.LongType()), T.StructField("d", T.LongType()), rows.schema["id"],
        T.StructField("sign", T.LongType()), T.StructField("at", T.LongType()),
    ])
    return rows.select("id", "sign", "text").mapInArrow(run, schema)


def suffix_order(data: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``start`` in the order of their first ``depth`` bytes, and the number of each one's run of equals."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    order, run = np.arange(len(start)), np.zeros(len(start), np.int64)
    open_ = order.copy()  # places in the order whose run may still be divided
    for skip in range(0, depth, 8):
        word = words[start[order[open_]] + skip].astype(U64)
        if depth - skip < 8:
            word >>= U64(8 * (8 - (depth - skip)))
        by_word = np.argsort(word)
        ranks = np.empty(len(word), np.int64)
        ranks[by_word] = np.cumsum(np.append(0, word[by_word[1:]] != word[by_word[:-1]])[: len(word)])
        inside = np.argsort(run[open_] * (len(word) + 1) + ranks)  # runs keep their place, words divide them
        order[open_], ranks = order[open_][inside], ranks[inside]
        begins = np.zeros(len(order), np.int64)
        begins[1:] = run[1:] != run[:-1]
        begins[open_[1:]] |= (ranks[1:] != ranks[:-1]) & (open_[1:] == open_[:-1] + 1)
        run = np.cumsum(begins)
        alone = np.bincount(run, minlength=1)[run] == 1
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
    return order, run


def repeats_earlier(data: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix has ``depth`` bytes in common with one before it in ``start``: its longest previous factor.

    The earlier match is at the previous or the next smaller position in suffix order, if that is in the suffix's run.
    """
    order, run = suffix_order(data, start, depth)
    wide = len(order) + 1
    falling, rising = order - run * wide, order + run * wide  # positions; another run's are larger on that side
    earlier = np.zeros(len(order), bool)
    earlier[order[1:]] = np.minimum.accumulate(falling)[:-1] < falling[1:]
    earlier[order[:-1]] |= np.minimum.accumulate(rising[::-1])[::-1][1:] < rising[:-1]
    return earlier


def _windows(size: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrase and the offset of every window of phrases of some sizes."""
    count = size - least + 1
    owner = np.repeat(np.arange(len(size)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def factors(found: DataFrame, least: int) -> DataFrame:
    """``(id, sign, at)`` of what goes, and ``(h, part, windows)`` where an anchor has several parts.

    ``found`` has ``(h, part, parts, id, sign, start, bytes)`` and lies in order of ``(h, part)``. ``windows`` are those
    without an earlier match in their part, as ``(d, id, sign, at)``; its ``part`` is their range of digests.
    """

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole groups, some megabytes at a time."""
        held, size, last = [], 0, None
        for batch in batches:
            h, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1])) + 1
            if last is not None and len(h) and (h[0], part[0]) != last:
                cuts = np.append(0, cuts)
            begin, ends = 0, np.cumsum(pc.binary_length(batch.column(6)).to_numpy())
            for cut in cuts.tolist():
                if size + (ends[cut - 1] if cut else 0) - (ends[begin - 1] if begin else 0) >= FLUSH:
                    held.append(batch.slice(begin, cut - begin))
                    yield pa.Table.from_batches(held)
                    held, size, begin = [], 0, cut
            held.append(batch.slice(begin))
            if len(h):
                size += int(ends[-1] - (ends[begin - 1] if begin else 0))
                last = (h[-1], part[-1])
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        for table in groups(batches):
            keys = [(c, "ascending") for c in ("id", "sign", "start")]
            table = table.take(pc.sort_indices(table, sort_keys=keys)).combine_chunks()
            if not len(table):
                continue
            ids, signs, starts = (table.column(c).combine_chunks() for c in ("id", "sign", "start"))
            place = (_order_of(ids, signs.to_numpy()) << 40) + starts.to_numpy()
            new = np.append(True, place[1:] != place[:-1])  # a row that is there twice is one document
            table = table.filter(pa.array(new)).combine_chunks()
            ids, signs, starts = (table.column(c).combine_chunks() for c in ("id", "sign", "start"))
            raw = table.column("bytes").combine_chunks()
            data = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
            size = pc.binary_length(raw).to_numpy().astype(np.int64)
            owner, offset = _windows(size, least)
            first = (np.cumsum(size) - size)[owner] + offset
            gone = repeats_earlier(data, first, least)

            # consecutive windows of a phrase that go are one stretch
            begins, ends = gone.copy(), gone.copy()
            begins[1:] &= ~(gone[:-1] & (owner[1:] == owner[:-1]))
            ends[:-1] &= ~(gone[1:] & (owner[1:] == owner[:-1]))
            b, e = np.flatnonzero(begins), np.flatnonzero(ends)
            start = starts.to_numpy()[owner]
            at = ((start[b] + offset[b]) << PLACE_BITS) + offset[e] - offset[b] + least
            rows = pa.array(owner[b])
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), signs.take(rows), pa.array(at), *(pa.nulls(len(b), t) for t in (pa.int64(), pa.int64(), kind))],
                names=RESULT,
            )

            h, part, parts = (table.column(c).to_numpy() for c in ("h", "part", "parts"))
            again = np.flatnonzero((parts[owner] > 1) & ~gone)
            d = _digests(data, first[again], first[again] + least)
            to = np.mod(d, parts[owner[again]])
            order = np.lexsort((to, part[owner[again]], h[owner[again]]))
            again, d, to = again[order], d[order], to[order]
            of = owner[again]
            new = np.append(True, (h[of[1:]] != h[of[:-1]]) | (part[of[1:]] != part[of[:-1]]) | (to[1:] != to[:-1]))[: len(of)]
            begin, rows = np.flatnonzero(new), pa.array(of)
            windows = pa.StructArray.from_arrays(
                [pa.array(d), ids.take(rows), signs.take(rows), pa.array(((start + offset)[again] << PLACE_BITS) + least)],
                fields=list(kind.value_type),
            )
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(of)).astype(np.int32)), windows).cast(kind)
            none = len(begin)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(none, ids.type), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()), pa.array(h[of[begin]]), pa.array(to[begin]), lists],
                names=RESULT,
            )

    one = T.StructType([
        T.StructField("d", T.LongType()), T.StructField("id", found.schema["id"].dataType), T.StructField("sign", T.LongType()),
        T.StructField("at", T.LongType()),
    ])
    schema = T.StructType([
        found.schema["id"], T.StructField("sign", T.LongType()), T.StructField("at", T.LongType()),
        T.StructField("h", T.LongType()), T.StructField("part", T.LongType()), T.StructField("windows", T.ArrayType(one)),
    ])
    kind = found.sparkSession.createDataFrame([], schema).toArrow().schema.field("windows").type
    return found.select("h", "part", "parts", "id", "sign", "start", "bytes").mapInArrow(run, schema)


RESULT = ["id", "sign", "at", "h", "part", "windows"]


def across(packed: DataFrame) -> DataFrame:
    """``(id, sign, at)`` of the windows that another group of their anchor has earlier.

    ``packed`` has ``(h, part, windows)`` and lies in order of ``(h, part)``; each group gave one row for each part.
    """

    def run(batches):
        held, last = [], None

        def later():
            windows = pa.concat_arrays(held)
            d, ids, signs, at = (windows.field(k) for k in range(4))
            d = d.to_numpy()
            place = (_order_of(ids, signs.to_numpy()) << 40) + (at.to_numpy() >> PLACE_BITS)
            order = np.lexsort((place, d))
            d, place = d[order], place[order]
            first = np.append(True, d[1:] != d[:-1])
            rows = pa.array(order[place > place[np.flatnonzero(first)[np.cumsum(first) - 1]]])
            return pa.RecordBatch.from_arrays([x.take(rows) for x in (ids, signs, at)], names=["id", "sign", "at"])

        for batch in batches:
            for h, part, windows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and (h, part) != last:
                    yield later()
                    held = []
                last = (h, part)
                held.append(windows.values)
        if held:
            yield later()

    return packed.select("h", "part", "windows").mapInArrow(run, packed.select("id", "sign", "at").schema)


def _start(at: Column) -> Column:
    return F.shiftright(at, PLACE_BITS)


def _length(at: Column) -> Column:
    return at.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("h", "part").sortWithinPartitions("h", "part")


def stretches(rows: DataFrame, least: int, group: int) -> DataFrame:
    """``(id, sign, at)`` of everything that goes, in stretches that may overlap."""
    by_phrase = Window.partitionBy("h", "d").orderBy(F.asc_nulls_last("id"), "sign", "at")
    seen = named(rows, least).repartition("h").select(
        "*", F.row_number().over(by_phrase).alias("number"), F.rank().over(by_phrase).alias("rank")
    )
    different = F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).over(Window.partitionBy("h"))
    seen = seen.withColumn("different", different)
    first = F.col("d").isNotNull() & (F.col("number") == 1)
    found = written(
        seen.where(F.col("d").isNull() | (F.col("rank") > 1) | (first & (F.col("different") > 1)))
        .select("h", "id", "sign", "at", "different", first.alias("open")),
        "phrases",
    )

    asked = found.where("open").groupBy("id", "sign").agg(F.collect_list(F.struct("h", "at", "different")).alias("wanted"))
    texts = rows.withColumnsRenamed({"id": "_id", "sign": "_sign"})
    cut = F.transform("wanted", lambda w: F.struct(
        w["h"].alias("h"), w["different"].alias("different"), _start(w["at"]).alias("start"),
        F.substring(F.col("text").cast("binary"), (_start(w["at"]) + 1).cast("int"), _length(w["at"]).cast("int")).alias("bytes"),
    ))
    opened = texts.join(asked, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sign") == F.col("_sign"))).select(
        "id", "sign", F.explode(cut).alias("p")
    ).select("id", "sign", "p.*")
    spread = opened.withColumn("parts", F.ceil(F.col("different") / group)).withColumn(
        "part", F.pmod(F.xxhash64("id", "sign", "start"), F.col("parts"))
    )
    once = written(factors(_dealt(spread), least), "factors")
    return (
        found.where("NOT open").select("id", "sign", "at")
        .unionByName(once.where("windows IS NULL").select("id", "sign", "at"))
        .unionByName(across(_dealt(once.where("windows IS NOT NULL"))))
    )


FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
]


def _cut(carry: list[str], out: str):
    """Cut the stretches out of texts: the last two columns of a batch are the stretches and the bytes."""

    def run(batches):
        for batch in batches:
            at, raw = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            rows = []
            for places, text in zip(at, raw):
                text = text.as_py() or b""
                place = np.sort(places.values.to_numpy(zero_copy_only=False)) if places.is_valid else np.zeros(0, np.int64)
                start = place >> PLACE_BITS
                end = np.maximum.accumulate(start + (place & ((1 << PLACE_BITS) - 1)))
                new = np.append(True, start[1:] > end[:-1])[: len(start)]
                b = start[new]
                e = end[np.append(np.flatnonzero(new)[1:], len(end)) - 1] if len(b) else end
                spans = list(zip(b.tolist(), e.tolist()))
                kept = b"".join(text[x:y] for x, y in zip([0, *e.tolist()], [*b.tolist(), len(text)]))
                rows.append({
                    "n_bytes": len(text), "n_removed": len(text) - len(kept), "kept": kept,
                    "spans": [{"start": x, "end": y} for x, y in spans],
                })
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", span), ("kept", pa.binary())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(rows, kind)], names=[*carry, out])

    return run


def repeats(
    docs: DataFrame, least: int = LEAST, group: int = GROUP, key: str = "doc_id", text: str = "text", out: str = "repeats",
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs``'s columns ``carry`` (all by default) and a struct ``out``: the bytes of each text, those removed, the removed
    spans (end exclusive) and the bytes kept, which may begin or end inside a character.
    """
    if least < 2 * GRAM:
        raise ValueError(f"passages of at least {2 * GRAM} bytes can be found")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("sign"), body.alias("text"))
    gone = stretches(rows, least, group).groupBy("id", "sign").agg(F.collect_list("at").alias("at"))
    carry = [c for c in (docs.columns if carry is None else carry) if c != out]
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.col(f"`{key}`").alias("_id"),
        F.xxhash64(body).alias("_sign"), body.cast("binary").alias("bytes"),
    )
    joined = whole.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sign") == F.col("_sign")), "left").select(
        *(F.col("row").getField(c).alias(c) for c in carry), F.col("at").alias("__at__"), F.col("bytes").alias("__bytes__")
    )
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(out, T.StructType(FIELDS))])
    return joined.mapInArrow(_cut(carry, out), schema)
