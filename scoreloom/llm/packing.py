"""Packing of tokenised texts into sequences of a fixed length.

1. Tasks tokenise their texts (with an end id after each) and cut every document into whole sequences and a rest.
2. Pieces are dealt at random into groups of some two thousand, so groups are alike whatever the order or source of the
   documents, and each is packed on its own: rests by first-fit decreasing, where a tournament tree of the free space
   in the bins finds the first bin that fits in logarithmic time. Then the emptiest bins are cut up to fill gaps of
   others, so a group leaves about one sequence short.

Tokens come from a byte-level vocabulary file of the tokenizers library, whose content goes to the tasks (one or two
megabytes). A task remembers the ids of pre-tokens, and those of the stretches between spaces: a space before a
character that is no white space always starts a new pre-token, so a text can be put together from such stretches. Texts
with a space before other white space or at the end are split whole. Both memories are bounded. A text that holds an
added token of the vocabulary file, such as an end marker, is left to the library, which gives the token its own id.

A null text is empty; an empty text is the end id alone. Repeated rows are separate documents of the same id and are
packed each. A null id is kept. An empty table gives an empty result. Columns beside the two named are not read.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REMEMBERED = 400_000  # entries of each memory, of at most LONGEST characters: some 80 MB
LONGEST = 48
TOGETHER = 400  # texts whose pieces leave a task at a time
GROUP = 2000  # pieces in a group, about

#: Fixed value: the pattern of byte-level pre-tokens, and the same for ASCII.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WIDE = regex.compile(PATTERN)
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_known: dict[str, Encoder] = {}


def _byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Sequences:
    length: int = 1024
    end_id: int = 0
    least_piece: int = 8  # shorter gaps are not filled by cutting


def vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Memory(dict):
    """What ``make`` makes of a text, remembered for short texts up to a bounded number.

    Half of the number is kept back when the memory is full: what comes up again moves to the new half.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, text: str) -> bytes | None:
        made = self.before.get(text)
        if made is None:
            made = self.make(text)
        if len(text) <= LONGEST:
            if len(self) >= REMEMBERED // 2:
                self.before = dict(self)
                self.clear()
            self[text] = made
        return made


class Encoder:
    """Ids of texts as packed little-endian numbers, by a tokenizers vocabulary."""

    def __init__(self, vocabulary_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary_json)
        code, characters, tokenize = "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I", _byte_characters(), tokenizer.model.tokenize
        self.dtype = np.dtype("<u2" if code == "H" else "<u4")

        def piece(text: str) -> bytes:
            if text.isascii() and text.isprintable():  # of these only the space is written otherwise
                written = text.replace(" ", characters[32])
            else:
                written = text.encode().decode("latin-1").translate(characters)
            return array(code, [t.id for t in tokenize(written)]).tobytes()

        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.whole = lambda text: array(code, tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self.piece, self.pieces, self.stretches = piece, Memory(piece), Memory(self._stretch)

    def _split(self, text: str) -> bytes:
        """The ids of a text by its pre-tokens."""
        return b"".join(map(self.pieces.__getitem__, (_ASCII if text.isascii() else _WIDE).findall(text)))

    def _stretch(self, text: str) -> bytes | None:
        """The ids of a space and what follows it; none if that is white space or the end."""
        if not text or text[0].isspace():
            return None
        if text.isalpha() and text.isascii():  # one pre-token, remembered as this stretch alone
            return self.piece(" " + text)
        return self._split(" " + text)

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.whole(text)
        first, *others = text.split(" ")
        coded = list(map(self.stretches.__getitem__, others))
        return self._split(text) if None in coded else self._split(first) + b"".join(coded)


def encoder(vocabulary_json: str) -> Encoder:
    """The encoder of a vocabulary, made once per process."""
    if vocabulary_json not in _known:
        _known.clear()
        _known[vocabulary_json] = Encoder(vocabulary_json)
    return _known[vocabulary_json]


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, taken from the largest on, each into the first bin that has room."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    free = [capacity] * (2 * leaves)  # a node holds the largest free space below it
    bins = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < sizes[item]:
                node += 1
        bins[item] = node - leaves
        free[node] -= sizes[item]
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return bins


def filled(sizes: list[int], bins: list[int], capacity: int, least: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, first, length): the emptiest bins are cut up into the gaps of the others while they fit."""
    content: dict[int, list[tuple[int, int, int]]] = {}
    for item, b in enumerate(bins):
        content.setdefault(b, []).append((item, 0, sizes[item]))
    free = {b: capacity - sum(n for _, _, n in pieces) for b, pieces in content.items()}
    gaps = [(-f, b) for b, f in free.items() if f >= least]  # the largest first; an entry counts while it is current
    heapify(gaps)
    room = -sum(g for g, _ in gaps)
    while gaps:
        gap, b = heappop(gaps)
        if free[b] != -gap:
            continue
        if room < capacity + least * len(content[b]):  # the others' gaps may not hold what is in the emptiest bin
            break
        room += gap
        free[b] = 0
        for item, first, n in content.pop(b):
            while n:
                gap, other = heappop(gaps)
                if free[other] != -gap:
                    continue
                part = min(n, -gap)
                content[other].append((item, first, part))
                first, n = first + part, n - part
                free[other] += -part
                room -= part
                if free[other] >= least:
                    heappush(gaps, (-free[other], other))
                else:
                    room -= free[other]
                    free[other] = 0
    return list(content.values())


def packed(
    docs: DataFrame, vocabulary_json: str, into: Sequences = Sequences(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of documents: ``key``, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    ``start`` counts the ids of the document before the piece and ``doc_tokens`` all of them, end id included.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    groups = max(1, ceil((size[0] + (size[1] or 0) / 3 / into.length) / GROUP))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_json)  # a vocabulary file, whatever the input
    id_type, names = docs.schema[key].dataType, ["grp", "id", "doc_tokens", "start", "ids"]

    def cut(batches):
        enc = encoder(shared.value)
        width, end = enc.dtype.itemsize * into.length, np.array([into.end_id], enc.dtype).tobytes()
        random = np.random.Generator(np.random.PCG64(TaskContext.get().partitionId()))
        gc.disable()  # strings and bytes have no cycles, and the memories are large to walk
        try:
            yield from cut_batches(batches, enc, width, end, random)
        finally:
            gc.enable()

    def cut_batches(batches, enc, width, end, random):
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                take, count, start, ids = [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    coded = enc.encode(text or "") + end
                    cuts = range(0, len(coded), width)
                    ids += [coded[c : c + width] for c in cuts]
                    start += [c // enc.dtype.itemsize for c in cuts]
                    take += [i] * len(cuts)
                    count += [len(coded) // enc.dtype.itemsize] * len(cuts)
                group = random.integers(0, groups, len(ids), dtype=np.int32)
                columns = [pa.array(group), part.column(0).take(pa.array(take)), pa.array(count, pa.int64()),
                           pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("start", "ascending")])
        ids, starts, group = table.column("ids").to_pylist(), table.column("start").to_pylist(), table.column("grp")[0].as_py()
        dtype = encoder(shared.value).dtype
        wide = dtype.itemsize
        sizes = [len(x) // wide for x in ids]
        whole = [i for i, n in enumerate(sizes) if n == into.length]
        rest = [i for i, n in enumerate(sizes) if n < into.length]
        small = [sizes[i] for i in rest]
        bins = filled(small, first_fit_decreasing(small, into.length), into.length, into.least_piece)
        bins = [[(i, 0, into.length)] for i in whole] + [[(rest[i], first, n) for i, first, n in b] for b in bins]
        take, start, length, out, sequence, offset = [], [], [], [], [], []
        for number, pieces in enumerate(bins):
            at = 0
            for i, first, n in pieces:
                take.append(i)
                start.append(starts[i] + first)
                length.append(n)
                out.append(np.frombuffer(ids[i], dtype, n, first * wide).astype("<u4").tobytes())
                sequence.append((group << 32) + number)
                offset.append(at)
                at += n
        index = pa.array(take, pa.int64())
        return pa.table({
            key: table.column("id").take(index),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids": pa.array(out, pa.binary()),
            "doc_tokens": table.column("doc_tokens").take(index),
            "sequence_id": pa.array(sequence, pa.int64()),
            "offset": pa.array(offset, pa.int64()),
        })

    cut_schema = T.StructType([
        T.StructField("grp", T.IntegerType()), T.StructField("id", id_type), T.StructField("doc_tokens", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    schema = T.StructType([
        T.StructField(key, id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    return rows.mapInArrow(cut, cut_schema).groupBy("grp").applyInArrow(pack, schema)
