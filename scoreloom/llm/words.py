"""Hashes of the words of many texts at once, in numpy, for use inside Spark tasks.

A word is a run of bytes other than space and tab to carriage return. Its hash is a polynomial over one random
64-bit number per byte, read from running sums, so no step works word by word. Texts are handled in parts of about
a megabyte; a longer text is cut into segments and a word across a cut is put together from its parts, so memory
stays a small multiple of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = 1 << 20
U64 = np.uint64

_random = np.random.Generator(np.random.PCG64(7_340_033))
BYTES = _random.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
#: The same numbers with A-Z taken as a-z.
FOLDED = BYTES.copy()
FOLDED[65:91] = FOLDED[97:123]

BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power(inverse: bool) -> np.ndarray:
    """The powers of the base, or of its inverse, up to a segment's length; made once per process."""
    if str(inverse) not in _powers:
        steps = np.full(SEGMENT + 1, pow(_BASE, -1, 1 << 64) if inverse else _BASE, U64)
        steps[0] = 1
        _powers[str(inverse)] = np.multiply.accumulate(steps)
    return _powers[str(inverse)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def runs(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes outside ``gap``; none reaches over a bound between texts."""
    free = gap[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    first, last = ~free, ~free
    first[1:] &= free[:-1] | cut[1:-1]
    last[:-1] &= free[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; equal bytes have equal hashes wherever they stand."""
    power, inverse, sums = _power(False), _power(True), np.zeros(len(start), U64)
    for low in range(0, len(data), SEGMENT):
        high = min(len(data), low + SEGMENT)
        running = np.zeros(high - low + 1, U64)
        np.cumsum(table[data[low:high]] * power[: high - low], out=running[1:])
        i, j = np.searchsorted(end, low, "right"), np.searchsorted(start, high, "left")
        if i < j:
            s, e = np.maximum(start[i:j], low) - low, np.minimum(end[i:j], high) - low
            part = (running[e] - running[s]) * inverse[s]
            if start[i] < low:
                part[0] *= U64(pow(_BASE, int(low - start[i]), 1 << 64))
            sums[i:j] += part
    return mix(sums + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The rolling hash of each ``size`` consecutive hashes."""
    if len(hashes) < size:
        return np.zeros(0, U64)
    n = len(hashes) - size + 1
    rolled = hashes[:n].copy()
    for k in range(1, size):
        rolled = rolled * U64(0x2545F4914F6CDD1D) + hashes[k : k + n]
    return mix(rolled)


def parts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j of a text column as (i, j, their bytes back to back, the bounds of the texts); null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SEGMENT, "right")) - 1)
        yield i, j, data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        i = j


def map_texts(
    df: DataFrame,
    measure: Callable[[np.ndarray, np.ndarray], list],
    fields: list[T.StructField],
    text: str = "text",
    carry: list[str] | None = None,
    out: str = "measured",
) -> DataFrame:
    """``df``'s columns ``carry`` (all by default) and a struct ``out`` of what ``measure`` finds in each text.

    ``measure`` gets the bytes of some texts and their bounds and returns one array per field. A column of ``df`` that
    is itself called ``out`` is replaced.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c != out]
    kept = T.StructType([df.schema[c] for c in carry])
    schema = T.StructType([*kept.fields, T.StructField(out, T.StructType(fields))])
    names = [f.name for f in fields]

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for i, j, data, bounds in parts(column):
                found = [x if isinstance(x, pa.Array) else pa.array(x) for x in measure(data, bounds)]
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.StructArray.from_arrays(found, names)], names=[*carry, out]
                )

    return df.select(*(F.col(f"`{c}`") for c in carry), F.col(f"`{text}`").alias("__text__")).mapInArrow(run, schema)
