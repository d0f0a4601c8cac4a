"""Quality rules: how much of a text lies inside n-grams and lines that it repeats.

Rolling hashes of several n-gram lengths are taken over the word hashes of a text; a word counts as repeated when it
lies in an n-gram found at least twice in that text. Coverage is measured in characters, so it is comparable across
lengths. Each text is measured on its own, inside a task: no shuffle, and memory follows the longest text.

Null and empty texts have no words: all counts 0, coverage 0, and they fail the rule on the number of words. Repeated
rows are measured once each. Extra columns pass through; a column that has the name of the result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.words import BLANK, NEWLINE, U64, map_texts, mix, run_hashes, runs, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Limits; a share is of the characters in words (for lines: of all characters in lines)."""

    least_words: int = 50
    most_repeated_words: int = 50  # percent of the words that lie in repeated 3-word windows
    most_line_share: float = 0.20
    #: n-gram length and the largest share of characters in repeated n-grams of that length: twice the limits that
    #: are common where, unlike here, the first occurrence does not count
    most_gram_share: tuple[tuple[int, float], ...] = ((5, 0.30), (7, 0.26), (10, 0.20))


def _per_text(amount: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``amount`` between consecutive positions ``at``."""
    return np.diff(np.concatenate([[0], np.cumsum(amount, dtype=np.int64)])[at])


def _twice(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys their text has at least twice, and which it has had before."""
    keys = keys ^ mix(owner.astype(U64) + U64(1))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, again


def measure(lengths: tuple[int, ...]):
    def of(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        texts = len(bounds) - 1
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
        start, end = runs(data, bounds)
        at, hashes, chars = np.searchsorted(start, bounds), run_hashes(data, start, end), points[end] - points[start]
        owner = np.repeat(np.arange(texts), np.diff(at))

        covered = []
        for size in (3, *lengths):
            rolled, n = windows(hashes, size), len(hashes) - size + 1
            inside = np.zeros(len(hashes) + 1, np.int32)
            if n > 0:
                whole = np.flatnonzero(owner[:n] == owner[size - 1 :])  # windows within one text
                found = whole[_twice(rolled[whole], owner[whole])[0]]
                np.add.at(inside, found, 1)
                np.add.at(inside, found + size, -1)
            covered.append(np.cumsum(inside[:-1]) > 0)

        first, last = runs(data, bounds, NEWLINE)
        filled = np.concatenate([[0], np.cumsum(~BLANK[data], dtype=np.int64)])
        worded = filled[last] > filled[first]
        first, last = first[worded], last[worded]
        lines = np.searchsorted(first, bounds)
        again = _twice(run_hashes(data, first, last), np.repeat(np.arange(texts), np.diff(lines)))[1]
        width = points[last] - points[first]
        return [
            np.diff(at),
            _per_text(chars, at),
            _per_text(SYMBOLS[data], bounds),
            _per_text(again, lines),
            _per_text(covered[0], at),
            _per_text(width, lines),
            _per_text(width * again, lines),
            *(_per_text(chars * c, at) for c in covered[1:]),
        ]

    return of


def repetition(
    docs: DataFrame, rules: Rules = Rules(), text: str = "text", carry: list[str] | None = None, out: str = "quality"
) -> DataFrame:
    """The columns ``carry`` of ``docs`` and a struct ``out`` of the counts, ``base_failed`` and ``kept``."""
    lengths = tuple(n for n, _ in rules.most_gram_share)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "dup_line_chars"]
    names += [f"dup_{n}gram_chars" for n in lengths]
    measured = map_texts(
        docs, measure(lengths), [T.StructField(n, T.LongType()) for n in names], text, carry, out
    )
    q = lambda name: F.col(out)[name]
    failed = (q("n_words") < rules.least_words) | (
        100 * q("n_repeat_words") > rules.most_repeated_words * q("n_words")
    )
    kept = ~failed & _share(q("dup_line_chars"), q("line_chars"), rules.most_line_share)
    for n, most in rules.most_gram_share:
        kept &= _share(q(f"dup_{n}gram_chars"), q("word_chars"), most)
    return measured.withColumn(out, F.col(out).withField("base_failed", failed).withField("kept", kept))


def _share(part: Column, whole: Column, most: float) -> Column:
    return 100 * part <= round(100 * most) * whole


def rejected_removed(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    name = "quality"
    while name in docs.columns:
        name += "_"
    return repetition(docs, rules, text, out=name).where(F.col(name)["kept"]).drop(name)
