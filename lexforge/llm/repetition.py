"""Repetition coverage (operator 3): characters inside duplicated n-grams and lines.

Texts go through numpy a few megabytes at a time. Words and lines are numbered exactly;
an n-gram is a polynomial hash over its word numbers, rolled on from one length to the
next and mixed with the row, so that one sort finds the repeats of a whole slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.words import NON_SPACE, Words, lut, mix, slices, split

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
CONTINUES = lut([(0x80, 0xBF)])
#: Multiplier of the rolling hash.
BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionRules:
    """Largest allowed shares of a text's word characters (the published Gopher limits).

    `top`: share inside the most frequent n-gram, where that comes twice or more.
    `repeated`: share inside n-grams that stand earlier in the text. `lines` and
    `line_chars`: share of lines, and of characters in lines, that repeat an earlier line.
    """

    min_words: int = 50
    repeat_percent: int = 50
    lines: float = 0.30
    line_chars: float = 0.20
    top: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    repeated: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})


def _sum_rows(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs first[i]:first[i+1]; runs may be empty."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[first])


def _covered(at: np.ndarray, n: int, words: int) -> np.ndarray:
    edge = np.zeros(words + 1, np.int64)
    edge[: words + 1] += np.bincount(at, minlength=words + 1)
    edge -= np.bincount(at + n, minlength=words + 1)
    return np.cumsum(edge[:-1]) > 0


class _Grams:
    """Equal n-grams within rows: start, rank among equal ones, and how many those are.

    Only grams that can repeat are looked at: those whose (n-1)-grams at both ends do.
    """

    def __init__(self, words: np.ndarray, row: np.ndarray, salt: np.ndarray, n: int, shorter: _Grams | None = None) -> None:
        if shorter is None:
            self.at = np.flatnonzero(row[: max(0, len(row) - n + 1)] == row[n - 1 :])
        else:
            twice = np.zeros(len(row) + 1, bool)
            twice[shorter.at[shorter.size > 1]] = True
            at = np.flatnonzero(twice[:-1] & twice[1:])
            self.at = at[row[at] == row[np.minimum(at + n - 1, len(row) - 1)]] if len(at) else at
            self.at = self.at[self.at + n <= len(row)]
        # The hash rolls on from one length to the next: h_n = h_(n-1) * BASE + last word.
        self.rolled = shorter.rolled if shorter else words.copy()
        for k in range(1, n) if shorter is None else [n - 1]:
            self.rolled[self.at] = self.rolled[self.at] * BASE + words[self.at + k]
        h = mix(self.rolled[self.at]) ^ salt[row[self.at]]
        order = np.argsort(h, kind="stable")
        h = h[order]
        new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        run = np.diff(np.r_[begin, len(h)])
        self.rank, self.size = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        self.rank[order] = np.arange(len(h)) - np.repeat(begin, run)
        self.size[order] = np.repeat(run, run)


def _lines(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, repeats an earlier one, first word, word after the last) of each line with a word."""
    cut = np.zeros(len(w.raw), bool)
    cut[w.raw == 0x0A] = True
    begins = np.union1d(w.offsets[:-1][w.offsets[:-1] < w.offsets[1:]], np.flatnonzero(cut) + 1)
    begins = begins[begins < len(w.raw)]
    if not len(begins):
        return (np.zeros(0, np.int64), np.zeros(0, bool), begins, begins)
    ends = np.r_[begins[1:], len(w.raw)].astype(np.int64)
    ends = ends - cut[ends - 1]
    low, high = np.searchsorted(w.start, begins), np.searchsorted(w.start, ends)
    used = high > low
    begins, ends, low, high = begins[used], ends[used], low[used], high[used]
    row = np.searchsorted(w.offsets, begins, "right") - 1
    bounds = np.zeros(2 * len(begins) + 1, np.int32)
    bounds[1::2], bounds[2::2] = ends, np.r_[begins[1:], len(w.raw)][: len(begins)] if len(begins) else ends
    bounds[0] = begins[0] if len(begins) else 0
    texts = pa.Array.from_buffers(pa.binary(), 2 * len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(w.raw))])
    ids = texts.take(pa.array(np.arange(0, 2 * len(begins), 2))).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = row * (ids.max(initial=0) + 1) + ids
    _, seen_first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[seen_first] = False
    return row, again, low, high


def _measure(batches: Iterator[pa.RecordBatch], rules: RepetitionRules) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        w = split(part.column("text"), NON_SPACE, fold=False)
        n_rows, n_words = part.num_rows, len(w.ids)
        points = np.concatenate([[0], np.cumsum(~CONTINUES[w.raw], dtype=np.int64)])
        chars = points[w.end] - points[w.start]
        word_chars = _sum_rows(chars, w.first)
        symbols = _sum_rows(SYMBOLS[w.raw], w.offsets)
        words = mix(w.ids + 1)
        salt = mix(np.arange(n_rows, dtype=np.uint64))
        share = lambda x: x / np.maximum(word_chars, 1)

        row, again, low, high = _lines(w)
        dup_lines = np.bincount(row[again], minlength=n_rows)
        n_lines = np.bincount(row, minlength=n_rows)
        total = np.concatenate([[0], np.cumsum(chars)])
        in_lines = np.bincount(row[again], (total[high] - total[low])[again], n_rows)
        line_share, line_char_share = dup_lines / np.maximum(n_lines, 1), share(in_lines)
        good = (line_share <= rules.lines) & (line_char_share <= rules.line_chars)

        repeat_words, worst, g = np.zeros(n_rows, np.int64), np.zeros(n_rows), None
        for n in range(2, max([3, *rules.top, *rules.repeated]) + 1):
            g = _Grams(words, w.row, salt, n, g)
            again = g.size > 1
            if n == 3:
                repeat_words = _sum_rows(_covered(g.at[again], 3, n_words), w.first)
            shares = []
            if n in rules.top:
                at, size = g.at[again], g.size[again]
                top = np.zeros(n_rows, np.int64)
                most = np.zeros(n_rows, np.int64)
                np.maximum.at(most, w.row[at], size)
                best = size == most[w.row[at]]
                np.maximum.at(top, w.row[at][best], (size * (total[at + n] - total[at]))[best])
                shares.append((np.minimum(share(top), 1.0), rules.top[n]))
            if n in rules.repeated:
                inside = _covered(g.at[g.rank > 0], n, n_words)
                shares.append((share(_sum_rows(chars * inside, w.first)), rules.repeated[n]))
            for got, limit in shares:
                good &= got <= limit
                worst = np.maximum(worst, got)
        failed = (w.counts < rules.min_words) | (100 * repeat_words > rules.repeat_percent * w.counts)
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), *map(pa.array, (w.counts, word_chars, symbols, dup_lines, repeat_words, failed, ~failed & good, line_share, line_char_share, worst))],
            names=["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_share", "dup_line_char_share", "worst_gram_share"],
        )


def repetition(docs: DataFrame, rules: RepetitionRules | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Repetition measures and a verdict per row.

    Words are runs of characters other than space and 0x09-0x0D. A null or empty text
    has no words and so fails the base rules. Repeated rows are measured each; ties
    between most frequent n-grams go to the one with most characters; other columns
    are not read; an empty table gives an empty result.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    out = picked.mapInArrow(partial(_measure, rules=rules or RepetitionRules()), (
        f"key {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "kept boolean, dup_line_share double, dup_line_char_share double, worst_gram_share double"
    ))
    return out.withColumnRenamed("key", key)
