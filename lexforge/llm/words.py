"""Whole Arrow string columns to words, with numpy on the UTF-8 bytes.

All separators the operators use are ASCII, and every byte of a multi-byte
character is above 0x7F, so splitting the bytes equals splitting the code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

#: Bytes of text that one numpy pass handles; bounds the memory of a Python worker.
SLICE_BYTES = 4 << 20


def lut(pattern_bytes: list[tuple[int, int]]) -> np.ndarray:
    """A 256-entry table that is True for the given inclusive byte ranges."""
    out = np.zeros(256, dtype=bool)
    for low, high in pattern_bytes:
        out[low : high + 1] = True
    return out


#: Everything but space and the controls 0x09 to 0x0D.
NON_SPACE = ~lut([(0x20, 0x20), (0x09, 0x0D)])
#: Digits, ASCII letters (folded below) and all of the bytes above ASCII.
ALNUM = lut([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: A-Z to a-z, other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of the rows); null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


@dataclass
class Spans:
    """Where the words of a run of rows stand."""

    row: np.ndarray  # int64, the row that a word stands in
    counts: np.ndarray  # int64, words of each row
    first: np.ndarray  # int64, index of each row's first word; one more at the end
    start: np.ndarray  # int64, byte where a word starts
    end: np.ndarray  # int64, byte after a word
    raw: np.ndarray  # uint8, all bytes of the rows
    offsets: np.ndarray  # int64, where each row starts in raw
    inside: np.ndarray  # bool, the bytes of words


@dataclass
class Words(Spans):
    """Spans whose words are numbered: `ids` counts the distinct words from 0."""

    ids: np.ndarray  # int32, one per word
    vocabulary: pa.Array  # binary, the distinct words


def spans(texts: pa.Array, keep: np.ndarray, cut: tuple[np.ndarray, np.ndarray] | None = None) -> Spans:
    """Words as maximal runs of `keep` bytes inside each row; with `cut`, they also end between a byte of the first table and one of the second."""
    raw, offsets = text_bytes(texts)
    inside = np.zeros(len(raw) + 1, dtype=bool)
    inside[:-1] = keep[raw]
    begins, ends = inside[:-1].copy(), inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends &= ~inside[1:]
    if cut:
        between = cut[0][raw[:-1]] & cut[1][raw[1:]]
        begins[1:] |= between
        ends[:-1] |= between
    full = offsets[:-1] < offsets[1:]
    edge, last = offsets[:-1][full], offsets[1:][full] - 1  # words do not run on into the next row
    begins[edge], ends[last] = inside[edge], inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    counts = np.diff(first)
    return Spans(np.repeat(np.arange(len(counts)), counts), counts, first, start, end, raw, offsets, inside[:-1])


def split(texts: pa.Array, keep: np.ndarray, fold: bool, cut: tuple[np.ndarray, np.ndarray] | None = None) -> Words:
    """The same with the words numbered exactly, A-Z as a-z if `fold`."""
    w = spans(texts, keep, cut)
    kept = (FOLD[w.raw] if fold else w.raw)[w.inside]
    bounds = np.zeros(len(w.start) + 1, np.int32)
    np.cumsum(w.end - w.start, out=bounds[1:])
    words = pa.Array.from_buffers(pa.binary(), len(w.start), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(kept))])
    coded = words.dictionary_encode()
    return Words(**vars(w), ids=coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False), vocabulary=coded.dictionary)


def word_hashes(w: Spans, fold: bool) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every task: eight bytes a step."""
    padded = np.zeros(len(w.raw) + 8, np.uint8)
    padded[:-8] = FOLD[w.raw] if fold else w.raw
    eight = np.ndarray((len(w.raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = w.end - w.start
    out = mix(size)
    for step in range(8):
        at = np.flatnonzero(size > 8 * step)
        if not len(at):
            return out
        left = np.minimum(size[at] - 8 * step, 8).astype(np.uint64)
        block = eight[w.start[at] + 8 * step] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        out[at] = mix(out[at] ^ block)
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = xxhash.xxh3_64_intdigest(padded[w.start[i] : w.end[i]].tobytes())
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about `limit` bytes of text; a longer text is a run of its own."""
    for batch in batches:
        column = batch.column(text)
        lengths = np.asarray(pa.compute.binary_length(column).fill_null(0)).astype(np.int64)
        block = (np.cumsum(lengths) - lengths) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if high > low:
                yield batch.slice(low, high - low)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over uint64 values."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start index) of each n-gram that lies inside one row; words: uint64 hashes of the words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rolled = np.zeros(m, np.uint64)
    for k in range(n):
        rolled = rolled * np.uint64(0x100000001B3) + words[k : k + m]
    at = np.flatnonzero(row[:m] == row[n - 1 :])
    return mix(rolled[at]), at
