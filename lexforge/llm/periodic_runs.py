"""Periodic runs of words (operator 13): Karp-Miller-Rosenberg names and grid candidates.

Each position of a text gets a name for every power of two, equal where the words of that
many places from it on are equal; a name is the rank of the pair of names of its halves.
A run of period q has equal words q apart for at least as many places as its grid step, so
that one of the grid's points lies inside; from each such point the names, taken from the
longest down, tell how far the equality reaches to either side. No hash and no suffix
array is used. Texts go through numpy a few megabytes at a time; words of different texts
never share a name, so that one pass holds many texts, and a long text is a pass of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.shared import free_name
from lexforge.llm.words import NON_SPACE, SLICE_BYTES, slices, split

#: Words of a run at least, beside twice its period.
MIN_WORDS = 12
#: Candidates that are looked at in one numpy pass.
CANDIDATES = 1 << 20


def power_names(row: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """Names of the positions for lengths 1, 2, 4 and so on, as far as any name comes twice.

    `row` is the text of each word, in ascending order. A position whose words run past
    its text, or whose name comes once, has a name of its own; those need no further ranking.
    """
    n = len(ids)
    own = np.arange(n, dtype=np.int64)
    keys = row.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    at, out, size = own, [], 1
    while True:
        _, rank, times = np.unique(keys, return_inverse=True, return_counts=True)
        names = n + own
        again = times[rank] > 1
        names[at[again]] = rank[again]
        if not again.any():
            return out
        out.append(names)
        # Of twice the length only those can come twice of which both halves do.
        at = at[again]
        at = at[at + size < n]
        at = at[(names[at + size] < n) & (row[at] == row[at + size])]
        keys = names[at] * n + names[at + size]
        size *= 2


def reach(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many places from `a` and `b` on (step 1), or before them (step -1), have equal words; a < b."""
    n = len(names[0]) if names else 0
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in range(len(names) - 1, -1, -1):
        size, name = 1 << level, names[level]
        at = np.flatnonzero((b < n) if step > 0 else (a >= size))
        # Equal names of the longest level can follow each other, those of lower ones only once.
        while len(at):
            x, y = (a[at], b[at]) if step > 0 else (a[at] - size, b[at] - size)
            at = at[name[x] == name[y]]
            a[at] += step * size
            b[at] += step * size
            out[at] += size
            if level < len(names) - 1:
                break
            at = at[(b[at] < n) if step > 0 else (a[at] >= size)]
    return out


@dataclass
class Runs:
    """Runs of a slice of texts, by text, start and period; start counts words from the text's first."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _grids(counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the grid's points, about CANDIDATES at a time.

    The equality of a run of period q spans max(q, least - q) places or more, so that a
    point in each so many places meets it.
    """
    longest = int(counts.max(initial=0))
    block: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0
    alive = np.argsort(-counts, kind="stable")
    sizes = -counts[alive]  # ascending
    for period in range(1, longest // 2 + 1):
        step = max(period, least - period)
        rows = alive[: np.searchsorted(sizes, -max(2 * period, least), side="right")]
        if not len(rows):
            return
        points = (counts[rows] - period + step - 1) // step
        first = np.cumsum(points) - points
        place = (np.arange(int(points.sum())) - np.repeat(first, points)) * step
        block.append((np.repeat(rows, points), place, np.full(len(place), period)))
        held += len(place)
        if held >= CANDIDATES:
            yield tuple(map(np.concatenate, zip(*block, strict=True)))
            block, held = [], 0
    if block:
        yield tuple(map(np.concatenate, zip(*block, strict=True)))


def find_runs(row: np.ndarray, counts: np.ndarray, ids: np.ndarray, least: int = MIN_WORDS) -> Runs:
    """All runs: stretches of smallest period q and length max(least, 2 q) or more that no neighbour extends."""
    base = np.cumsum(counts) - counts
    names = power_names(row, ids)
    found = []
    if names:
        for text, place, period in _grids(counts, least):
            a = base[text] + place
            some = np.flatnonzero(names[0][a] == names[0][a + period])
            a, text, period = a[some], text[some], period[some]
            ahead = reach(names, a, a + period, 1)
            back = reach(names, a, a + period, -1)
            some = np.flatnonzero(ahead + back >= np.maximum(period, least - period))
            a, text, period, ahead, back = (x[some] for x in (a, text, period, ahead, back))
            found.append(np.stack([text, a - back - base[text], ahead + back + period, period]))
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none)
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, text))  # of one stretch, the smallest period comes first
    text, start, length, period = (x[order] for x in (text, start, length, period))
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    text, start, length, period = (x[new] for x in (text, start, length, period))
    order = np.lexsort((period, start, text))
    return Runs(*(x[order] for x in (text, start, length, period)))


def kept_words(runs: Runs, counts: np.ndarray) -> np.ndarray:
    """False for words that a run holds after its first period."""
    base = np.cumsum(counts) - counts
    edge = np.zeros(int(counts.sum()) + 1, np.int64)
    np.add.at(edge, base[runs.row] + runs.start + runs.period, 1)
    np.add.at(edge, base[runs.row] + runs.start + runs.length, -1)
    return np.cumsum(edge[:-1]) == 0


SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string, collapsed_sha256 string"


def _slice_runs(part: pa.RecordBatch, text: str, least: int, keep_text: bool) -> dict[str, list]:
    w = split(part.column(text), NON_SPACE, fold=False)
    runs = find_runs(w.row, w.counts, w.ids, least)
    kept = kept_words(runs, w.counts)
    # The kept words of each text, with one space between: the byte before a kept word that isn't a text's first is white space.
    bytes_kept = np.zeros(len(w.raw) + 1, np.int64)
    np.add.at(bytes_kept, w.start[kept], 1)
    np.add.at(bytes_kept, w.end[kept], -1)
    mask = np.cumsum(bytes_kept[:-1]) > 0
    raw = w.raw.copy()
    first = np.zeros(len(kept), bool)
    first[w.first[:-1][w.counts > 0]] = True  # a text's first word is never dropped
    gaps = w.start[kept & ~first] - 1
    mask[gaps], raw[gaps] = True, 0x20
    bounds = np.concatenate([[0], np.cumsum(mask)])[w.offsets]
    body = raw[mask].tobytes()
    lines = [f"{s},{k},{p}\n" for s, k, p in zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True)]
    edges = np.searchsorted(runs.row, np.arange(part.num_rows + 1)).tolist()
    best = np.lexsort((runs.period, runs.start, -runs.length, runs.row))
    out: dict[str, list] = {x.split()[0]: [] for x in SCHEMA.split(", ")}
    for i in range(part.num_rows):
        low, high = edges[i], edges[i + 1]
        collapsed = body[bounds[i] : bounds[i + 1]]
        own = (None,) * 4
        if high > low:
            b = best[low]  # runs are sorted by text, so its best one stands where its runs begin
            own = (int(runs.start[b]), int(runs.length[b]), int(runs.period[b]), int(1000 * runs.length[b] // runs.period[b]))
        row = (high - low, *own, hashlib.sha256("".join(lines[low:high]).encode()).hexdigest(), collapsed.decode() if keep_text else None, hashlib.sha256(collapsed).hexdigest())
        for column, value in zip(out.values(), row, strict=True):
            column.append(value)
    return out


def periodic_runs(docs: DataFrame, text: str = "text", least: int = MIN_WORDS, keep_text: bool = True) -> DataFrame:
    """`docs` without the text, and what periodic runs its words `[^\\x20\\x09-\\x0D]+` hold.

    n_runs; start, length, period and exponent_milli of the longest run (of equal ones the
    first, then the shortest period); runs_sha256 over the lines `start,length,period` of all
    runs; collapsed, the text without the words that a run holds after its first period (null
    unless `keep_text`), and collapsed_sha256. A column of `docs` with such a name keeps its name,
    and the new one gets an underscore.

    Null, empty and blank texts have no run, null values for the longest one, and the digest of
    nothing. Repeated rows are each judged, an empty table stays empty. A text of any length is
    read whole in one pass; it takes 8 bytes a word for each power of two up to its longest
    repeated passage, beside some 30 bytes for each of its bytes.
    """
    others = [c for c in docs.columns if c != text]
    fields = T.StructType.fromDDL(SCHEMA).fields
    renamed = [T.StructField(free_name(f.name, others), f.dataType) for f in fields]
    schema = T.StructType([docs.schema[c] for c in others] + renamed)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.string()] * 3
        for part in slices(batches, text, SLICE_BYTES):
            found = _slice_runs(part, text, least, keep_text)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in others] + [pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], names=[*others, *(f.name for f in renamed)]
            )

    return docs.mapInArrow(work, schema)


def plant_period(text: Column, key: Column) -> Column:
    """`text`, or for a tenth of the keys its words repeated from a place and with a period that the key's checksum gives.

    Null and blank texts, and null keys, are left as they are.
    """
    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    h = F.crc32(key.cast("string").cast("binary"))
    g, n = F.floor(h / 10).cast("long"), F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    return F.when((h % 10 == 0) & F.coalesce(F.regexp_like(text, F.lit("[^\\x20\\x09-\\x0D]")), F.lit(False)), F.array_join(made, " ")).otherwise(text)
