"""Benchmark decontamination over a distributed positional inverted index (operator 5).

`build_index` stores the postings of all training tokens, cut by documents into
segments: a segment is one row that holds its vocabulary and, for each term, the
ascending list of positions. `search` takes the benchmark in bounded blocks, and in each
segment intersects the offset-adjusted lists of a phrase from its rarest term on. A
segment holds whole documents and is bounded by its bytes of text, so neither step
shuffles, and a term that every document has is no hot key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.shared import settle
from lexforge.llm.words import ALNUM, SLICE_BYTES, slices, split

#: Words of benchmark text that one pass over the index takes along.
BLOCK_WORDS = 1_000_000
#: Candidate positions that are intersected at a time.
CANDIDATES = 1 << 20


def _index_schema(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("segment", T.StringType()), T.StructField("keys", T.ArrayType(key)), T.StructField("first", T.BinaryType()),
        T.StructField("terms", T.BinaryType()), T.StructField("lists", T.BinaryType()), T.StructField("positions", T.BinaryType()),
    ])


def _segments(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for number, part in enumerate(slices(batches, "text", limit)):
        w = split(part.column("text"), ALNUM, fold=True)
        order = np.argsort(w.ids, kind="stable").astype(np.int32)
        lists = np.zeros(len(w.vocabulary) + 1, np.int32)
        np.cumsum(np.bincount(w.ids, minlength=len(w.vocabulary)), out=lists[1:])
        keys = part.column("key")
        yield pa.RecordBatch.from_arrays([
            pa.array([f"{task}-{number}"]), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            pa.array([w.first.astype("<i4").tobytes()]), pa.array([b" ".join(w.vocabulary.to_pylist())]),
            pa.array([lists.astype("<i4").tobytes()]), pa.array([order.astype("<i4").tobytes()]),
        ], names=["segment", "keys", "first", "terms", "lists", "positions"])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """The stored index of `docs`, a row per segment; null texts have no postings."""
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return settle(picked.mapInArrow(partial(_segments, limit=limit), _index_schema(picked.schema["key"].dataType)), "postings")


class Phrases:
    """A block of benchmark items as windows over a block vocabulary."""

    def __init__(self, items: list[str], texts: list[str | None], window: int) -> None:
        w = split(pa.array(texts, pa.string()), ALNUM, fold=True)
        self.terms = w.vocabulary.to_pylist()
        found: dict[tuple[int, ...], set[str]] = {}
        rows: Counter[tuple[int, ...]] = Counter()
        for i, item in enumerate(items):
            own = w.ids[w.first[i] : w.first[i + 1]].tolist()
            windows = {tuple(own[at : at + window]) for at in range(max(1, len(own) - window + 1) if own else 0)}
            rows.update(windows)
            for x in windows:
                found.setdefault(x, set()).add(item)
        self.groups = []  # (windows of one length as a matrix of terms, the items of each, the benchmark rows of each)
        for n in sorted({len(x) for x in found}):
            same = [x for x in found if len(x) == n]
            self.groups.append((np.array(same, np.int32), [sorted(found[x]) for x in same], np.array([rows[x] for x in same], np.int64)))


def _matches(windows: np.ndarray, lists: np.ndarray, keys: np.ndarray, first: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(window, document, start, exact) for each start for which every term of a window stands in the document within `slop` words of its offset from there.

    Candidates are the starts within `slop` of where the rarest term puts them; every term is then looked for alike, so
    that the result does not depend on which term is the rarest of a segment. With `slop` a start may lie before or behind the document's words.
    """
    n = windows.shape[1]
    windows_at = np.flatnonzero((windows >= 0).all(axis=1))
    lengths = lists[windows[windows_at] + 1] - lists[windows[windows_at]]
    rarest = np.argsort(lengths, axis=1, kind="stable")
    load = lengths[np.arange(len(windows_at)), rarest[:, 0]].astype(np.int64)
    chunk = (np.cumsum(load) - load) * (2 * slop + 1) // CANDIDATES
    terms, offsets = windows[windows_at], rarest
    wide = int(first[-1]) + 2 * (n + slop + 1)
    for c in np.unique(chunk):
        rows = np.flatnonzero(chunk == c)
        win = np.repeat(rows, load[rows])
        lead = terms[rows, offsets[rows, 0]]
        inside = np.arange(len(win)) - np.repeat(np.cumsum(load[rows]) - load[rows], load[rows])
        at = (keys[np.repeat(lists[lead], load[rows]) + inside] & 0xFFFFFFFF).astype(np.int64)
        doc = np.searchsorted(first, at, "right") - 1
        start = at - offsets[win, 0]
        if slop:
            start = (start[:, None] + np.arange(-slop, slop + 1)).ravel()
            win, doc = np.repeat(win, 2 * slop + 1), np.repeat(doc, 2 * slop + 1)
            _, once = np.unique((win * len(first) + doc) * wide + (start + n + slop), return_index=True)
            win, doc, start = win[once], doc[once], start[once]
        exact = np.ones(len(win), bool)
        for k in range(0 if slop else 1, n):
            term = terms[win, offsets[win, k]].astype(np.int64) << 32
            place = start + offsets[win, k]
            low, high = np.maximum(place - slop, first[doc]), np.minimum(place + slop, first[doc + 1] - 1)
            here = keys[np.minimum(np.searchsorted(keys, term | low), len(keys) - 1)]
            near = (low <= high) & (here >= (term | low)) & (here <= (term | high))
            if slop:
                inner = (place >= first[doc]) & (place < first[doc + 1])
                there = keys[np.minimum(np.searchsorted(keys, term | np.maximum(place, 0)), len(keys) - 1)]
                exact &= inner & (there == (term | np.maximum(place, 0)))
            win, start, doc, exact = win[near], start[near], doc[near], exact[near]
        if not slop:  # the rarest term's own place is in the document, and the others' are by the look-up
            whole = (start >= first[doc]) & (start + n <= first[doc + 1])
            win, start, doc, exact = win[whole], start[whole], doc[whole], exact[whole]
        yield windows_at[win], doc, start, exact


def _search(batches: Iterator[pa.RecordBatch], block, slop: int, hits_only: bool = False) -> Iterator[pa.RecordBatch]:
    phrases: Phrases = block.value
    for batch in batches:
        for r in range(batch.num_rows):
            first = np.frombuffer(batch.column("first")[r].as_py(), "<i4").astype(np.int64)
            lists = np.frombuffer(batch.column("lists")[r].as_py(), "<i4")
            positions = np.frombuffer(batch.column("positions")[r].as_py(), "<i4")
            known = {t: i for i, t in enumerate(batch.column("terms")[r].as_py().split(b" "))} if len(lists) > 1 else {}
            mapped = np.array([known.get(t, -1) for t in phrases.terms] or [-1], np.int32)
            keys = (np.repeat(np.arange(len(lists) - 1, dtype=np.int64), np.diff(lists)) << 32) | positions
            n_docs = len(first) - 1
            edge, items, near = np.zeros(first[-1] + 1, np.int32), [set() for _ in range(n_docs)], np.zeros(n_docs, np.int64)
            for windows, owners, rows in phrases.groups if len(keys) else []:
                for win, doc, start, exact in _matches(mapped[windows], lists, keys, first, slop):
                    np.add.at(near, doc[~exact], rows[win[~exact]])
                    win, start, doc = win[exact], start[exact], doc[exact]
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + windows.shape[1], -1)
                    for pair in np.unique(doc * len(owners) + win):
                        items[pair // len(owners)].update(owners[pair % len(owners)])
            marks = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            spans: list[list[dict]] = [[] for _ in range(n_docs)]
            if len(marks):
                doc = np.searchsorted(first, marks, "right") - 1
                new = np.r_[True, (np.diff(marks) > 1) | (np.diff(doc) > 0)]
                for low, high, d in zip(marks[new], marks[np.r_[np.flatnonzero(new)[1:] - 1, len(marks) - 1]], doc[new], strict=True):
                    spans[d].append({"start": int(low - first[d]), "end": int(high - first[d]) + 1})
            found = pa.RecordBatch.from_arrays([
                batch.column("keys").slice(r, 1).flatten(), pa.array(np.diff(first)),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(near),
                pa.array([f"{batch.column('segment')[r]}:{i}" for i in range(n_docs)], pa.string()),
            ], names=["key", "n_words", "spans", "items", "n_near", "place"])
            yield found.filter(pa.array([bool(x) or m > 0 for x, m in zip(items, near.tolist(), strict=True)], pa.bool_())) if hits_only else found


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark in blocks of bounded size, read one partition at a time."""
    items, texts, words = [], [], 0
    for r in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        items.append(r.i if r.i is not None else "")
        texts.append(r.t)
        words += len(r.t or "") // 2
        if words >= block_words:
            yield Phrases(items, texts, window)
            items, texts, words = [], [], 0
    if items:
        yield Phrases(items, texts, window)


def search(index: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0, key: str = "doc_id", item: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per indexed document: key, n_words, spans (of hit words, end exclusive), items, n_near.

    A window is `window` consecutive words of an item, or all of an item that has
    fewer. `spans` covers the words inside exact occurrences, `items` lists the items
    that they come from. `n_near` counts, for each benchmark row and each of its different windows, the starts for which
    every term stands in the document within `slop` words of its offset from there, but not all of them exactly. A benchmark of several blocks
    costs a pass over the index for each, one after another: a pass is written, of the later ones the documents
    with hits alone, and its broadcast is freed before the next block is read. The results meet by document.
    """
    kind = index.schema["keys"].dataType.elementType
    schema = T.StructType([
        T.StructField("key", kind), T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("n_near", T.LongType()), T.StructField("place", T.StringType()),
    ])
    blocks = benchmark_blocks(benchmark, item, text, window, block_words)
    phrases, after = next(blocks, Phrases([], [], window)), next(blocks, None)
    passes = []
    while phrases is not None:
        block = index.sparkSession.sparkContext.broadcast(phrases)
        one = index.mapInArrow(partial(_search, block=block, slop=slop, hits_only=bool(passes)), schema)
        if after is not None or passes:
            one = settle(one, "hits")
            block.destroy()
        passes.append(one)
        phrases, after = after, next(blocks, None)
    out = passes[0]
    if len(passes) > 1:
        for more in passes[1:]:
            out = out.unionByName(more)
        merged = F.aggregate(
            F.array_sort(F.flatten(F.collect_list("spans"))), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
            lambda done, s: F.when((F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]), F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
            )).otherwise(F.concat(done, F.array(s))),
        )
        out = out.groupBy("place").agg(
            F.first("key").alias("key"), F.first("n_words").alias("n_words"), merged.alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.sum("n_near").alias("n_near"),
        )
    return out.select(F.col("key").alias(key), "n_words", "spans", "items", "n_near")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0, key: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Index `docs`, search it for `benchmark`, and report a row per document.

    Columns: key, n_words, n_hit, n_items, items, spans, n_near, contaminated. Null and
    empty texts have no words and are clean; repeated rows are each reported; a null
    item_id counts as an empty name; an empty benchmark hits nothing; columns other
    than those named are not read.
    """
    found = search(build_index(docs, key, text), benchmark, window, slop, key, block_words=block_words)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans", "n_near", (F.size("spans") > 0).alias("contaminated"),
    )
