"""Language identification by prediction by partial matching (operator 1).

For each language a context tree over bytes is counted up to `order` bytes deep, and then
frozen. A byte that follows a context costs -log2 of its probability: seen there, its
count over the total with one escape count for each distinct byte (method C); not
seen there, the escape probability, and the question goes on to the context that is one
byte shorter, down to 1/256 for each byte. The cost of a text in a language is the
exact sum over its bytes; the cheapest language is predicted.

As statistics are frozen, a byte's cost depends on the last `order` bytes and itself, so a
tree is laid out as a table of states: a state is the longest suffix of the history that
the tree has as a context, and each (state, byte) holds the cost. Where the alphabet makes that table too large,
only what was seen is kept, at equal costs. Each language has its own
alphabet and tree, so that a model grows with the number of languages and not with its square.
Costs are whole numbers of 2^-22 bits: sums are exact, whatever the order and the cuts.

A text is scored in windows of `WINDOW_BYTES` that take the `order` bytes before them along,
so a text of any length needs the memory of one window beside its own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lexforge.llm.shared import free_name, settle
from lexforge.llm.words import slices, text_bytes

UNKNOWN = "und"
#: A model is fitted on at most so many labelled rows of each language, and so many bytes of them.
SAMPLE_ROWS, SAMPLE_BYTES = 400, 2 << 20
#: Of one text so many bytes are learned from, so that a very long one isn't the whole sample.
TEXT_BYTES = 1 << 17
#: Bytes for which a score weighs the languages against each other (fewer if a text has fewer).
SCORE_BYTES = 64
#: Bytes that one pass scores, and bytes of text that are handled together.
WINDOW_BYTES = 1 << 18
#: Costs are counted in this part of a bit.
UNIT = float(1 << 22)
#: A tree is laid out as a table while that takes no more than so much, and else keeps what it has seen alone.
DENSE_BYTES = 32 << 20
#: Trees that are broadcast together; a single larger one goes alone.
GROUP_BYTES = 64 << 20
#: A task keeps all trees in memory up to this size, and else takes one group after another over TURN_BYTES of text.
MODEL_BYTES, TURN_BYTES = 512 << 20, 16 << 20


class Contexts:
    """What one language's sample holds: its alphabet, its contexts up to `order` symbols, and how often each symbol follows."""

    def __init__(self, texts: list[bytes], order: int) -> None:
        """Symbol 0 stands before the start of a text, and 1 for all bytes that no text has."""
        used = sorted({b for t in texts for b in set(t)})
        self.order, self.size = order, len(used) + 2
        if self.size ** (order + 1) >= 1 << 63:
            raise ValueError(f"an order of {order} is too high for an alphabet of {self.size}")
        self.symbol = np.ones(256, np.int32)
        self.symbol[used] = np.arange(2, self.size)
        start, parts = np.zeros(order, np.int32), []
        for t in texts:
            parts += [start, self.symbol[np.frombuffer(t, np.uint8)]]
        flat = np.concatenate(parts or [start])
        at = np.flatnonzero(flat)  # only start symbols are 0
        self.last = flat[at].astype(np.int64)
        # Codes of length k are numbers to the base `size`; one state per context that is there.
        self.codes = [np.zeros(len(at), np.int64)]
        for k in range(1, order + 1):
            self.codes.append(self.codes[-1] + flat[at - k].astype(np.int64) * self.size ** (k - 1))
        self.seen = [np.unique(c) if len(c) else np.zeros(1 - min(k, 1), np.int64) for k, c in enumerate(self.codes)]

    @property
    def table_bytes(self) -> int:
        """Size of the tree as a table."""
        return 4 * (self.size**self.order + sum(map(len, self.seen)) * self.size)


class Tree:
    """Frozen statistics of one language."""

    order: int
    size: int
    symbol: np.ndarray

    def context_codes(self, history: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of the `order` symbols before each byte of `history` behind its first `order`, that byte's symbol); `starts` are the places where texts begin, of those too."""
        n = len(history) - self.order
        symbols = self.symbol[history]
        code = np.zeros(n, np.int32 if self.size**self.order < 1 << 31 else np.int64)
        for j in range(self.order, 0, -1):
            back = symbols[self.order - j : self.order - j + n].copy()
            for i in range(j):  # a text's first bytes have start symbols before them
                at = starts + (i - self.order)
                back[at[(at >= 0) & (at < n)]] = 0
            code *= self.size
            code += back
        return code, symbols[self.order :]

    def costs(self, history: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Cost of each byte of `history` behind its first `order`."""
        raise NotImplementedError


class ContextTree(Tree):
    """As a table of states: two look-ups a byte."""

    def __init__(self, own: Contexts) -> None:
        self.order, self.size, self.symbol = own.order, own.size, own.symbol
        offset = np.cumsum([0, *map(len, own.seen)])
        self.cost = np.empty((offset[-1], self.size), np.int32)
        shorter = np.full((1, self.size), 1 / 256)  # order -1: every byte alike
        for k in range(self.order + 1):
            row = np.searchsorted(own.seen[k], own.codes[k])
            counts = np.bincount(row * self.size + own.last, minlength=len(own.seen[k]) * self.size).reshape(-1, self.size)
            kinds, total = (counts > 0).sum(1, keepdims=True), counts.sum(1, keepdims=True)
            parent = np.searchsorted(own.seen[k - 1], own.seen[k] % self.size ** (k - 1)) if k else np.zeros(len(own.seen[k]), np.int64)
            escape = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
            shorter = np.where(counts > 0, counts / np.maximum(total + kinds, 1), escape * shorter[parent])
            self.cost[offset[k] : offset[k + 1]] = np.rint(-np.log2(shorter) * UNIT)
        # The state of every code of length `order`: its longest suffix that is a context.
        self.states = np.zeros(1, np.int32)
        for k in range(1, self.order + 1):
            self.states = np.tile(self.states, self.size)  # the first of k symbols is the highest digit
            self.states[own.seen[k]] = offset[k] + np.arange(len(own.seen[k]))

    @property
    def nbytes(self) -> int:
        return self.states.nbytes + self.cost.nbytes

    def costs(self, history: np.ndarray, starts: np.ndarray) -> np.ndarray:
        code, last = self.context_codes(history, starts)
        cell = self.states[code]
        cell *= self.size
        cell += last
        return self.cost.ravel()[cell]


class SparseTree(Tree):
    """Only the contexts and the followers that were seen, as sorted codes: for a large alphabet, whose table would be mostly empty.

    The probability of a byte is built from the shortest context up: the follower's share where it was seen, else
    the escape share times what the shorter context gave. These are the table's own operations in its own order, so that both forms give equal costs.
    """

    def __init__(self, own: Contexts) -> None:
        self.order, self.size, self.symbol = own.order, own.size, own.symbol
        self.seen, self.escape, self.pairs, self.share = [], [], [], []
        for k in range(self.order + 1):
            pairs, counts = np.unique(own.codes[k] * self.size + own.last, return_counts=True)
            row = np.searchsorted(own.seen[k], pairs // self.size)
            kinds, total = np.bincount(row, minlength=len(own.seen[k])), np.bincount(row, counts, minlength=len(own.seen[k])).astype(np.int64)
            self.seen.append(own.seen[k])
            self.escape.append(np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0))
            self.pairs.append(pairs)
            self.share.append(counts / np.maximum(total + kinds, 1)[row])

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for of in (self.seen, self.escape, self.pairs, self.share) for x in of)

    def costs(self, history: np.ndarray, starts: np.ndarray) -> np.ndarray:
        code, last = self.context_codes(history, starts)
        grams, which = np.unique(code.astype(np.int64) * self.size + last, return_inverse=True)
        chance = np.full(len(grams), 1 / 256)
        for k in range(self.order + 1):
            own = grams % self.size ** (k + 1)
            at, there = _found(self.seen[k], own // self.size)
            chance[there] *= self.escape[k][at[there]]
            at, there = _found(self.pairs[k], own)
            chance[there] = self.share[k][at[there]]
        return np.rint(-np.log2(chance) * UNIT).astype(np.int32)[which]


def _found(codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each value among the sorted codes, whether it is there)."""
    if not len(codes):
        return np.zeros(len(of), np.int64), np.zeros(len(of), bool)
    at = np.minimum(np.searchsorted(codes, of), len(codes) - 1)
    return at, codes[at] == of


def build_tree(texts: list[bytes], order: int) -> ContextTree | SparseTree:
    own = Contexts(texts, order)
    return ContextTree(own) if own.table_bytes <= DENSE_BYTES else SparseTree(own)


def window_bits(trees: list[Tree], raw: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Bits of each row in each tree, window by window."""
    total = np.zeros((len(offsets) - 1, len(trees)), np.int64)
    used = np.flatnonzero(np.diff(offsets))
    first = offsets[:-1][used]
    for low in range(0, len(raw), WINDOW_BYTES):
        high = min(low + WINDOW_BYTES, len(raw))
        head = min(low, order)
        history = np.concatenate([np.zeros(order - head, np.uint8), raw[low - head : high]])
        a, b = np.searchsorted(first, low, "right") - 1, np.searchsorted(first, high)  # rows with bytes in the window
        starts = first[np.searchsorted(first, low - head) : b] - low + order
        cuts = np.maximum(first[a:b], low) - low
        for k, tree in enumerate(trees):
            total[used[a:b], k] += np.add.reduceat(tree.costs(history, starts), cuts, dtype=np.int64)
    return total / UNIT


class ContextTrees:
    """The samples of all languages, and their trees.

    A tree is built when it is asked for, so that the driver holds the samples, which are
    bounded, and the trees of one group at a time.
    """

    def __init__(self, samples: dict[str, list[bytes]], order: int) -> None:
        self.samples, self.order, self.languages = samples, order, sorted(samples)

    @classmethod
    def fit(cls, samples: dict[str, list[bytes]], order: int = 3) -> ContextTrees:
        return cls(samples, order)

    def groups(self) -> Iterator[list[Tree]]:
        """The trees in the order of `languages`, by GROUP_BYTES or one larger one."""
        group: list[Tree] = []
        for lang in self.languages:
            tree = build_tree(self.samples[lang], self.order)
            if group and sum(t.nbytes for t in group) + tree.nbytes > GROUP_BYTES:
                yield group
                group = []
            group.append(tree)
        if group:
            yield group

    def code_lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row in each language."""
        return np.concatenate([window_bits(g, raw, offsets, self.order) for g in self.groups()], axis=1)

    def share(self, spark: SparkSession) -> SharedTrees:
        groups, size = [], 0
        for group in self.groups():
            size += sum(t.nbytes for t in group)
            groups.append(spark.sparkContext.broadcast(group))
        return SharedTrees(groups, self.languages, self.order, size <= MODEL_BYTES)


@dataclass
class SharedTrees:
    """The trees as broadcasts of bounded size. Where they don't fit into a task's memory together, each group is loaded in its turn and let go again."""

    groups: list[Broadcast]
    languages: list[str]
    order: int
    whole: bool

    @property
    def bytes_at_once(self) -> int:
        return WINDOW_BYTES if self.whole else TURN_BYTES

    def judged(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bits of each row in each language, its bytes, 1 at least)."""
        raw, offsets = text_bytes(texts)
        bits = []
        for group in self.groups:
            bits.append(window_bits(group.value, raw, offsets, self.order))
            if not self.whole:
                group.__dict__.pop("_value", None)  # read again from the executor's disk when its turn comes
        return np.concatenate(bits, axis=1), np.maximum(np.diff(offsets), 1)


def _predict(batches: Iterator[pa.RecordBatch], model: SharedTrees) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", model.bytes_at_once):
        bits, n = model.judged(part.column("text"))
        letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
        best = bits.argmin(axis=1)
        # The share of the best language when each explains SCORE_BYTES average bytes of the text.
        gap = (bits - bits.min(axis=1, keepdims=True)) * (np.minimum(n, SCORE_BYTES) / n)[:, None]
        score = np.where(letters, 1 / np.exp2(-gap).sum(axis=1), 0.0)
        names = np.array(model.languages, object)[best]
        names[~letters] = UNKNOWN
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), pa.array(names, pa.string()), pa.array(score), pa.array(np.where(letters, bits[np.arange(len(best)), best] / n, 0.0))],
            names=["key", "lang_pred", "score", "bits_per_byte"],
        )


def held_out(key: Column) -> Column:
    """A quarter of the documents, by a checksum of the id; null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, order: int = 3, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES, text_bytes: int = TEXT_BYTES) -> ContextTrees:
    """Context trees from a bounded sample of the labelled rows that are not held out.

    Of each language at most `sample_rows` rows and `sample_bytes` bytes are learned from, the first in
    an order by a hash of the id, the id and a hash of the text, equal rows once; a text counts with its first `text_bytes` bytes. Rows are
    drawn in a scan of ids, labels, lengths and hashes; only the drawn texts reach the driver. Labels
    are counted first, so that only rows whose hash is low enough are sorted, a few hundred of a language.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("key").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 40))
    rows = rows.withColumn("place", place).withColumn("digest", F.xxhash64("text"))
    listed = rows.select("lang", "key", "place", "digest", F.least(F.octet_length("text"), F.lit(text_bytes)).cast("long").alias("size"))
    # Both lists are written, so that Spark knows by their size whether they may be broadcast.
    low = settle(rows.groupBy("lang").agg((F.lit(float(1 << 40)) * (2 * sample_rows + 100) / F.count(F.lit(1))).alias("most")), "labels")
    near = listed.join(low, "lang").where("place <= most").select("lang", "key", "place", "digest", "size").distinct()
    order_by = W.partitionBy("lang").orderBy("place", "key", "digest")
    first = near.withColumn("n", F.row_number().over(order_by)).where(F.col("n") <= sample_rows)
    before = F.coalesce(F.sum("size").over(W.partitionBy("lang").orderBy("n").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    drawn = settle(first.withColumn("before", before).where(F.col("before") < sample_bytes).select("lang", "key", "digest", "n"), "drawn")
    head = F.substring(F.col("text").cast("binary"), 1, min(text_bytes, sample_bytes)).alias("head")
    texts = rows.join(drawn, ["lang", "key", "digest"]).select("lang", "n", head).dropDuplicates(["lang", "n"])
    samples: dict[str, list[bytes]] = {}
    for r in texts.orderBy("lang", "n").toLocalIterator():  # sample_rows of each language at most
        own = samples.setdefault(r.lang, [])
        room = sample_bytes - sum(map(len, own))
        if r.head and room > 0:
            own.append(bytes(r.head)[:room])
    return ContextTrees.fit({lang: own for lang, own in samples.items() if own}, order)


def _letters(text: str, trees: ContextTrees) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)) if trees.languages else F.lit(False)


def accept(docs: DataFrame, trees: ContextTrees, reject_bits: float = 8.0, text: str = "text", lang: str | None = None) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text is in a learned language; with `lang`, that column takes the prediction.

    Rejected are texts that are `und` (null, empty, without a letter; all if nothing was learned),
    and those that the best language codes in no fewer bits a byte than `reject_bits`; at 8 its
    statistics say nothing about the text. Only the text goes to Python, and only a language or null comes
    back, so columns of any name and number stay where they are. Repeated rows are each judged, of languages that code a text
    alike the first by name is told, an empty table stays empty, and a text of any length is scored window by window.
    """
    if not trees.languages:
        return docs.limit(0)
    model = trees.share(docs.sparkSession)
    names = np.array(trees.languages, object)

    @F.arrow_udf("string")
    def told(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            verdicts = [pa.array([], pa.string())]
            for part in slices(iter([pa.RecordBatch.from_arrays([batch], names=["text"])]), "text", model.bytes_at_once):
                bits, n = model.judged(part.column("text"))
                verdicts.append(pa.array(np.where(bits.min(axis=1) < reject_bits * n, names[bits.argmin(axis=1)], None), pa.string()))
            yield pa.concat_arrays(verdicts)

    own = docs.where(_letters(text, trees))
    if lang is None:
        return own.where(told(F.col(text)).isNotNull())
    spoken = free_name("spoken", docs.columns)
    # Not to be run once for the filter and once for the column.
    judged = own.withColumn(spoken, told.asNondeterministic()(F.col(text))).where(F.col(spoken).isNotNull())
    return judged.select(*(F.col(spoken).alias(c) if c == lang else F.col(f"`{c}`") for c in docs.columns))


def identify(docs: DataFrame, trees: ContextTrees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, lang_pred, score (0 to 1), bits_per_byte of the best language.

    Only the text decides. A null or empty text, or one without a letter, is `und` with score 0,
    as is every text when nothing could be learned. Of languages that code a text alike the first by name is told.
    Repeated rows are each scored, an empty table gives an empty result, a text of any length is
    scored window by window, and columns other than `key` and `text` are not read.
    """
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), _letters(text, trees).alias("letters"))
    if not trees.languages:
        trees = ContextTrees.fit({UNKNOWN: [b" "]}, 1)
    schema = T.StructType([picked.schema["key"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    model = trees.share(docs.sparkSession)
    return picked.mapInArrow(partial(_predict, model=model), schema).withColumnRenamed("key", key)
