"""Exact Jaccard join on word shingles with adaptive multi-match prefixes (operator 8).

Two texts are linked when their sets of w-word shingles have a similarity of at least
t percent. A text of n shingles shares at least a = ceil(t n / 100) with any partner. So in
any order that all texts follow, at least k of its first n - a + k shingles stand in the
partner's prefix of the same kind: a longer prefix asks for more shared shingles before
anything is verified.

1. In the order of the shingles' hashes, each text's prefix is lengthened by a share of its
   size. A text that has too few shingles there which any other prefix has, has no
   partner, and nearly all texts end here. One aggregation and one join of prefix rows.
2. For the texts left, all shingles are counted. A shingle that one text alone has links
   nothing; a text with fewer than a others ends here. Now the order is rarest first, and
   each text chooses its own k: the longer prefix costs more look-ups, but its candidates
   must share k, so that k grows where the estimated candidates of the shorter are many.
   A pair must share the smaller of its two k.
3. Of each list of a prefix shingle, one pivot, the text with the fewest shingles of its own,
   is verified against the rest: as many pairs as entries. What that links is one
   component. Then only pairs across components are compared, and of those only such as sizes,
   shared shingles, their places in the lists, and sketches of the sets allow.

4. Where links are asked for, all sets of a component are compared with each other, block
   against block, by products of 0/1 matrices. No link leaves a component, so these are all.

Candidates meet by 48-bit fingerprints of shingles, and each link that joins components is verified on the words
of both texts, exactly. Equal sets, told by 128 bits, are one node throughout. For components, thousands of near copies cost thousands of
pairs, not their square, and no link that could join two components is left out. Hot shingles
are met by partial aggregation and by joins whose large side Spark can split.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.components import connected_components
from lexforge.llm.shared import may_match, settle
from lexforge.llm.words import NON_SPACE, gram_hashes, mix, slices, spans, split, word_hashes

#: By how much of its shingles a text's first prefix is longer than it must be, in percent.
LONGER = 5
#: Longest multi-match prefix: up to so many shared shingles before verification.
MOST_MATCHES = 4
#: Bits of a node's sketch, in words of 64; a shingle sets the bit that its fingerprint names.
SKETCH_WORDS = 16
#: Cost of verifying a candidate, in look-ups.
VERIFY_COST = 16.0
#: Remaining pairs across components for each list entry above which another pivot round is run first.
PAIRS_PER_ENTRY = 4
#: A component is dealt into blocks of about so many nodes, or so many shingles if these are fewer nodes. A node is sent to every pair of blocks that its own is in,
#: so that large blocks keep the shuffle small; two of them, their products and a slice of columns are some 100 MB in a task.
BLOCK_NODES, BLOCK_SHINGLES = 2048, 1 << 20
#: Columns of a 0/1 matrix of a block's shingles at a time.
COLUMNS = 1 << 12


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of each row as sorted 48-bit fingerprints, row starts).

    A row with fewer words than a shingle has its whole sequence as its only one.
    """
    w = spans(texts, NON_SPACE)
    rows = len(w.counts)
    hashes = word_hashes(w, fold=True)
    grams, at = gram_hashes(hashes, w.row, words)
    row = w.row[at]
    for n in range(1, words):
        few = np.flatnonzero(w.counts == n)
        whole = np.full(len(few), n, np.uint64)
        for k in range(n):
            whole = mix(whole ^ hashes[w.first[few] + k])
        grams, row = np.concatenate([grams, whole]), np.concatenate([row, few])
    keyed = np.sort((row.astype(np.uint64) << np.uint64(48)) | (grams >> np.uint64(16)))
    keyed = keyed[np.r_[True, keyed[1:] != keyed[:-1]]] if len(keyed) else keyed
    first = np.searchsorted(keyed >> np.uint64(48), np.arange(rows + 1))
    return (keyed & np.uint64((1 << 48) - 1)).astype(np.int64), first


def _parts(batches: Iterator[pa.RecordBatch], words: int, text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in slices(batches, text):
        for at in range(0, part.num_rows, 1 << 15):
            own = part.slice(at, 1 << 15)
            yield own, *shingle_sets(own.column(text), words)


def _nodes(sets: np.ndarray, first: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each row's set, the first of `bits` bits, the second of 64; rows without shingles have none to speak of."""
    mixed = mix(sets.astype(np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    again = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(mixed), dtype=np.uint64)])
    size = np.diff(first).astype(np.uint64)
    one, two = total[first[1:]] - total[first[:-1]], again[first[1:]] - again[first[:-1]] + size
    return (mix(one ^ mix(two)) >> np.uint64(64 - bits)).view(np.int64), mix(two ^ mix(one + np.uint64(1))).view(np.int64)


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a text of n shares with any partner, at least."""
    return (percent * n + 99) // 100


def _measure(batches: Iterator[pa.RecordBatch], words: int, percent: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Per document: key, digest, digest_2, node, node_2, n_shingles, matches, prefix in the order of the hashes."""
    for part, sets, first in _parts(batches, words):
        n = np.diff(first)
        need = _need(n, percent)
        matches = np.minimum(1 + LONGER * n // 100, need)
        length = n - need + matches
        bounds = np.concatenate([[0], np.cumsum(length)])
        prefix = sets[np.repeat(first[:-1] - bounds[:-1], length) + np.arange(bounds[-1])]
        yield pa.RecordBatch.from_arrays([
            *(part.column(c) for c in ("key", "digest", "digest_2")), *(pa.array(x, mask=n == 0) for x in _nodes(sets, first, bits)), pa.array(n), pa.array(matches),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(prefix)),
        ], names=["key", "digest", "digest_2", "node", "node_2", "n_shingles", "matches", "prefix"])


def _sketches(sets: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    bits = np.zeros((rows, SKETCH_WORDS), np.uint64)
    np.bitwise_or.at(bits, (row, (sets >> 6) % SKETCH_WORDS), np.uint64(1) << (sets & 63).astype(np.uint64))
    return bits


def _full(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per node: all its shingles, and their sketch."""
    for part, sets, first in _parts(batches, words):
        bits = _sketches(sets, np.repeat(np.arange(part.num_rows), np.diff(first)), part.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([
            part.column("node"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sets)),
            pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * SKETCH_WORDS, pa.int32()), pa.array(bits.ravel())),
        ], names=["node", "shingles", "sketch"])


def chosen_matches(listed: Column, spare: Column, need: Column) -> Column:
    """How many shared shingles a text should ask for.

    `listed`: (df, shingle) of its shared shingles, rarest first; with k matches the
    prefix holds the first `spare` + k of them. A prefix costs a look-up for each entry of its lists, and the
    candidates, at most the look-ups over k, are verified.
    """

    def cost(k: int) -> Column:
        load = F.aggregate(F.slice(listed, 1, spare + k), F.lit(0.0), lambda acc, x: acc + x["df"] - 1)
        return F.when(need >= k, F.struct((load + F.lit(VERIFY_COST) * load / k + spare + k).alias("cost"), F.lit(k).alias("k")))

    return F.array_min(F.filter(F.array(*(cost(k) for k in range(1, MOST_MATCHES + 1))), lambda x: x.isNotNull()))["k"]


def exact_overlap(a: pa.Array, b: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(common, united) shingles of each pair of texts. Words are numbered, and shingles as pairs of numbers, so that nothing is taken for equal that is not."""
    n = len(a)
    w = split(pa.concat_arrays([x.cast(pa.string()) for x in (a, b)]), NON_SPACE, fold=True)
    at = np.flatnonzero(w.row[: max(0, len(w.row) - words + 1)] == w.row[words - 1 :])
    few = np.flatnonzero((w.counts > 0) & (w.counts < words))
    row, first = np.concatenate([w.row[at], few]), np.concatenate([at, w.first[few]])
    length = np.concatenate([np.full(len(at), words), w.counts[few]])
    ids = np.zeros(len(first), np.int64)
    for k in range(words):
        word = np.where(k < length, w.ids[np.minimum(first + k, max(len(w.ids) - 1, 0))].astype(np.int64) + 1, 0) if len(w.ids) else ids
        ids = np.unique(ids * (len(w.vocabulary) + 1) + word, return_inverse=True)[1]
    side, pair = np.divmod(row, n)
    held = np.unique((pair * (ids.max(initial=0) + 1) + ids) * 2 + side)  # each shingle of a text once
    both = held[:-1][(held[:-1] >> 1) == (held[1:] >> 1)] >> 1
    common = np.bincount(both // (ids.max(initial=0) + 1), minlength=n)
    return common, np.bincount((held >> 1) // (ids.max(initial=0) + 1), minlength=n) - common


def _verify(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            common, union = exact_overlap(part.column("text_a"), part.column("text_b"), words)
            good = pa.array((100 * common >= percent * union) & (common > 0))
            yield pa.RecordBatch.from_arrays([part.column(c).filter(good) for c in ("a", "b")], names=["a", "b"])


def _block_links(group: pa.Table, percent: int, count: bool) -> pa.Table:
    """The links between two blocks of a component, or inside one: each pair, or per node the documents that it is linked with."""
    at = group.column("block").to_numpy()
    first = np.flatnonzero(at == group.column("low")[0].as_py())
    second = np.flatnonzero(at == group.column("high")[0].as_py())
    sets = group.column("shingles").combine_chunks()
    n = np.diff(sets.offsets.to_numpy())
    row = np.repeat(np.arange(len(n)), n)
    _, ids, held = np.unique(sets.flatten().to_numpy(), return_inverse=True, return_counts=True)
    several = held > 1  # the others are common to no two
    width = int(several.sum())
    row, ids = row[several[ids]], (np.cumsum(several) - 1)[ids[several[ids]]]
    order = np.argsort(ids, kind="stable")
    row, ids = row[order], ids[order]
    common = np.zeros((len(first), len(second)), np.int32)
    for low in range(0, width, COLUMNS):
        own = slice(*np.searchsorted(ids, [low, low + COLUMNS]))
        holds = np.zeros((len(n), min(COLUMNS, width - low)), np.float32)
        holds[row[own], ids[own] - low] = 1
        common += (holds[first] @ holds[second].T).astype(np.int32)
    union = n[first][:, None] + n[second][None, :] - common
    linked = (100 * common >= percent * union) & (common > 0)
    node, inside = group.column("node").to_numpy(), len(first) > 0 and np.array_equal(first, second)
    if inside:
        np.fill_diagonal(linked, False)
    if count:
        copies = group.column("copies").to_numpy()
        out = np.zeros(len(n), np.int64)
        out[first] += linked @ copies[second]
        if not inside:
            out[second] += copies[first] @ linked
        return pa.table({"node": node, "linked": out})
    i, j = np.nonzero(np.triu(linked) if inside else linked)
    x, y = node[first[i]], node[second[j]]
    return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y), "common": common[i, j].astype(np.int64), "union": union[i, j].astype(np.int64)})


class JaccardJoin:
    """The join of one table with itself; `run` gives a row per document, `links` one per pair of different sets."""

    def __init__(self, docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text", node_bits: int = 64) -> None:
        """`node_bits`: bits of the first fingerprint of a set; sets that it takes for equal are told apart by the second."""
        self.words, self.percent, self.key, self.bits = words, percent, key, node_bits
        self.docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest"), F.hash(F.col(text)).alias("digest_2"))
        self.kind = self.docs.schema["key"].dataType

    def measure(self) -> DataFrame:
        """Every document's node, set size and first prefix."""
        schema = T.StructType([
            T.StructField("key", self.kind), T.StructField("digest", T.LongType()), T.StructField("digest_2", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("node", "node_2", "n_shingles", "matches")), T.StructField("prefix", T.ArrayType(T.LongType())),
        ])
        rows = settle(self.docs.mapInArrow(partial(_measure, words=self.words, percent=self.percent, bits=self.bits), schema), "shingle-prefixes")
        # Different sets of one first fingerprint get nodes of their own; there are hardly ever any.
        mixed = rows.where("node is not null").groupBy("node").agg(F.min("node_2").alias("low"), F.max("node_2").alias("high")).where("low != high")
        mixed = settle(mixed.select("node", F.lit(True).alias("mixed")), "mixed-nodes")
        if mixed.limit(1).count():
            apart = F.when(F.col("mixed"), F.xxhash64("node", "node_2")).otherwise(F.col("node"))
            rows = settle(rows.join(mixed, "node", "left").withColumn("node", apart).drop("mixed"), "shingle-prefixes")
        return rows

    def survivors(self, rows: DataFrame) -> DataFrame:
        """(node, n, body): nodes whose prefixes share enough with others, each with one text."""
        rows = rows.where("node is not null")
        entries = rows.select("node", F.explode("prefix").alias("shingle"))
        shared = entries.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("shingle")
        hits = entries.join(shared, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("hits"))
        nodes = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"), F.max("matches").alias("matches"),
            F.first("digest").alias("digest"), F.first("digest_2").alias("digest_2"),
        )
        left = settle(nodes.join(hits, "node").where("hits >= matches * copies").select("node", "n", "digest", "digest_2"), "survivors")
        # The list grows with the documents; a bitmap of it, of fixed size, keeps nearly all texts that are not on it out of the shuffle.
        near = may_match(self.docs, left, ["digest", "digest_2"], "may_be").where("may_be").drop("may_be")
        own = near.join(left.select("digest", "digest_2"), ["digest", "digest_2"], "left_semi")
        bodies = own.groupBy("digest", "digest_2").agg(F.first("text").alias("body"))
        return settle(bodies.join(left, ["digest", "digest_2"]).select("node", "n", "body"), "bodies")

    def shingles(self, bodies: DataFrame) -> DataFrame:
        return settle(bodies.select("node", F.col("body").alias("text")).mapInArrow(partial(_full, words=self.words), "node long, shingles array<long>, sketch array<long>"), "shingles")

    def lists(self, bodies: DataFrame, full: DataFrame) -> DataFrame:
        """(shingle, i, node, n, s, k): rarest-first prefixes of shared shingles, the i-th from 0; s of the node's n shingles are shared."""
        each = full.select("node", F.explode("shingles").alias("shingle"))
        shared = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        held = each.join(shared, "shingle").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("listed"))
        need = F.floor((F.lit(self.percent) * F.col("n") + 99) / 100).cast("int")
        held = held.join(bodies.select("node", "n"), "node").withColumn("s", F.size("listed")).withColumn("need", need).where("s >= need")
        held = held.withColumn("k", chosen_matches(F.col("listed"), F.col("s") - F.col("need"), F.col("need")))
        prefix = F.slice("listed", 1, F.col("s") - F.col("need") + F.col("k"))
        return settle(held.select("node", "n", "s", "k", F.posexplode(prefix).alias("i", "x")).select("x.shingle", "i", "node", "n", "s", "k"), "prefix-lists")

    def _may_link(self, a: str, b: str) -> Column:
        """What sizes and shared shingles allow: the common ones are shared, and are t / (100 + t) of both sizes together."""
        s, n = F.least(F.col(f"{a}.s"), F.col(f"{b}.s")), F.col(f"{a}.n") + F.col(f"{b}.n")
        near = 100 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) >= self.percent * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))
        return near & ((100 + self.percent) * s >= self.percent * n)

    def _place_allows(self, a: str, b: str) -> Column:
        """What the places of a common shingle allow.

        Behind the m-th common one, counted from 1, lie at most the rest of either list, so that all
        of the first k have no fewer than need - k + 1 from themselves on.
        """
        rest = F.least(F.col(f"{a}.s") - F.col(f"{a}.i"), F.col(f"{b}.s") - F.col(f"{b}.i")) + F.least(f"{a}.k", f"{b}.k") - 1
        return (100 + self.percent) * rest >= self.percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))

    def _sketch_allows(self, a: str, b: str) -> Column:
        """What the sketches allow: each bit that one alone has is a shingle that one alone has, and of those a link has few."""
        apart = sum((F.bit_count(F.get(f"{a}.sketch", F.lit(w)).bitwiseXOR(F.get(f"{b}.sketch", F.lit(w)))) for w in range(SKETCH_WORDS)), F.lit(0))
        return (100 + self.percent) * apart <= (100 - self.percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))

    def verify(self, pairs: DataFrame, bodies: DataFrame) -> DataFrame:
        """Those of `pairs` (a, b) that are similar enough, by their whole texts."""
        with_a = pairs.join(bodies.select(F.col("node").alias("a"), F.col("body").alias("text_a")), "a")
        both = with_a.join(bodies.select(F.col("node").alias("b"), F.col("body").alias("text_b")), "b")
        return settle(both.select("a", "b", "text_a", "text_b").mapInArrow(partial(_verify, words=self.words, percent=self.percent), "a long, b long"), "links")

    def _stars(self, left: DataFrame, turn: int) -> DataFrame:
        """Pairs of each list's pivot with the rest: first the entry of the fewest shingles of its own, later any."""
        own = (F.col("n") - F.col("s")) / F.col("n") if turn == 0 else F.lit(0.0)
        pivot = F.min_by(F.struct("node", "n", "s"), F.struct(own, F.xxhash64("node", F.lit(turn))))
        pivots = left.groupBy("shingle").agg(pivot.alias("p")).select("shingle", "p.*")
        stars = left.alias("x").join(pivots.alias("p"), F.col("x.shingle") == F.col("p.shingle")).where((F.col("x.node") != F.col("p.node")) & self._may_link("x", "p"))
        return stars.select(F.least("x.node", "p.node").alias("a"), F.greatest("x.node", "p.node").alias("b")).distinct()

    def _open(self, lists: DataFrame, found: DataFrame) -> DataFrame:
        """Entries that may still join two components: lists of several, and nodes that some size in the list allows."""
        tagged = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        several = tagged.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least")).where("low != high")
        most = (100 + self.percent) * (F.col("s") - F.col("i") + F.col("k") - 1) - self.percent * F.col("n")
        return settle(tagged.join(several.select("shingle", "least"), "shingle").where(most >= self.percent * F.col("least")).drop("least"), "open-lists")

    def components(self, rows: DataFrame) -> DataFrame:
        """(node, component) of all nodes that have a link."""
        return self._components(rows)[0]

    def _components(self, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The components, and the shingles and the prefix lists of the nodes that may have a link."""
        bodies = self.survivors(rows)
        full = self.shingles(bodies)
        lists = self.lists(bodies, full)
        links, left, before = None, lists, None
        for turn in itertools.count():
            fresh = self.verify(self._stars(left, turn), bodies)
            links = fresh if links is None else links.union(fresh)
            left = self._open(lists, connected_components(links))
            parts = left.groupBy("shingle", "component").count().groupBy("shingle").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("own"))
            remaining, entries = parts.agg(F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
            if remaining <= PAIRS_PER_ENTRY * entries or (before is not None and remaining > before / 2):
                break
            before = remaining
        if not entries:
            return connected_components(links), full, lists
        left = settle(left.join(full.select("node", "sketch"), "node"), "sketched-lists")
        x, y = left.alias("x"), left.alias("y")
        across = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") < F.col("y.component")) & self._may_link("x", "y") & self._place_allows("x", "y") & self._sketch_allows("x", "y"))
        across = across.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("x.k", "y.k")).alias("k"))
        rest = across.where("shared >= k").select("a", "b")
        return connected_components(links.union(self.verify(rest, bodies))), full, lists

    def _nodes(self, rows: DataFrame) -> DataFrame:
        """(node, copies, size, smallest): the documents of each set, its shingles, and its smallest key."""
        return rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("size"), F.min("key").alias("smallest"))

    def _linked(self, nodes: DataFrame, found: DataFrame, full: DataFrame, lists: DataFrame, count: bool) -> DataFrame:
        """Per node and block the documents of other sets that it is linked with, or else all pairs of linked sets.

        Two linked sets share a shingle of their prefixes. So a set meets only those blocks of its component in which some set has one of its
        prefix shingles: all blocks where near copies are many, and few in a component that is a long chain of small groups. A block holds sets whose
        smallest shingles are alike, which similar sets mostly share. A component of one block is one group.
        """
        held = found.join(nodes.select("node", "copies", "size"), "node")
        many = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
        held = held.join(held.groupBy("component").agg(many.alias("blocks")), "component").join(full.select("node", F.get("shingles", F.lit(0)).alias("smallest")), "node")
        single, several = held.where("blocks = 1"), held.where("blocks > 1")
        alike = several.groupBy("component", "smallest").agg(many.alias("parts"))  # sets of one smallest shingle stay together as far as a block holds them
        place = F.xxhash64("smallest", F.pmod(F.xxhash64("node"), F.col("parts")))
        blocks = several.join(alike, ["component", "smallest"]).withColumn("block", F.pmod(place, F.col("blocks")).cast("int")).drop("parts")
        held = single.withColumn("block", F.lit(0)).unionByName(blocks)
        # Written without the sets, so that Spark knows whether the members may be broadcast to where the sets are.
        held = settle(held.select("component", "blocks", "block", "node", "copies"), "members")
        entries = lists.select("shingle", "node").join(held.where("blocks > 1").select("component", "block", "node"), "node")
        spots = entries.select("shingle", "component", F.col("block").alias("other")).distinct()
        meets = entries.join(spots, ["shingle", "component"]).select("node", "other").distinct()
        meets = settle(meets.union(held.where("blocks = 1").select("node", F.lit(0).alias("other"))), "meetings")
        each = held.drop("blocks").join(meets, "node").join(full.select("node", "shingles"), "node")
        each = each.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "copies", "shingles")
        schema = "node long, linked long" if count else "a long, b long, common long, union long"
        percent = self.percent
        return each.groupBy("component", "low", "high").applyInArrow(lambda group: _block_links(group, percent, count), schema)

    def links(self) -> DataFrame:
        """Every link between different sets once: a, b, common, union, key_a, key_b, copies_a, copies_b.

        a < b are fingerprints of sets, `common` and `union` count shingles, a key is the smallest of
        the set's documents (null if all are null), and copies are its documents, all linked with each other.
        """
        rows = self.measure()
        found, full, lists = self._components(rows)
        nodes = self._nodes(rows)
        out = self._linked(nodes, found, full, lists, count=False)
        for x in ("a", "b"):
            out = out.join(nodes.select(F.col("node").alias(x), F.col("smallest").alias(f"key_{x}"), F.col("copies").alias(f"copies_{x}")), x)
        return out.select("a", "b", "common", "union", "key_a", "key_b", "copies_a", "copies_b")

    def run_with_links(self) -> DataFrame:
        """`run`, and n_links: the other documents that each is linked with, those of an equal set among them."""
        rows = self.measure()
        found, full, lists = self._components(rows)
        nodes = settle(self._nodes(rows), "nodes")
        linked = self._linked(nodes, found, full, lists, count=True).groupBy("node").agg(F.sum("linked").alias("linked"))
        own = nodes.join(linked, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
        return self._placed(rows, found.join(own, "node", "right"), "n_links").withColumn("n_links", F.coalesce("n_links", F.lit(0)))

    def keep_one(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The rows of `docs` with the smallest key of each component, all columns as they are.

        Of rows that share text and key one stays; rows without shingles all stay.
        """
        rows = self.measure()
        found = self.components(rows)
        placed = rows.where("node is not null").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        chosen = placed.groupBy("component").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "node")).alias("best")).select("best.key", "best.node")
        # Rows that go are fewer than those that stay, and are told by id and two hashes of the text.
        best = (placed["node"] == chosen["node"]) & placed["key"].eqNullSafe(chosen["key"])
        gone = settle(placed.join(chosen, best, "left_anti").select("key", "digest", "digest_2").distinct(), "copies-that-go")
        own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
        body, key = (F.col(f"c{docs.columns.index(c)}") for c in (text, self.key))
        tagged = own.withColumns({"key": key, "digest": F.xxhash64(body), "digest_2": F.hash(body)})

        def in_(x: DataFrame, other: DataFrame, how: str) -> DataFrame:
            return x.join(other, (x["digest"] == other["digest"]) & (x["digest_2"] == other["digest_2"]) & x["key"].eqNullSafe(other["key"]), how)

        # The list of those that go grows with the documents; only rows that its bitmap does not clear have to meet it.
        marked = may_match(tagged, gone, ["digest", "digest_2"], "may_be")
        kept = marked.where("not may_be").union(in_(marked.where("may_be"), gone, "left_anti")).drop("may_be")
        again = settle(rows.where("node is not null").groupBy("key", "digest", "digest_2").count().where("count > 1").drop("count"), "repeated-rows")
        if again.limit(1).count():  # rows of one id and text
            kept = in_(kept, again, "left_anti").union(in_(kept, again, "left_semi").dropDuplicates(["key", "digest", "digest_2"]))
        return kept.drop("key", "digest", "digest_2").toDF(*docs.columns)

    def run(self) -> DataFrame:
        """Per document: key, n_shingles, component_id (the smallest key that links reach)."""
        rows = self.measure()
        return self._placed(rows, self.components(rows))

    def _placed(self, rows: DataFrame, found: DataFrame, *more: str) -> DataFrame:
        placed = rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        smallest = placed.where("component is not null").groupBy("component").agg(F.min("key").alias("smallest"))
        return placed.join(smallest, "component", "left").select(
            F.col("key").alias(self.key), "n_shingles", F.coalesce("smallest", "key").alias("component_id"), *more,
        )


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Components of documents under links of at least `percent` similarity.

    A text of fewer words than a shingle has its word sequence as its only shingle; a null
    or blank text has none, links with nothing and is its own component. Repeated rows
    keep their places and share a component. Other columns are not read. An empty
    table gives an empty result.
    """
    return JaccardJoin(docs, words, percent, key, text).run()


def jaccard_links(docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`jaccard_components` with n_links: how many other documents each is linked with, its copies among them."""
    return JaccardJoin(docs, words, percent, key, text).run_with_links()
