"""String similarity by the longest common subsequence: 100 * 2 LCS / (|a| + |b|)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel longest common subsequence on one whole number (Hyyrö 2004)."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    if not a and not b:
        return 100.0
    return 100.0 * (2 * lcs_length(a, b)) / (len(a) + len(b))


#: Classes of characters that are counted apart.
CLASSES = 64
#: Longest text, in lanes of 64 characters, whose comparisons run side by side in numpy; longer ones run one by one, with all their characters in a whole number.
LANES = 8
#: Lanes that one numpy step works on.
BATCH = 1 << 15


class Block:
    """Texts as code points, with the count of each class of characters and, for short ones, the places of each character as bits.

    A class is a remainder of the code point, so that texts of any script are told apart by counts.
    """

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        self.length = np.array([len(x) for x in points], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.points = np.concatenate(points) if points else np.zeros(0, np.uint32)
        self.row = np.repeat(np.arange(len(texts)), self.length)

    def counts(self) -> np.ndarray:
        cell = self.row * CLASSES + self.points % CLASSES
        return np.bincount(cell, minlength=len(self.texts) * CLASSES).reshape(-1, CLASSES)


def most_common(x: Block, y: Block) -> np.ndarray:
    """Per pair of texts, the characters that they can have in common: of each class the smaller count.

    The smaller of two counts is the number of steps that both reach, so that one matrix product adds them up for all pairs.
    """
    a, b = x.counts(), y.counts()
    total = np.zeros((len(a), len(b)), np.float32)
    for step in range(1, int(min(a.max(initial=0), b.max(initial=0))) + 1):
        one, two = a >= step, b >= step
        used = np.flatnonzero(one.any(0) & two.any(0))
        if not len(used):
            break
        total += one[:, used].astype(np.float32) @ two[:, used].astype(np.float32).T
    return total


def lcs_lengths(x: Block, y: Block, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of text i of `x` and text j of `y` for each pair; -1 where it is found to be below `least`.

    The recurrence of `lcs_length` for many pairs at once, a character of each second text a step; the first texts' characters are bits of
    64-bit lanes, and a sum's carry goes on to the next lane. A pair that cannot reach its least any more is let go.
    """
    out = np.full(len(i), -1, np.int64)
    lanes = (x.length[i] + 63) // 64
    for at in np.flatnonzero((lanes > LANES) | (lanes == 0)).tolist():
        out[at] = lcs_length(x.texts[i[at]], y.texts[j[at]])
    alphabet = np.unique(x.points)
    codes = np.searchsorted(alphabet, x.points)
    other = np.minimum(np.searchsorted(alphabet, y.points), len(alphabet) - 1) if len(alphabet) else np.zeros(len(y.points), np.int64)
    other = np.where(alphabet[other] == y.points, other, len(alphabet)) if len(alphabet) else other  # one more for all that no first text has
    size = len(alphabet) + 1
    for width in range(1, LANES + 1):
        pairs = np.flatnonzero(lanes == width)
        if not len(pairs):
            continue
        own, number = np.unique(i[pairs], return_inverse=True)
        masks = np.zeros(len(own) * size * width, np.uint64)
        inside = np.isin(x.row, own)
        place = np.arange(len(x.points))[inside] - x.first[x.row[inside]]
        cell = (np.searchsorted(own, x.row[inside]) * size + codes[inside]) * width + place // 64
        np.bitwise_or.at(masks, cell, np.uint64(1) << (place % 64).astype(np.uint64))
        masks = masks.reshape(-1, width)
        for low in range(0, len(pairs), max(1, BATCH // width)):
            part = slice(low, low + max(1, BATCH // width))
            out[pairs[part]] = _side_by_side(masks, number[part] * size, x.length[i[pairs[part]]], other, y.first[j[pairs[part]]], y.length[j[pairs[part]]], least[pairs[part]])
    return out


def _side_by_side(masks: np.ndarray, base: np.ndarray, length: np.ndarray, other: np.ndarray, first: np.ndarray, steps: np.ndarray, least: np.ndarray) -> np.ndarray:
    """One batch of `lcs_lengths`: each pair's own masks begin at `base`, and its second text's codes at `first`."""
    width = masks.shape[1]
    out = np.full(len(base), -1, np.int64)
    # The bits beyond a text's end stay set throughout, and so are no part of the count of those that fall.
    v = np.full((len(base), width), np.uint64(0xFFFFFFFFFFFFFFFF))
    order = np.argsort(-steps, kind="stable")
    base, first, steps, least, v = base[order], first[order], steps[order], least[order], v[order]
    back, alive = order, len(order)
    longest = int(steps.max(initial=0))
    for t in range(longest + 1):
        ended = alive - int(np.searchsorted(-steps[:alive], -t, side="left"))  # those of t steps stand last
        if t and t % 16 == 0 or ended:
            now = 64 * width - np.bitwise_count(v[:alive]).sum(1, dtype=np.int64)
            if ended:
                out[back[alive - ended : alive]] = now[alive - ended :]
                alive -= ended
            keep = np.flatnonzero(now[:alive] + (steps[:alive] - t) >= least[:alive]) if t % 16 == 0 else None
            if keep is not None and len(keep) < 0.8 * alive:
                base, first, steps, least, v, back = base[keep], first[keep], steps[keep], least[keep], v[keep], back[keep]
                alive = len(keep)
        if not alive:
            break
        m = masks[base[:alive] + other[first[:alive] + t]]
        w = v[:alive]
        u = w & m
        total = w + u
        if width > 1:
            carry = total < w
            for lane in range(1, width):
                more = total[:, lane] + carry[:, lane - 1]
                carry[:, lane] |= more < total[:, lane]
                total[:, lane] = more
        v[:alive] = total | (w & ~m)
    return out


def similar_pairs(a: list[str], b: list[str], cutoff: float) -> pa.Table:
    """The pairs of two blocks of texts whose ratio is `cutoff` or more.

    A common subsequence takes no more of a class than either text has; counts rule out most
    pairs by a matrix product, and the others are compared side by side.
    """
    x, y = Block(a), Block(b)
    i, j = (np.nonzero(200.0 * most_common(x, y) >= cutoff * (x.length[:, None] + y.length))) if a and b else (np.zeros(0, np.int64),) * 2
    total = x.length[i] + y.length[j]
    common = lcs_lengths(x, y, i, j, np.ceil(cutoff * total / 200 - 1e-9).astype(np.int64))
    score = np.where(total > 0, 100.0 * (2 * common) / np.maximum(total, 1), 100.0)
    found = np.flatnonzero((common >= 0) & (score >= cutoff))
    return pa.table({"text": pa.array(a, pa.string()).take(pa.array(i[found])), "match": pa.array(b, pa.string()).take(pa.array(j[found])), "score": pa.array(score[found], pa.float64())})


def ratio_sql(a: Column, b: Column) -> Column:
    """The same by built-in functions: one row of the table at a time. Exact, and slow for long strings."""
    x, y = (F.filter(F.split(s, ""), lambda c: c != "") for s in (a, b))
    zeros = F.transform(y, lambda _: F.lit(0))

    def next_row(row: Column, c: Column) -> Column:
        # acc: the new row so far; its last element is the left neighbour.
        return F.aggregate(
            F.sequence(F.lit(1), F.size(y)), F.expr("cast(array() as array<int>)"),
            lambda acc, j: F.concat(acc, F.array(F.when(
                F.element_at(y, j) == c, F.coalesce(F.get(row, j - 2), F.lit(0)) + 1,
            ).otherwise(F.greatest(F.element_at(row, j), F.coalesce(F.get(acc, j - 2), F.lit(0)))))),
        )

    both = (F.size(x) > 0) & (F.size(y) > 0)
    lcs = F.when(both, F.element_at(F.aggregate(x, zeros, next_row), -1)).otherwise(F.lit(0))
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(100.0) * (2 * lcs) / total)


def length_bucket(length: Column, cutoff: float) -> Column:
    """Strings at least `cutoff` (in percent) alike lie in equal or neighbouring buckets.

    2 LCS / (s + l) >= c and LCS <= s give s >= l c / (2 - c).
    """
    c = cutoff / 100
    step = (2 - c) / c
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / F.log(F.lit(step)) + F.lit(1e-9)).cast("int")


