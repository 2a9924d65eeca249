"""Embedding whitening (operator 12): Welford moments over partitions, and a symmetric QR eigen-solve.

Each task folds its vectors into a state of count, mean and centred cross-products by rank-one
updates; states meet by the parallel update formula, a few at a time over rounds, so that no
task holds more than FAN of them. The driver solves the one that is left: Householder
reflections to a tridiagonal matrix, then implicitly shifted QR steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexforge.llm.shared import settle

#: Vectors that one numpy step takes along.
BATCH = 1024
#: States that one task merges.
FAN = 16
STATE = "part long, n long, sums array<long>, mean array<double>, scatter binary"


@dataclass
class Moments:
    """Count, exact sums of whole-number entries, mean, and the sum of the outer products of what is left after centring."""

    n: int
    sums: list[int]
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Moments:
        return cls(0, [0] * size, np.zeros(size), np.zeros((size, size)))

    def add(self, x: np.ndarray) -> None:
        """Welford's update by every row of `x`, in order.

        Row i moves the mean by d / n, where d is its distance from the mean before it, and adds the outer product
        of d and its distance from the mean after it. The means follow from running sums, so that
        the products of a batch are one matrix product.
        """
        if not len(x):
            return
        if x.dtype == np.int64:
            half = x >> 32
            low = x - (half << 32)
            self.sums = [s + (int(h) << 32) + int(r) for s, h, r in zip(self.sums, half.sum(0), low.sum(0), strict=True)]
        values = x.astype(np.float64)
        count = self.n + np.arange(1, len(x) + 1)[:, None]
        after = self.mean + np.cumsum(values - self.mean, axis=0) / count
        before = np.concatenate([self.mean[None], after[:-1]])
        self.scatter += (values - before).T @ (values - after)
        self.n, self.mean = self.n + len(x), after[-1]

    def merge(self, other: Moments) -> Moments:
        """Both together, by the parallel update formula."""
        if not self.n or not other.n:
            return other if not self.n else self
        n = self.n + other.n
        d = other.mean - self.mean
        scatter = self.scatter + other.scatter + np.outer(d, d) * (self.n * (other.n / n))
        return Moments(n, [a + b for a, b in zip(self.sums, other.sums, strict=True)], self.mean + d * (other.n / n), scatter)

    def covariance(self) -> np.ndarray:
        """Divisor n; made symmetric to the last bit."""
        v = self.scatter / max(self.n, 1)
        return (v + v.T) / 2

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums, "mean": self.mean.tolist(), "scatter": self.scatter.tobytes()}

    @classmethod
    def read(cls, r: dict) -> Moments:
        mean = np.asarray(r["mean"], np.float64)
        return cls(r["n"], list(r["sums"]), mean, np.frombuffer(r["scatter"], np.float64).reshape(len(mean), len(mean)))


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("mean", pa.list_(pa.float64())), ("scatter", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def lists(column: pa.Array, kind: pa.DataType, size: int) -> np.ndarray:
    """A list column without nulls, all of one length, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().cast(kind).to_numpy(zero_copy_only=False).reshape(len(column), size)


def moments(vectors: DataFrame, column: str, size: int) -> Moments:
    """The moments of a column of long or double lists of `size` entries; a task passes on one state, and only the last one reaches the driver."""
    kind = pa.int64() if vectors.schema[column].dataType.elementType == T.LongType() else pa.float64()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = Moments.empty(size)
        for batch in batches:
            x = lists(batch.column(column), kind, size)
            for at in range(0, len(x), BATCH):
                own.add(x[at : at + BATCH])
        if own.n:
            yield _batch([own.row(TaskContext.get().partitionId())])

    def meet(states: pa.Table) -> pa.Table:
        total, part = None, 0
        for r in sorted(states.to_pylist(), key=lambda r: r["part"]):  # always in one order
            one = Moments.read(r)
            total, part = one if total is None else total.merge(one), r["part"] // FAN
        return pa.Table.from_batches([_batch([total.row(part)])])

    states = settle(vectors.select(column).mapInArrow(fold, STATE), "moments")
    widest = states.agg(F.max("part")).first()[0]
    while widest is not None and widest > 0:
        states = states.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(meet, STATE)
        widest //= FAN
    rows = states.collect()  # one row, or none
    return Moments.read(rows[0].asDict()) if rows else Moments.empty(size)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, what is beside it, Q) with a = Q T Q', by Householder reflections."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        length = np.linalg.norm(x)
        if length == 0 or not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        v /= np.linalg.norm(v)
        p = a[k + 1 :, k + 1 :] @ v
        w = p - (p @ v) * v
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(length, x[0])
        a[k + 2 :, k] = a[k, k + 2 :] = 0
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    Implicit QR steps with Wilkinson's shift on the tridiagonal form; an entry beside the diagonal that is
    lost in its neighbours' rounding becomes 0 and splits the matrix.
    """
    n = len(a)
    scale = float(np.abs(a).max(initial=0.0))
    d, e, q = tridiagonal(a / scale if scale else a)
    z = np.ascontiguousarray(q.T)  # rows, so that a rotation works on two stretches of memory
    eps = np.finfo(np.float64).eps
    high, steps = n - 1, 0
    while high > 0:
        small = np.abs(e[:high]) <= eps * (np.abs(d[:high]) + np.abs(d[1 : high + 1]))
        e[:high][small] = 0.0
        if e[high - 1] == 0.0:
            high -= 1
            continue
        zeros = np.flatnonzero(e[:high] == 0.0)
        low = int(zeros[-1]) + 1 if len(zeros) else 0
        half = (d[high - 1] - d[high]) / 2
        beside = e[high - 1]
        shift = d[high] - beside * beside / (half + np.copysign(np.hypot(half, beside), half))
        x, y = d[low] - shift, e[low]
        for k in range(low, high):
            r = float(np.hypot(x, y))
            c, s = (x / r, y / r) if r else (1.0, 0.0)
            if k > low:
                e[k - 1] = r
            dk, dn, ek = d[k], d[k + 1], e[k]
            d[k] = c * c * dk + 2 * c * s * ek + s * s * dn
            d[k + 1] = s * s * dk - 2 * c * s * ek + c * c * dn
            e[k] = c * s * (dn - dk) + (c * c - s * s) * ek
            if k < high - 1:
                x, y = e[k], s * e[k + 1]
                e[k + 1] *= c
            pair = z[k : k + 2]
            pair[:] = np.array([[c, s], [-s, c]]) @ pair
        steps += 1
        if steps > 60 * n:
            raise ArithmeticError("the QR steps do not settle")
    order = np.argsort(-d, kind="stable")
    vectors = z[order].T
    # One sign for every run: the entry of largest size is positive.
    largest = np.argmax(np.abs(vectors), axis=0)
    return d[order] * (scale or 1.0), vectors * np.where(vectors[largest, np.arange(n)] < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """What a fit gives: n, sums, eigenvalues and vectors of the first components, the trace, and the error of the whitened covariance."""

    n: int
    size: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def solid(self) -> np.ndarray:
        """Components that have variance beyond rounding; the others have no whitened values."""
        return self.values > self.size * np.finfo(np.float64).eps * max(self.values.max(initial=0.0), 0.0)

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            return (x - mean) @ self.vectors / np.sqrt(self.values)


def whole_numbers(df: DataFrame, vector: str, scale: int, keep: list[str]) -> DataFrame:
    """`keep` and x, the entries times `scale` rounded down, of rows whose vector has neither nulls nor entries that are not finite.

    Beyond the range of a long, x stays at its ends.
    """
    kept = T.StructType([df.schema[c] for c in keep] + [T.StructField("x", T.ArrayType(T.LongType()))])
    top = float(2**63)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_vector")
            flat = column.flatten().cast(pa.float64())
            entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            lengths = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            broken = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
            good = column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(broken[first]) == 0)
            with np.errstate(over="ignore"):
                raised = np.floor(np.where(np.isfinite(entries), entries, 0.0) * scale)
            x = np.where(raised >= top, np.int64(2**63 - 1), np.where(raised < -top, np.int64(-(2**63)), 0))
            inside = (raised < top) & (raised >= -top)
            x[inside] = raised[inside].astype(np.int64)
            at = np.flatnonzero(good)
            values = x[np.repeat(good, lengths)]
            bounds = np.concatenate([[0], np.cumsum(lengths[at])]).astype(np.int32)
            columns = [batch.column(c).take(pa.array(at)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int64()))], names=[*keep, "x"])

    return df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{vector}`").alias("_vector")).mapInArrow(work, kept)


def fit(df: DataFrame, vector: str = "embedding", components: int = 4, scale: int = 256) -> Whitening:
    """The whitening of the distinct whole-number vectors of `df`.

    The dimension is the length that most distinct vectors have, of equal counts the shorter; vectors of no entries
    count for nothing. Only counts, one state of the moments and the model reach the driver.
    """
    distinct = settle(whole_numbers(df, vector, scale, []).distinct(), "whitening-fit")
    usual = distinct.groupBy(F.size("x").alias("size")).count().where("size > 0").orderBy(F.desc("count"), "size").first()
    if usual is None:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    size = usual["size"]
    own = distinct.where(F.size("x") == size)
    total = moments(own, "x", size)
    values, vectors = symmetric_qr(total.covariance())
    model = Whitening(total.n, size, total.sums, values[:components], vectors[:, :components], float(np.trace(total.covariance())))
    solid = model.solid()
    if solid.any():
        k = int(solid.sum())

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = model.project(lists(batch.column("x"), pa.int64(), size))[:, :k]
                bounds = pa.array(np.arange(0, out.size + 1, k, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(bounds, pa.array(np.ascontiguousarray(out).ravel()))], names=["w"])

        white = moments(own.mapInArrow(apply, "w array<double>"), "w", k)
        model.identity_error = float(np.abs(white.covariance() - np.eye(k)).max())
    return model


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """A row for each vector and component: (key, component, n, deviation, whitened, explained, identity_error).

    Vectors that are null or hold null or non-finite entries are left out, and so are vectors of another length than
    the model's. Repeated and null keys are judged row by row; an empty table stays empty. A component
    without variance has null whitened values, and explained is null where nothing varies. `deviation` is exact; it is
    null where it is beyond the range of a long.
    """
    size, n, k = model.size, model.n, len(model.values)
    sums, solid = list(model.sums), model.solid()
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values]
    schema = T.StructType([df.schema[key], *T.StructType.fromDDL(RESULT).fields])

    def deviations(x: np.ndarray) -> list[int | None]:
        far = max((abs(v) for v in (int(x.min(initial=0)), int(x.max(initial=0)))), default=0) * n + max(map(abs, sums), default=0)
        if far * far * size < 2**63:
            d = n * x - np.array(sums, np.int64)
            return (d * d).sum(1).tolist()
        exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
        return [v if v < 2**63 else None for v in exact]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                x = lists(batch.column("x"), pa.int64(), size)
                rows = len(x)
                white = model.project(x).ravel()
                turn = pa.array(np.repeat(np.arange(rows), k))
                columns = [
                    batch.column(key).take(turn), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(deviations(x), pa.int64()).take(turn), pa.array(white, mask=~np.tile(solid, rows)),
                    pa.array(explained * rows, pa.float64()), pa.array([model.identity_error] * (rows * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = whole_numbers(df, vector, scale, [key]).where(F.size("x") == size)
    return rows.mapInArrow(work, schema) if size else rows.sparkSession.createDataFrame([], schema)
