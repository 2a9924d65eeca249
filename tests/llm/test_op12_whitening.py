import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexforge.llm import whitening as W

NAN, INF = float("nan"), float("inf")


def brute(rows, components=4):
    """Results by whole-number sums and the library's solver."""
    good = [(k, [math.floor(256 * float(np.float32(c))) for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[n * a - b for a, b in zip(x, s, strict=True)] for x in fit], float) / n
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = {}
    for k, x in good:
        d = [n * a - b for a, b in zip(x, s, strict=True)]
        out.setdefault(k, []).append((n, sum(a * a for a in d), (np.array(d) / n) @ q / np.sqrt(e), e / np.trace(v)))
    return out


def compare(got, want):
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert set(by) == set(want)
    signs = {}
    for key, lists in want.items():
        rows = sorted(by[key], key=lambda r: r.component)
        assert len(rows) == sum(len(w[2]) for w in lists)
        for r in rows:
            n, deviation, white, explained = lists[0]
            c = r.component - 1
            assert (r.n, r.deviation) == (n, deviation)
            assert abs(r.explained - explained[c]) <= 1e-9 and r.identity_error <= 1e-6
            if abs(white[c]) > 1e-3:
                sign = math.copysign(1, r.whitened * white[c])
                assert signs.setdefault(c, sign) == sign
            assert abs(abs(r.whitened) - abs(white[c])) <= 1e-7


def vectors(count, size, seed):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(count, size)) * np.linspace(2, 0.1, size) + rnd.normal(size=size)
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(base)]


def test_query_equals_brute_force(spark, tmp_path):
    from lexforge.llm.catalog import op12_embedding_whitening

    rows = vectors(900, 16, 1)
    rows += [(i + 900, rows[3][1]) for i in range(400)] + [(2000, None), (2001, [1.0, None] + [0.0] * 14), (2002, [NAN] * 16), (2003, [INF] + [0.0] * 15), (2004, [-0.0] * 16), (None, [0.5] * 16)]
    random.Random(2).shuffle(rows)
    spark.createDataFrame([(k, v, 0) for k, v in rows], "vec_id long, embedding array<float>, label int").repartition(40).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op12_embedding_whitening(spark, str(tmp_path)).collect()
    compare(got, brute(rows))


def test_merges_in_rounds_equal_one_pass(spark):
    rows = [(i, v) for i, v in vectors(3000, 6, 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(300)
    assert 300 > W.FAN**2
    many = W.moments(frame, "embedding", 6)
    x = np.array([v for _, v in rows])
    assert many.n == 3000 and np.allclose(many.mean, x.mean(0), atol=1e-12) and np.allclose(many.covariance(), np.cov(x.T, bias=True), atol=1e-12)


def test_welford_keeps_small_variances_beside_large_means():
    x = np.random.default_rng(3).integers(-3, 4, (5000, 3)) + 10**9
    one = W.Moments.empty(3)
    for at in range(0, 5000, 7):
        one.add(x[at : at + 7])
    exact = np.cov((x - 10**9).T.astype(float), bias=True)
    assert np.allclose(one.covariance(), exact, rtol=1e-6, atol=1e-9) and one.sums == x.sum(0).tolist()


@pytest.mark.parametrize("size", [1, 2, 3, 10, 64, 150])
def test_symmetric_qr(size):
    rnd = np.random.default_rng(size)
    for kind in range(4):
        a = rnd.normal(size=(size, size))
        a = a @ a.T if kind == 0 else a + a.T if kind == 1 else np.diag(rnd.integers(0, 3, size).astype(float)) if kind == 2 else np.outer(a[0], a[0]) * 1e150
        e, q = W.symmetric_qr(a)
        scale = max(np.abs(a).max(), 1e-300)
        assert np.all(np.diff(e) <= 0) and np.allclose(q.T @ q, np.eye(size), atol=1e-12)
        assert np.allclose(a @ q / scale, q * (e / scale), atol=1e-11 * size)
        assert np.allclose(np.sort(e / scale), np.linalg.eigvalsh(a / scale), atol=1e-11 * size)


def test_edge_rows(spark):
    schema = "vec_id long, embedding array<float>, x string, n string"
    none = spark.createDataFrame([], schema)
    assert W.whiten(none, W.fit(none)).count() == 0
    same = spark.createDataFrame([(1, [0.5, 0.25], "clash", "clash")] * 3, schema)
    rows = W.whiten(same, W.fit(same)).collect()
    assert len(rows) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error is None for r in rows)
    mixed = spark.createDataFrame([(1, [0.5, 0.25], "", ""), (2, [1.5, 0.25], "", ""), (3, [], "", ""), (4, [1.0], "", ""), (5, None, "", "")], schema)
    rows = W.whiten(mixed, W.fit(mixed)).collect()
    assert {(r.vec_id, r.component) for r in rows} == {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert all((r.whitened is None) == (r.component == 2) for r in rows) and {abs(round(r.whitened, 9)) for r in rows if r.component == 1} == {1.0}
    huge = spark.createDataFrame([(1, [3e38, 1.0], "", ""), (2, [-3e38, 0.0], "", ""), (3, [0.0, 2.0], "", "")], schema)
    rows = W.whiten(huge, W.fit(huge)).collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows if r.vec_id < 3)


def test_dimension_of_long_vectors(spark):
    frame = spark.range(300).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.sin(F.col("id") * i)).alias("embedding"))
    model = W.fit(frame)
    assert model.size == 300 and model.identity_error < 1e-9 and W.whiten(frame, model).count() == 1200
