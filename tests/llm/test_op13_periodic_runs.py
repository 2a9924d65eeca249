import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from lexforge.llm import periodic_runs as P
from tests.llm.conftest import by_key


def brute_runs(words, least=12):
    """Every stretch by trying all periods; of a stretch the smallest one counts."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute(text, least=12):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(words, least)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    first = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return len(runs), *first, sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def brute_planted(text, doc_id):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))


def texts_of(rnd, count):
    gaps = [" ", "  ", "\n", "\t\x0b ", " \r\n"]
    out = [None, "", " \n ", "a", "a " * 11, "a " * 12, "a b " * 6, "a b " * 6 + "a", "é ß " * 9 + "日 " * 20, " x" * 500]
    for _ in range(count):
        words = []
        for _ in range(rnd.randrange(8)):
            unit = [rnd.choice("abcdé")[: 1 + rnd.randrange(2)] for _ in range(1 + rnd.randrange(9))]
            words += (unit * rnd.randrange(1, 7))[: rnd.randrange(1, 60)]
        out.append("".join(w + rnd.choice(gaps) for w in words))
    return out


def test_equals_brute_force(spark):
    texts = texts_of(random.Random(5), 400)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for least in (12, 2, 5):
        got = {r.doc_id: r for r in P.periodic_runs(frame, least=least).collect()}
        for i, t in enumerate(texts):
            r = got[i]
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == brute(t, least), (i, t, least)
            assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256


def test_names_tell_equal_words():
    rnd = random.Random(2)
    row = np.repeat([0, 1, 2], [40, 1, 60])
    ids = np.array([rnd.randrange(2) for _ in range(101)])
    names = P.power_names(row, ids)
    for k, name in enumerate(names):
        for i in range(101):
            for j in range(i + 1, 101):
                a, b = ids[i : i + 2**k], ids[j : j + 2**k]
                same = row[i] == row[j] and row[min(j + 2**k - 1, 100)] == row[j] and j + 2**k <= 101 and row[min(i + 2**k - 1, 100)] == row[i] and (a == b).all()
                assert (name[i] == name[j]) == same, (k, i, j)


def test_planted_query_over_a_whole_table(spark, tmp_path):
    from lexforge.llm.catalog import op13_periodic_runs

    rnd = random.Random(8)
    rows = [(i, None if i % 19 == 0 else " ".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(90)))) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {i: brute(brute_planted(t, i)) for i, t in rows}
    assert sum(n[0] > 0 for n in got.values()) > 10


def test_very_long_text(spark):
    unit = [f"w{i}" for i in range(70_001)]
    rnd = random.Random(3)
    text = " ".join(unit * 3 + [f"v{rnd.randrange(10**9)}" for _ in range(200_000)])
    r = P.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), keep_text=False).collect()[0]
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.collapsed) == (1, 0, 210_003, 70_001, 3000, None)


def test_edge_rows(docs, no_docs):
    rows = P.periodic_runs(docs.withColumn("start", F.lit("own"))).collect()
    assert len(rows) == 10 and all(r.start == "own" and r.n_runs == 0 and r.start_ is None for r in rows)
    assert P.periodic_runs(no_docs).count() == 0
    twice = by_key(P.periodic_runs(docs), "doc_id", "collapsed_sha256")
    assert twice.count((1, hashlib.sha256(b"The cat sat on the mat and the dog sat on the log").hexdigest())) == 2
