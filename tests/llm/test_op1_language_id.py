import math
import random
import zlib

import numpy as np

from lexforge.llm import language_id as L


def brute_bits(samples, text, order):
    """PPM code length of a text, walked context by context."""
    size = 256
    counts = [{} for _ in range(order + 1)]
    start = [None] * order
    for t in samples:
        history = start + list(t)
        for i in range(len(t)):
            for k in range(order + 1):
                ctx = tuple(history[i + order - k : i + order])
                counts[k].setdefault(ctx, {}).setdefault(t[i], 0)
                counts[k][ctx][t[i]] += 1

    def prob(ctx, byte):
        k = len(ctx)
        seen = counts[k].get(ctx)
        shorter = prob(ctx[1:], byte) if k else 1 / size
        if not seen:
            return shorter
        total, kinds = sum(seen.values()), len(seen)
        return seen[byte] / (total + kinds) if byte in seen else kinds / (total + kinds) * shorter

    history = start + list(text)
    return sum(-math.log2(prob(tuple(history[i : i + order]), text[i])) for i in range(len(text)))


def test_code_lengths_equal_a_walk_of_the_tree():
    rnd = random.Random(3)
    samples = {"a": [bytes(rnd.choices(b"abc ", k=60)) for _ in range(3)], "b": [bytes(rnd.choices(b"acde ", [5, 1, 1, 3, 2], k=80)) for _ in range(2)]}
    trees = L.ContextTrees.fit(samples, order=2)
    texts = [b"", b"a", b"abcabc cab", b"zz top", b"dead ace", bytes(rnd.choices(b"abcde z", k=50))]
    raw, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    got = trees.code_lengths(raw, ends)
    # Contexts may have bytes that only the other language has.
    for n, lang in enumerate(trees.languages):
        for i, text in enumerate(texts):
            assert math.isclose(got[i, n], brute_bits(samples[lang], text, 2), rel_tol=1e-5, abs_tol=1e-5), (lang, text)


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = L.identify(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_is_the_checksum(spark):
    frame = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long")
    for r in frame.select("doc_id", L.held_out(frame.doc_id).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_edge_rows(docs, no_docs):
    trees = L.fit(docs)
    rows = L.identify(docs, trees).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (2, 3, 4, 6))
    assert by_id[None].lang_pred in trees.languages
    assert L.identify(no_docs, L.fit(no_docs)).count() == 0
    assert {r.lang_pred for r in L.identify(docs, L.fit(no_docs)).collect()} == {"und"}
    kept = L.accept(docs, trees)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and {1, None, 7, 8} <= ids and not {2, 3, 4, 6} & ids


def test_windows_add_up(monkeypatch):
    """Any cut of the bytes gives the same whole numbers, also inside a text and with empty texts around."""
    rnd = random.Random(5)
    trees = L.ContextTrees.fit({"a": [b"the cat sat on the mat"], "b": [b"der hund lag im sand", b"und schlief"]}, order=3)
    texts = [bytes(rnd.choices(b"abcdeht zq", k=rnd.randrange(12))) for _ in range(60)] + [b"", b"the hund " * 50, b"", b"x"]
    raw, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    want = trees.code_lengths(raw, ends)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(L, "WINDOW_BYTES", size)
        assert np.array_equal(trees.code_lengths(raw, ends), want)


def test_a_text_of_50_mb_needs_little_memory():
    import tracemalloc

    trees = L.ContextTrees.fit({"a": [b"the cat sat on the mat"], "b": [b"der hund lag im sand"]})
    raw = np.frombuffer(b"the hund sat im mat " * 2_500_000, np.uint8)
    tracemalloc.start()
    bits = trees.code_lengths(raw, np.array([0, len(raw)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20 and (bits > 0).all()


def test_the_sample_is_bounded(spark):
    rows = [(i, f"{'ab' if i % 2 else 'cd'} {i} " * 20, "x" if i % 2 else "y") for i in range(3000)] + [(9998, "z" * 5000, "long")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}

    def keep(samples, order):
        seen.update(samples)
        return L.ContextTrees({}, order)

    fit, L.ContextTrees.fit = L.ContextTrees.fit, keep
    try:
        L.fit(frame, sample_rows=50, sample_bytes=3000)
    finally:
        L.ContextTrees.fit = fit
    assert all(0 < len(own) <= 50 and sum(map(len, own)) <= 3000 for own in seen.values())
    assert zlib.crc32(b"9998") % 4 != 2 and set(seen) == {"x", "y", "long"} and sum(map(len, seen["long"])) == 3000


def test_both_forms_of_a_tree_give_equal_costs():
    """Also for bytes and contexts that the sample lacks, at every order."""
    rnd = random.Random(6)
    for order, letters in ((0, b"abc"), (1, b"ab"), (2, bytes(range(256))), (3, b"abcdefgh ")):
        own = L.Contexts([bytes(rnd.choices(letters, k=rnd.randrange(1, 400))) for _ in range(4)], order)
        table, sparse = L.ContextTree(own), L.SparseTree(own)
        text = bytes(rnd.choices(letters + b"\x00xyz\xff", k=3000))
        history = np.frombuffer(b"\x00" * order + text, np.uint8)
        for starts in (np.array([order]), np.array([order, order + 1, order + 700, order + 2999])):
            assert np.array_equal(table.costs(history, starts), sparse.costs(history, starts)), order


def test_noisy_labels_give_a_result(spark, monkeypatch):
    """200 labels of random bytes, whose tables would take far more than one broadcast may: trees come group by group, and nothing raises."""
    rnd = random.Random(7)
    samples = {f"l{i:03}": [rnd.randbytes(3000)] for i in range(200)} | {"en": [b"the cat sat on the mat and the dog sat on the log "] * 20}
    trees = L.ContextTrees.fit(samples)
    assert L.Contexts(samples["l000"], 3).table_bytes * 200 > 10 * L.MODEL_BYTES
    texts = ["the dog sat on the mat", "Ж" * 30, None, "1 2"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: tuple(r) for r in L.identify(frame, trees).collect()}
    assert want[0][1] == "en" and want[2][1] == want[3][1] == "und"
    monkeypatch.setattr(L, "MODEL_BYTES", 1)
    monkeypatch.setattr(L, "GROUP_BYTES", 5 << 20)
    shared = trees.share(spark)
    assert len(shared.groups) > 2 and not shared.whole
    assert {r.doc_id: tuple(r) for r in L.identify(frame, trees).collect()} == want
    assert [r.doc_id for r in L.accept(frame, trees, lang=None).collect()] == [r.doc_id for r in L.accept(frame.withColumn("lang", frame.text), trees, lang="lang").collect()]


def test_the_sample_does_not_depend_on_partitions(spark):
    """Repeated ids with different texts, and equal rows."""
    rows = [(i % 40, f"text {i % 90} of {i % 7}", "xy"[i % 2]) for i in range(600)]
    seen = []
    fit, L.ContextTrees.fit = L.ContextTrees.fit, lambda samples, order: seen.append(samples) or L.ContextTrees({}, order)
    try:
        for parts in (1, 5, 9):
            random.Random(parts).shuffle(rows)
            L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts), sample_rows=20, sample_bytes=300)
    finally:
        L.ContextTrees.fit = fit
    assert seen[0] == seen[1] == seen[2] and set(seen[0]) == {"x", "y"} and all(len(own) <= 20 for own in seen[0].values())


def test_accept_can_hand_the_prediction_on(spark):
    trees = L.ContextTrees.fit({"a": [b"the cat sat on the mat"], "b": [b"der hund lag im sand"]})
    frame = spark.createDataFrame([("the cat", None, 1), ("hund im sand", "a", 2), (None, "a", 3)], "text string, lang string, spoken int")
    assert sorted(tuple(r) for r in L.accept(frame, trees, lang="lang").collect()) == [("hund im sand", "b", 2), ("the cat", "a", 1)]
