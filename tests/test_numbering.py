import random

from pyspark.sql import functions as F

from lexforge.operators import clean, examples
from lexforge.operators.numbering import placed


def test_places_are_gapless_and_in_order(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(300), rnd.choice(["es", "he", None]), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "x int, lang string, i int").repartition(7)
    got = [(r.x, r.i) for r in placed(frame, [F.desc("x"), F.col("i")], "n").orderBy("n").collect()]
    assert got == sorted(((x, i) for x, _, i in rows), key=lambda r: (-r[0], r[1]))
    within = placed(frame, [F.col("x"), F.col("i")], "n", within="lang").collect()
    for lang in ("es", "he", None):
        own = sorted((r.n, r.x, r.i) for r in within if r.lang == lang)
        assert [n for n, *_ in own] == list(range(len(own))) and [r[1:] for r in own] == sorted((x, i) for x, y, i in rows if y == lang)
    none = frame.limit(0)
    assert placed(none, [F.col("x")], "n", within="lang").count() == 0


def test_dense_rank_equals_a_sorted_list_and_no_task_sorts_all(spark):
    rnd = random.Random(2)
    rows = [(i, None if i % 50 == 0 else rnd.randrange(400) / 7 if i % 3 else 1.5) for i in range(3000)]
    frame = spark.createDataFrame(rows, "i int, score double")
    out = clean.dense_rank_desc(frame, "score", "rank")
    order = {s: k + 1 for k, s in enumerate(sorted({s for _, s in rows if s is not None}, reverse=True))}
    assert {r.i: r["rank"] for r in out.collect()} == {i: order.get(s) for i, s in rows}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert clean.dense_rank_desc(frame.limit(0), "score", "rank").count() == 0


def test_pairs_by_position(spark):
    """Ties, equal rows, null texts, and sides of different lengths."""
    rnd = random.Random(3)
    rows = [(i // 2 if i % 5 else i, rnd.choice(["es", "he", "xx"]), rnd.choice([None, "a", "b", f"t{i}"])) for i in range(400)]
    rows += [(7, "es", "a")] * 3
    frame = spark.createDataFrame(rows, "row_idx long, lang string, text string")
    out = examples.pair_by_position(frame.repartition(5)).collect()
    es, he = ([(i, t) for i, lang, t in rows if lang == x] for x in ("es", "he"))
    n = min(len(es), len(he))
    assert sorted(r.row_idx for r in out) == list(range(n))
    by = sorted(out, key=lambda r: r.row_idx)
    for side, name in ((es, "es"), (he, "he")):
        numbers = sorted(i for i, _ in side)[:n]
        texts = {}
        for i, t in side:
            texts.setdefault(i, []).append(t)
        for k, r in enumerate(by):
            texts[numbers[k]].remove(r[name])  # each row is used once
    assert examples.pair_by_position(frame.limit(0)).count() == 0
    plan = examples.pair_by_position(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_examples_over_blocks_equal_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(examples, "BLOCK_BITS", 3)
    rnd = random.Random(4)
    pairs = [(i // 2, f"es{i}", f"he{i}", [rnd.choice("abc") for _ in range(rnd.randrange(4))], [rnd.choice("xyz") for _ in range(rnd.randrange(4))]) for i in range(120)]
    pairs += [(500, None, None, None, ["x"]), (501, "e", "h", ["hot"], ["x"]), (501, "e", "h", ["hot"], ["x"])]
    frame = spark.createDataFrame(pairs, "row_idx long, es string, he string, es_words array<string>, he_words array<string>").repartition(4)
    words = [("a", "x"), ("b", "y"), ("hot", "x"), ("none", "x"), (None, "x"), ("a", "x")]
    aligned = spark.createDataFrame([(i, e, h) for i, (e, h) in enumerate(words)], "i int, es_word string, he_word string")
    got = {r.i: [(e.es, e.he) for e in r.examples] for r in examples.enrich(aligned, frame).collect()}
    for i, (e, h) in enumerate(words):
        want = sorted((k, a, b) for k, a, b, x, y in pairs if e in (x or []) and h in (y or []) and e is not None)
        assert got[i] == [(a, b) for _, a, b in want], (e, h)
    assert examples.example_rows(aligned.limit(0), frame).count() == 0 and examples.example_rows(aligned, frame.limit(0)).count() == 0


def test_only_words_of_pairs_are_written(spark, monkeypatch):
    """And each example once, whatever its number of words."""
    written = []
    real = examples.settle
    monkeypatch.setattr(examples, "settle", lambda df, label: written.append(real(df, label)) or written[-1])
    rows = [(i, f"es{i}", f"he{i}", ["a", "unlisted", "a", None], ["x", "unlisted", "b"]) for i in range(9)]
    frame = spark.createDataFrame(rows, "row_idx long, es string, he string, es_words array<string>, he_words array<string>")
    aligned = spark.createDataFrame([("a", "x"), ("a", "b"), ("b", "x")], "es_word string, he_word string")
    got = {(r.es_word, r.he_word): [e.es for e in r.examples] for r in examples.enrich(aligned, frame).collect()}
    assert got == {("a", "x"): [f"es{i}" for i in range(9)], ("a", "b"): [f"es{i}" for i in range(9)], ("b", "x"): []}
    cells = [str(r) for df in written for r in df.collect()]
    assert not any("unlisted" in c for c in cells)
    assert [sum(f"'es{i}'" in c for c in cells) for i in range(9)] == [1] * 9


def test_rows_are_made_once(spark):
    """Finding the ranges and dealing the rows do not each make them."""
    from pyspark.sql import functions as F

    from lexforge.operators.numbering import placed

    made = spark.sparkContext.accumulator(0)

    def one(x):
        made.add(1)
        return (x,)

    rows = spark.createDataFrame(spark.sparkContext.parallelize(range(100), 2).map(one), "x long")
    assert [r.n for r in placed(rows, [F.desc("x")], "n").orderBy("x").collect()] == list(range(99, -1, -1))
    assert made.value == 100
