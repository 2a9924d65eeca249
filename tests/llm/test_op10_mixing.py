import random

from pyspark.sql import functions as F

from lexforge.llm import mixing as M


def fill(children, budget):
    """Budget by weight among (name, cap, weight); what one cannot take goes to the rest."""
    out, open_ = {}, list(children)
    while open_:
        rate = budget / sum(w for _, _, w in open_)
        full = [c for c in open_ if c[1] <= c[2] * rate]
        if not full:
            return out | {n: w * rate for n, _, w in open_}
        for n, cap, _ in full:
            out[n] = cap
            budget -= cap
        open_ = [c for c in open_ if c not in full]
    return out


def tree_budgets(leaves, weights, total, levels=3):
    def go(prefix, budget):
        if len(prefix) == levels:
            return {prefix: budget}
        names = sorted({k[len(prefix)] for k in leaves if k[: len(prefix)] == prefix})
        own = [(n, sum(v for k, v in leaves.items() if k[: len(prefix) + 1] == (*prefix, n)), weights.get(n, 1)) for n in names]
        parts = fill(own, budget)
        return {k: v for n in names for k, v in go((*prefix, n), parts[n]).items()}

    return go((), min(total, sum(leaves.values())))


def test_budgets_equal_the_recursive_form(spark):
    rnd = random.Random(6)
    leaves = {(f"d{a}", f"l{b}", f"s{c}"): rnd.randrange(1, 1000) for a in range(3) for b in range(3) for c in range(4)}
    weights = {f"{k}{i}": rnd.randrange(1, 5) for k in "dls" for i in range(4)}
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "a string, b string, c string, tokens long")
    levels = {"a": weights, "b": weights, "c": weights}
    total = sum(leaves.values())
    for part in (0.2, 0.6, 0.95, 3.0):
        got = {(r.a, r.b, r.c): r.budget for r in M.budgets(frame, ["a", "b", "c"], int(total * part), levels, 2).collect()}
        want = tree_budgets({k: 2 * v for k, v in leaves.items()}, weights, int(total * part))
        assert all(abs(got[k] - want[k]) <= 1 for k in leaves), part


def test_prefixes_reach_their_budgets(spark):
    rows = [(i, f"s{i % 3 and 1}", "w " * (1 + i % 5)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    drawn = M.draw(frame, {"source": F.col("source")}, {"source": {"s0": 3}}, share=0.8, epochs=3).collect()
    size = {i: 1 + i % 5 for i in range(300)}
    total = sum(size.values())
    cap = sum(v for i, v in size.items() if i % 3 == 0)
    first = min(3 * cap, int(total * 0.8) * 3 / 4)
    taken = {s: sum(r.copies * r.n_tokens for r in drawn if r.source == s) for s in ("s0", "s1")}
    assert 0 <= taken["s0"] - int(first) < 5 and 0 <= taken["s1"] - int(int(total * 0.8) - first) < 5
    assert all(r.n_tokens == size[r.doc_id] for r in drawn)
    again = M.draw(frame.repartition(5), {"source": F.col("source")}, {"source": {"s0": 3}}, share=0.8, epochs=3)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, drawn))


def test_edge_rows(docs, no_docs):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    rows = M.draw(docs, levels, {}, share=1.0).collect()
    assert sum(r.n_tokens * r.copies for r in rows) >= sum(len((r.text or "").split()) for r in docs.collect())
    assert M.draw(docs, levels, {"lang": {"fr": 0}}, share=1.0).where("lang = 'fr'").count() == 0
    assert M.draw(no_docs, levels, {}).count() == 0
    assert "digest" in M.draw(docs, levels, {}).columns


def test_clashing_columns_stay_and_ties_go_together(spark):
    rows = [(i // 2, "s", "w " * 4, -5, 99, "mine") for i in range(40)] + [(None, None, None, -5, 99, "mine"), (7, "s", "", -5, 99, "mine")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, n_tokens int, copies int, _n string")
    for c in ("_key", "_copies", "_level_0", "place", "cut"):
        frame = frame.withColumn(c, F.lit("mine"))
    out = M.draw(frame, {"source": F.col("source")}, {}, share=0.5)
    assert out.columns == [*frame.columns, "n_tokens_", "copies_"]
    got = out.collect()
    assert all((r.n_tokens, r.copies, r["_n"], r["_key"], r["_level_0"]) == (-5, 99, "mine", "mine", "mine") for r in got)
    taken = [r.doc_id for r in got if r["n_tokens_"]]
    assert len(taken) == 20 and all(taken.count(i) == 2 for i in taken)  # rows of one id and length
    long = spark.createDataFrame([(1, "s", "w " * 500_000), (2, "s", "w")], "doc_id long, source string, text string")
    assert {r.doc_id: r["n_tokens"] for r in M.draw(long, {"source": F.col("source")}, {}).collect()} == {1: 500_000, 2: 1}
