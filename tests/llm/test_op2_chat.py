import hashlib
import random

from lexforge.llm import chat


def test_escape_is_reversible_and_hides_control_strings(spark):
    rnd = random.Random(5)
    parts = ["\\", "#", "##", "###", "</turn>", "</", "turn>", "\\l", "\\h", "\\b", ": ", "a", "\n", "é"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(9))) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", chat.escape(frame.t).alias("e"), chat.unescape(chat.escape(frame.t)).alias("u"), chat.unescape(chat.escape(frame.t, role=True)).alias("r")).collect():
        assert r.u == r.t == r.r and "###" not in r.e and "</turn>" not in r.e


def test_turns_come_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 2, "assistant", "\\### Assistant: </turn> ok"), (1, 1, None, None), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (2, 0, "as:sis", ""), (None, 0, "user", "x")]
    got = {r.conv_id: r for r in chat.chat_digest(chat.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    told = [("user", "hi"), ("", ""), ("assistant", "tie"), ("assistant", "tie"), ("assistant", "\\### Assistant: </turn> ok")]
    assert got[1].n_turns == 5
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in told).encode()).hexdigest()
    learned = "tietie\\### Assistant: </turn> ok"
    assert got[1].loss_chars == len(learned) and got[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert got[2].n_turns == 1 and got[2].loss_chars == 0 and got[None].n_turns == 1


def test_branches_of_a_tree(spark):
    # 1 - 2 - 4 - 6 and 1 - 3 - 5, and a message whose parent is missing.
    messages = [(9, 1, None, "user", "a", 1.0), (9, 2, 1, "assistant", "b", 2.0), (9, 3, 1, "assistant", "c", 5.0), (9, 4, 2, "user", "d", 0.0), (9, 5, 3, "user", "e", 0.0), (9, 6, 4, "assistant", "f", 1.0), (8, 1, 77, "user", "z", 0.0)]
    frame = spark.createDataFrame(messages, "tree long, node long, parent long, role string, text string, score double")
    rows = chat.branches(frame, best=None).collect()
    paths = {}
    for r in sorted(rows, key=lambda r: (r.tree, r.rank, r.step)):
        paths.setdefault((r.tree, r["rank"]), []).append(r.text)
    assert paths == {(9, 1): ["a", "c", "e"], (9, 2): ["a", "b", "d", "f"], (8, 1): ["z"]}
    assert {r.leaf for r in chat.branches(frame, best=1).where("tree = 9").collect()} == {5}


def test_long_threads_and_empty_tables(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(37)]
    out = chat.chat_digest(chat.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert len(out) == 1 and out[0].n_turns == 37
    assert chat.chat_digest(chat.threads(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def paths_of(frame, best=None):
    paths = {}
    for r in sorted(chat.branches(frame, best).collect(), key=lambda r: (str(r.tree), r["rank"], r.step)):
        paths.setdefault((r.tree, r["rank"]), []).append(r.text)
    return paths


def test_rings_end(spark, monkeypatch):
    """A ring of three with a tail, a message that answers itself, and a whole tree beside them."""
    schema = "tree long, node long, parent long, role string, text string, score double"
    rows = [(1, 5, 7, "u", "5", 0.0), (1, 6, 5, "u", "6", 0.0), (1, 7, 6, "u", "7", 0.0), (1, 8, 6, "u", "8", 9.0), (1, 9, 8, "u", "9", 9.0), (2, 1, 1, "u", "self", 0.0), (3, 1, None, "u", "a", 0.0), (3, 2, 1, "u", "b", 0.0), (4, 1, 2, "u", "x", 0.0), (4, 2, 1, "u", "y", 0.0)]
    for assured in (0, 1, 6):
        monkeypatch.setattr(chat, "ASSURED_ROUNDS", assured)
        assert paths_of(spark.createDataFrame(rows, schema)) == {(1, 1): ["5", "6", "8", "9"], (1, 2): ["5", "6", "7"], (2, 1): ["self"], (3, 1): ["a", "b"], (4, 1): ["x", "y"]}


def test_chains_longer_than_the_assured_rounds(spark, monkeypatch):
    monkeypatch.setattr(chat, "ASSURED_ROUNDS", 1)
    for n in (1, 2, 3, 4, 5, 8, 9, 33):
        rows = [(1, i, i - 1 if i else None, "u", str(i), 0.0) for i in range(n)]
        assert paths_of(spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")) == {(1, 1): [str(i) for i in range(n)]}


def test_scores_rank_branches_of_random_trees(spark):
    rnd = random.Random(11)
    rows, want = [], {}
    for tree in range(12):
        parent = {i: (rnd.randrange(i) if i else None) for i in range(rnd.randrange(1, 25))}
        score = {i: float(rnd.randrange(4)) for i in parent}
        rows += [(tree, i, p, "u", f"{tree}:{i}", score[i]) for i, p in parent.items()]

        def up(i, parent=parent):
            return [] if i is None else [*up(parent[i]), i]

        leaves = sorted(set(parent) - set(parent.values()), key=lambda i: (-sum(score[j] for j in up(i)) / len(up(i)), -len(up(i)), i))
        want |= {(tree, k + 1): [f"{tree}:{j}" for j in up(i)] for k, i in enumerate(leaves[:3])}
    rnd.shuffle(rows)
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "tree long, node long, parent long, role string, text string, score double, depth string, known string")
    assert paths_of(frame.repartition(5), best=3) == want


def test_very_long_texts_and_clashing_columns(spark):
    body = "### </turn> \\é " * 200_000
    frame = spark.createDataFrame([(1, 0, "user", "q", "x", "x"), (1, 1, "assistant", body, "x", "x")], "conv_id long, turn long, role string, text string, node string, turns string")
    r = chat.chat_digest(chat.threads(frame)).first()
    assert r.n_turns == 2 and r.loss_sha256 == hashlib.sha256(body.encode()).hexdigest() and r.loss_chars == len(body)


def test_pointers_are_written_once_a_round_and_never_broadcast(spark, monkeypatch):
    """What the driver holds does not grow with the messages; ten messages in a chain and a ring of three."""
    plans, real = [], chat.settle

    def settle(df, label, *more):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, label, *more)

    monkeypatch.setattr(chat, "settle", settle)
    schema = "tree long, node long, parent long, role string, text string, score double"
    chain, ring = [(1, i, i - 1 if i else None, "u", str(i), 0.0) for i in range(10)], [(2, i, (i + 1) % 3, "u", str(i), 0.0) for i in range(3)]
    for rows, most in ((chain, 4), (ring, 12)):  # jumps of 1, 2, 4 and 8; a ring is told after the assured rounds
        plans.clear()
        plans.append(("result", chat.branches(spark.createDataFrame(rows, schema))._jdf.queryExecution().executedPlan().toString()))
        assert not any("Broadcast" in plan for _, plan in plans)
        assert len([1 for label, _ in plans if label in ("jump", "reach")]) <= most
