"""Chat formatting over reply trees (operator 2).

DataFrame functions only. Messages name their parents. Self-joins that double the distance
give each message its jump pointers and, in as many rounds as the depth has binary
digits, the mean score of its branch; the leaves of a tree are ranked by that. The chosen
leaves' paths are enumerated by the same pointers, a row per message of a path, and each
path becomes one conversation.

Template: `### role: text </turn>` and a line feed for each turn. Inside roles and texts a
backslash becomes \\b, the bracket of `</turn>` becomes \\l, a number sign before two more
becomes \\h, and in roles a colon becomes \\c; so no text can hold a control string, and
undoing it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.llm.shared import settle

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
#: Rounds of pointer doubling that are run before the size of the trees is counted, to tell long threads from rings.
ASSURED_ROUNDS = 6


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("</turn>"), F.lit("\\l/turn>"))
    out = F.regexp_replace(out, "#(?=##)", r"\\h")
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(text: Column) -> Column:
    for code, plain in (("\\c", ":"), ("\\l", "<"), ("\\h", "#"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame] | DataFrame:
    """Pointers to the 1st, 2nd, 4th ... message above, and (tree, node, depth, total score) of every message.

    If after as many rounds as the largest tree's size has binary digits a message still has one further above,
    parents form a ring; then (tree, node) of the lowest message of each ring is returned instead. Joins here are sorted and merged: pointers are
    small on disk and large in memory, and the driver would hold each that Spark takes for small enough to broadcast.
    """
    start = nodes.select("tree", "node", F.col("parent").alias("to"), F.col("parent").alias("low"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    # Messages whose branch is not summed up to its root yet are those that have one as many places above them as the jump is long: their pointers are the jump.
    open_, done, pointers, rounds = start.where("to is not null"), start.where("to is null"), [], None
    while not open_.isEmpty():
        if len(pointers) == ASSURED_ROUNDS:
            rounds = nodes.groupBy("tree").count().agg(F.max("count")).first()[0].bit_length()
        if rounds is not None and len(pointers) >= rounds:
            # A message is as many places above some message as that jump is long if and only if it is on a ring.
            ring = open_.select("tree", F.col("to").alias("node")).distinct()
            return ring.join(open_.where(F.col("node") == F.col("low")).hint("merge"), ["tree", "node"], "left_semi")
        pointers.append(open_.select("tree", "node", "to"))
        # Messages whose branch is summed up are only looked at, not carried on.
        far = open_.union(done).select("tree", F.col("node").alias("to"), F.col("to").alias("to_2"), F.col("low").alias("low_2"), F.col("depth").alias("depth_2"), F.col("total").alias("total_2"))
        further = settle(open_.join(far.hint("merge"), ["tree", "to"]).select(
            "tree", "node", F.col("to_2").alias("to"), F.least("low", "low_2").alias("low"), (F.col("depth") + F.col("depth_2")).alias("depth"), (F.col("total") + F.col("total_2")).alias("total"),
        ), "jump")
        open_, done = further.where("to is not null"), done.union(further.where("to is null"))
    return pointers, done.select("tree", "node", "depth", "total")


def branches(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, step, role, text): the messages of the `best` branches of each tree.

    `messages`: tree, node, parent (null for a root), role, text, score; other columns are not read. Branches are
    ranked by their mean score, the longer and then the lower leaf first on ties; None takes
    all. A parent that does not exist ends the branch. Of parents that form a ring, the lowest node counts as a root, so that
    what hangs from the ring stays; a ring without anything below it is a chain from that node on. Null tree ids are a tree, null roles and
    texts stay null here, a null score makes a branch's mean null, which ranks last. Each row is a message, so that rows that
    share a node are several of its name. An empty table stays empty; a text of any length is only carried.
    """
    # A struct of the tree's id is never null itself, so that a null id is a tree like others.
    messages = messages.select(F.struct("tree").alias("tree"), "node", "parent", "role", "text", "score")
    known = messages.select("tree", F.col("node").alias("parent")).distinct().withColumn("known", F.lit(True))
    nodes = settle(
        messages.join(known.hint("merge"), ["tree", "parent"], "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("parent"), "role", "text", "score"), "messages",
    )
    reached = _jumps(nodes)
    if isinstance(reached, DataFrame):
        roots = reached.withColumn("root", F.lit(True))
        parent = F.when(F.col("root").isNull(), F.col("parent")).alias("parent")
        nodes = settle(nodes.join(roots.hint("merge"), ["tree", "node"], "left").select("tree", "node", parent, "role", "text", "score"), "messages")
        reached = _jumps(nodes)
    pointers, reach = reached
    inner = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reach.join(inner.hint("merge"), ["tree", "node"], "left_anti")
    order = W.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    path = settle(ranked.select("tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("above")), "paths")
    for power, up in reversed(list(enumerate(pointers))):
        higher = path.join(up.hint("merge"), ["tree", "node"]).select("tree", "leaf", "rank", F.col("to").alias("node"), (F.col("above") + (1 << power)).alias("above"))
        path = path.union(settle(higher, "paths"))
    return path.join(nodes.select("tree", "node", "role", "text").hint("merge"), ["tree", "node"]).select("tree.tree", "leaf", "rank", (-F.col("above")).alias("step"), "role", "text")


def format_paths(paths: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): one row a conversation.

    `loss_spans` are the code points of `formatted`, end exclusive, that a model learns:
    the texts of `loss_role`. Null roles and texts are empty. A conversation of any length is one row; other columns are not read.
    """
    turn = F.struct("step", F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit("")), role=True), F.lit(MIDDLE)).alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"), (F.coalesce("role", F.lit("")) == loss_role).alias("learned"))
    rows = paths.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(t["head"])
        end = start + F.char_length(t["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(t["learned"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("turns", F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return rows.select("tree", "leaf", "rank", formatted.alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, CLOSE), lambda x: x != "")

    def turn(x: Column) -> Column:
        at = F.instr(x, MIDDLE)
        role = F.substring(x, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(x, at + len(MIDDLE), F.char_length(x))).alias("text"))

    return F.transform(parts, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def threads(rows: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages from a table of turns: each answers the one before it by (turn, role, text).

    Null roles and texts are empty. Turns of one number follow each other by role and text,
    so equal rows stay apart. A null conversation id is a conversation too.
    """
    order = W.partitionBy("tree").orderBy("turn", "role", "text")
    text = rows.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = text.withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def chat_digest(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """Format the branches, read them back, and report what the output says: a row for each branch taken.

    Null ids are an id, null roles and texts are empty, equal rows are turns of their own, an empty table stays empty, texts of any length
    are read whole, and other columns than `branches` names are not read.
    """
    out = format_paths(branches(messages, best))
    turns = parse(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = learned_text(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        F.col("tree").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
