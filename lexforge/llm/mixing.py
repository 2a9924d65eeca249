"""Mixing sources to target weights by hierarchical budgeting (operator 10).

DataFrame functions only. Documents hang below the leaves of a tree, say domain,
language, source. A node may give as many tokens as its leaves have in `epochs` passes.
From the root down, each node's budget goes to its children by weight; a child that cannot
take its share gives the rest back to its siblings, by weight again, and only what a
whole family cannot take is left to the families around it. Each leaf then fills its budget with whole
passes over its documents, and with a prefix of one more pass in an order seeded by the
pass.

Budgets are worked out on one row a node. The prefix is found step by step, first over 256
blocks of the order, then over 256 parts of the one block where it ends, and so on, and at last over the rows of
the smallest part, so that no task ever has more than a few hundred sums of a leaf or a sliver of its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.llm.shared import free_name, settle

#: Hexadecimal digits of the order key that name a block of a step, and the steps: the last part is one in 16 million of a leaf.
STEP_DIGITS, STEPS = 2, 3


def count_words(text: Column) -> Column:
    """Words between white space, the token count where none is given; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = [F.when(F.col(level) == name, F.lit(w)) for name, w in weights.get(level, {}).items()]
    return F.coalesce(*known, F.lit(weights.get(level, {}).get("*", 1))).cast("long")


def budgets(leaves: DataFrame, levels: list[str], total: int, weights: dict[str, dict[str, int]], epochs: int) -> DataFrame:
    """(levels, tokens, budget) of every leaf; `leaves` has the levels and their `tokens`.

    Among siblings in the order of capacity over weight, those before the first that can
    take its share of what is left are full, and the others share by weight.
    """
    wanted = reduce(lambda x, y: x & y, (_weight(c, weights) > 0 for c in levels))
    nodes = leaves.withColumn("cap", F.when(wanted, F.col("tokens") * F.lit(epochs)).otherwise(F.lit(0)).cast("long"))
    nodes = nodes.withColumn("budget", F.lit(float(total)))
    for depth in range(len(levels)):
        path = levels[: depth + 1]
        family = W.partitionBy(*levels[:depth])
        at = nodes.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first("budget").alias("given")).withColumn("w", F.greatest(_weight(levels[depth], weights), F.lit(1)))
        before = family.orderBy(F.col("cap") / F.col("w"), F.col(levels[depth])).rowsBetween(W.unboundedPreceding, -1)
        rest = F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))
        shares = F.sum("w").over(family) - F.coalesce(F.sum("w").over(before), F.lit(0))
        at = at.withColumn("rate", rest / shares).withColumn("full", F.col("cap") <= F.col("w") * F.col("rate"))
        at = at.withColumn("level_rate", F.max(F.when(~F.col("full"), F.col("rate"))).over(family))
        at = at.withColumn("part", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.greatest(F.lit(0.0), F.col("w") * F.col("level_rate"))))
        same = reduce(lambda x, y: x & y, (F.col(f"n.{c}").eqNullSafe(F.col(f"a.{c}")) for c in path))
        nodes = nodes.alias("n").join(at.select(*path, "part").alias("a"), same).select("n.*", "a.part").drop("budget").withColumnRenamed("part", "budget")
    return nodes.select(*levels, "tokens", F.floor("budget").cast("long").alias("budget"))


def _order(key: Column, tokens: Column, seed: int, epoch: Column) -> Column:
    """Where a document stands in a pass; rows of one key and length stand together."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.concat_ws(":", F.md5(name.cast("binary")), F.lpad(tokens.cast("string"), 12, "0"))


def draw(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], share: float = 1.0, epochs: int = 1, seed: int = 0, key: str = "doc_id", text: str = "text", tokens: Column | None = None) -> DataFrame:
    """Every row that the mixture takes, with all its columns, and behind them `n_tokens` and `copies`.

    The total budget is `share` of all tokens. Weights are whole numbers by level and value;
    "*" is the weight of values that a level does not list (else 1). Missing values of
    a level form a branch of their own. Rows that share key and length are taken together.
    A leaf takes the shortest prefix that reaches its budget, so that it exceeds the budget
    by less than one document's tokens. Null and empty texts have no tokens and come with the rows around them;
    a null key is a key like others. Repeated rows are each taken; a text of any length is only counted.
    An empty table gives an empty result. Where `docs` has a column `n_tokens` or `copies`, that stays, and the
    new one has an underscore more behind its name.
    """
    names, own = list(levels), docs.columns
    tag = [f"_level_{i}" for i in range(len(names))]
    count = tokens if tokens is not None else count_words(F.col(text))
    tagged = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)), *(F.coalesce(x.cast("string"), F.lit("\x00")).alias(t) for x, t in zip(levels.values(), tag, strict=True)), count.alias("_n"))
    slim = settle(tagged.select(F.col(f"c{own.index(key)}").alias("_key"), *tag, "_n"), "mix-rows")
    named = {t: weights.get(n, {}) for n, t in zip(names, tag, strict=True)}
    leaves = settle(slim.groupBy(*tag).agg(F.sum("_n").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    plan = budgets(leaves, tag, int(total * share), named, epochs)
    plan = plan.withColumn("passes", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("long"))
    plan = settle(plan.withColumn("need", F.col("budget") - F.col("passes") * F.col("tokens")), "mix-plan")

    wanted = plan.select(*tag, "passes", "need").where("need > 0")
    rows = slim.join(wanted, tag).withColumn("place", _order(F.col("_key"), F.col("_n"), seed, F.col("passes")))
    ending = rows.select(*tag, "need", "place", "_n", F.lit(0).cast("long").alias("before"))
    for step in range(STEPS):
        ending = ending.withColumn("block", F.substring("place", 1 + step * STEP_DIGITS, STEP_DIGITS))
        blocks = ending.groupBy(*tag, "need", "before", "block").agg(F.sum("_n").alias("n"))
        start = F.col("before") + F.coalesce(F.sum("n").over(W.partitionBy(*tag).orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        last = blocks.withColumn("start", start).where("start < need").groupBy(*tag).agg(F.max_by(F.struct("block", "start"), "block").alias("end"))
        last = settle(last.select(*tag, F.col("end.block").alias("block"), F.col("end.start").alias("start")), "mix-block")
        ending = settle(ending.join(last, [*tag, "block"]).select(*tag, "need", "place", "_n", F.col("start").alias("before")), "mix-ending")
    ending = ending.groupBy(*tag, "before", "need", "place").agg(F.sum("_n").alias("n"))
    inside = F.coalesce(F.sum("n").over(W.partitionBy(*tag).orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = ending.withColumn("at", F.col("before") + inside).where("at < need").groupBy(*tag).agg(F.max("place").alias("cut"))
    rule = settle(plan.join(cut, tag, "left").select(*tag, "passes", "cut"), "mix-rule")

    taken = tagged.join(rule, tag)
    place = _order(F.col(f"c{own.index(key)}"), F.col("_n"), seed, F.col("passes"))
    copies = F.col("passes") + F.when(F.col("cut").isNotNull() & (place <= F.col("cut")), F.lit(1)).otherwise(F.lit(0))
    taken = taken.withColumn("_copies", copies.cast("long")).where("_copies > 0")
    return taken.select(*(F.col(f"c{i}") for i in range(len(own))), "_n", "_copies").toDF(*own, free_name("n_tokens", own), free_name("copies", own))
