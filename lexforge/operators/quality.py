"""Data-quality checks as tables, and the scored report.

A check is a row: name, bad (rows against it), total, rate, limit (the rate it may reach), level.
`enforce` raises for fatal ones. All checks of a table come from one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEBREW = r"[֐-׿יִ-ﭏ]"


def blank(x: str | Column) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return x.isNull() | (x == "")


def has_script(x: Column, pattern: str = HEBREW) -> Column:
    return F.coalesce(x.rlike(pattern), F.lit(False))


def valid_match_type(x: Column) -> Column:
    return F.coalesce(x.isin("direct", "triangulation") | x.rlike(r"^fuzzy_\d+(\.\d+)?$"), F.lit(False))


class MissingColumns(ValueError):
    pass


def require(df: DataFrame, *columns: str) -> None:
    if lost := [c for c in columns if c not in df.columns]:
        raise MissingColumns(f"missing columns: {lost}")


def checks(df: DataFrame, rules: list[tuple[str, Column, float, str]]) -> DataFrame:
    """(check, bad, total, rate, limit, level, passed); rules: name, condition of a bad row, allowed rate, level."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *_bad(rules))
    return counts.select(F.inline(F.array(*_verdicts(rules))))


def _bad(rules: list[tuple[str, Column, float, str]]) -> list[Column]:
    return [F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r_{name}") for name, bad, _, _ in rules]


def _verdicts(rules: list[tuple[str, Column, float, str]], total: str = "total") -> list[Column]:
    """A struct for each rule from the counts of bad rows and of all."""
    rate = lambda name: F.when(F.col(total) > 0, F.col(f"r_{name}") / F.col(total)).otherwise(F.lit(0.0))
    return [F.struct(
        F.lit(name).alias("check"), F.col(f"r_{name}").alias("bad"), F.col(total).alias("total"), rate(name).alias("rate"), F.lit(float(limit)).alias("limit"),
        F.lit(level).alias("level"), (rate(name) <= limit).alias("passed"),
    ) for name, _, limit, level in rules]


def failing_rows(df: DataFrame, rules: list[tuple[str, Column, float, str]], *shown: str, order: str = "row_idx", n: int = 10) -> DataFrame:
    """(check, place, order, shown...): the first `n` rows against each rule, by `order` and then by what is shown.

    A row goes on once for each rule that it breaks, and each task keeps its own first `n` of a rule before they meet, so
    that a rule that most rows break is no hot key. A rule that nothing breaks has no row; an empty table gives an empty result.
    """
    broken = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad, _, _ in rules)))
    rows = df.select(F.explode(broken).alias("check"), order, *shown)
    place = F.row_number().over(W.partitionBy("check").orderBy(order, *(c for c in shown if c != order)))
    return rows.withColumn("place", place).where(F.col("place") <= n).select("check", "place", order, *shown)


def enforce(report: DataFrame) -> DataFrame:
    """Raise for failed checks of level `fatal`."""
    if bad := [f"{r.check}: {r.bad} of {r.total}" for r in report.where("level = 'fatal' and not passed").collect()]:
        raise ValueError("; ".join(bad))
    return report


def entry_rules(hebrew: bool = False) -> list[tuple[str, Column, float, str]]:
    rules = [
        ("empty_word", blank("word"), 0.0, "fatal"), ("pos_unknown", blank("pos") | (F.col("pos") == "unknown"), 0.2, "warning"),
        ("empty_definitions", F.coalesce(F.size("definitions"), F.lit(0)) <= 0, 0.1, "warning"),
    ]
    if hebrew:
        rules.append(("no_hebrew_script", ~has_script(F.col("word")), 0.05, "warning"))
    return rules


def entry_checks(df: DataFrame, hebrew: bool = False) -> DataFrame:
    require(df, "word", "pos", "definitions")
    return checks(df, entry_rules(hebrew))


ALIGNED_COLUMNS = ("es_word", "he_word", "sense_id", "match_type", "es_definition", "he_ipa")


def with_duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Adds `copies`: rows that share all keys, itself included; all of several copies are flagged."""
    several = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(several, same, "left").select(*df.columns, F.coalesce("copies", F.lit(1)).alias("copies"))


def alignment_rules(df: DataFrame) -> list[tuple[str, Column, float, str]]:
    """The rules of aligned rows that `with_duplicates` has counted."""
    confidence = F.col("confidence") if "confidence" in df.columns else F.lit(None).cast("double")
    fuzzy = F.coalesce(F.startswith("match_type", F.lit("fuzzy")), F.lit(False))
    return [
        ("null_es_word", F.col("es_word").isNull(), 0.0, "fatal"), ("null_he_word", F.col("he_word").isNull(), 0.0, "fatal"), ("null_sense_id", F.col("sense_id").isNull(), 0.0, "fatal"),
        ("sense_id_below_1", F.col("sense_id") < 1, 0.0, "error"), ("duplicates", F.col("copies") > 1, 0.0, "warning"),
        ("match_type", ~valid_match_type(F.col("match_type")), 0.0, "warning"), ("confidence", fuzzy & ((confidence < 0) | (confidence > 1)), 0.0, "warning"),
        ("no_hebrew_script", ~has_script(F.col("he_word")), 0.05, "warning"), ("missing_ipa", blank("he_ipa"), 0.2, "warning"),
    ]


def alignment_checks(df: DataFrame) -> DataFrame:
    require(df, *ALIGNED_COLUMNS)
    return checks(with_duplicates(df, "es_word", "he_word", "sense_id"), alignment_rules(df))


def example_checks(df: DataFrame) -> DataFrame:
    """The alignment checks, and examples that lack a side."""
    broken = F.coalesce(F.exists("examples", lambda e: e["es"].isNull() | e["he"].isNull()), F.lit(False))
    return alignment_checks(df).unionByName(checks(df, [("broken_examples", broken, 0.0, "warning")]))


def document_checks(documents: DataFrame, ipa: float = 0.8) -> DataFrame:
    """Checks of nested documents; the share of senses with a transcription is a check on senses. The documents are gone through once."""
    senses = F.col("entry.senses")
    lost = lambda field: F.coalesce(F.exists(senses, lambda s: s[field].isNull()), F.lit(False))
    rules = [
        ("missing_id_or_entry", F.col("id").isNull() | F.col("entry").isNull(), 0.01, "fatal"), ("missing_word", blank("entry.word"), 0.0, "error"),
        ("language", ~F.coalesce(F.col("entry.language").isin("es", "he"), F.lit(False)), 0.0, "error"), ("no_senses", F.coalesce(F.size(senses), F.lit(0)) <= 0, 0.0, "error"),
        ("missing_sense_id", lost("sense_id"), 0.0, "error"), ("missing_hebrew", lost("hebrew"), 0.0, "error"),
    ]
    silent = ("senses_without_ipa", None, round(1 - ipa, 10), "warning")
    number = lambda x: F.coalesce(F.sum(F.when(senses.isNotNull(), F.size(x))), F.lit(0)).cast("long")
    counts = documents.agg(
        F.count(F.lit(1)).alias("total"), *_bad(rules), number(senses).alias("senses"),
        number(F.filter(senses, lambda s: F.coalesce(s["ipa_hebrew"], F.lit("")).isin("", "None"))).alias("r_senses_without_ipa"),
    )
    return counts.select(F.inline(F.array(*_verdicts(rules), *_verdicts([silent], "senses"))))


def quality_score(coverage: Column, duplicates: Column, n: Column) -> Column:
    penalty = F.when((duplicates > 0) & (n > 0), F.least(F.lit(50.0) * (duplicates / n), F.lit(20.0))).otherwise(F.lit(0.0))
    return F.lit(100.0) - F.lit(30.0) * (F.lit(1.0) - coverage) - penalty


def verdict(score: Column) -> Column:
    return F.when(score >= 90, "EXCELLENT").when(score >= 75, "GOOD").when(score >= 60, "ACCEPTABLE").otherwise("NEEDS_IMPROVEMENT")


def quality_report(df: DataFrame, word: str = "es_word", keys: tuple[str, ...] = ("es_word", "he_word", "sense_id"), ipa: str = "he_ipa", kind: str = "match_type") -> DataFrame:
    """One row: counts, rates, polysemy, score, verdict, and the issues found."""
    n = F.count(F.lit(1))
    base = df.agg(
        n.alias("total_entries"), F.count_if(F.coalesce(F.col(kind) == "direct", F.lit(False))).alias("direct"), F.count_if(F.coalesce(F.length(ipa) > 2, F.lit(False))).alias("with_ipa"),
    )
    words = df.groupBy(word).agg(n.alias("n")).agg(F.count_if(F.col("n") > 1).alias("polysemic_words"), F.coalesce(F.max("n"), F.lit(0)).alias("max_senses"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_senses"))
    copies = df.groupBy(*keys).agg(n.alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicates"))
    share = lambda c: F.when(F.col("total_entries") > 0, F.col(c) / F.col("total_entries")).otherwise(F.lit(0.0))
    all_ = base.crossJoin(words).crossJoin(copies).withColumn("direct_rate", share("direct")).withColumn("ipa_coverage", share("with_ipa"))  # one row each
    raw = quality_score(F.col("ipa_coverage"), F.col("duplicates"), F.col("total_entries"))
    issues = F.filter(F.array(
        F.when(F.col("direct_rate") < 0.5, F.lit("low direct match rate")), F.when(F.col("ipa_coverage") < 0.8, F.lit("low IPA coverage")),
        F.when(F.col("duplicates") > 0, F.lit("duplicate alignments")),
    ), lambda x: x.isNotNull())
    return all_.select(
        "total_entries", "direct_rate", "ipa_coverage", "polysemic_words", "max_senses", "avg_senses", "duplicates",
        F.greatest(F.lit(0.0), raw).alias("overall_quality_score"), verdict(raw).alias("verdict"), issues.alias("issues"),
    )


def band(rate: Column, good: float = 0.05, fair: float = 0.20) -> Column:
    """✓ below `good`, ⚠ below `fair`, else ✗; for rates of missing values."""
    return F.when(rate < good, "✓").when(rate < fair, "⚠").otherwise("✗")


def coverage_band(rate: Column, good: float = 0.80, fair: float = 0.50) -> Column:
    return F.when(rate >= good, "✓").when(rate >= fair, "⚠").otherwise("✗")


def completeness(df: DataFrame, *columns: str) -> DataFrame:
    """(column, missing, rate, band) of each named column; empty strings are missing."""
    n = F.count(F.lit(1))
    counts = df.agg(n.alias("n"), *(F.count_if(blank(F.col(c).cast("string"))).alias(f"m_{c}") for c in columns))
    rate = lambda c: F.when(F.col("n") > 0, F.col(f"m_{c}") / F.col("n")).otherwise(F.lit(0.0))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("missing"), rate(c).alias("rate"), band(rate(c)).alias("band")) for c in columns))))


def flag_duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys come more than once, all copies."""
    return df.withColumn("copies", F.count(F.lit(1)).over(W.partitionBy(*keys))).where("copies > 1")
