"""URL filters (operator 11): rules indexed by their rarest literal token.

A rule is a host with a path, or a pattern; both become a regular expression. A rule's literal
tokens are the runs of digits and letters that stand between fixed marks in it, so that they are
whole tokens of every URL that the rule fits. The index holds each rule under the one of them that
the fewest URLs have. A URL's tokens fetch its candidate rules, and only those are run as expressions.
DataFrame functions only; the index is written, so that Spark sees by its size whether it may be
broadcast, and else joins by shuffle and splits hot tokens.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.shared import free_name, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The part after the first ://, as host, path and the rest.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)"
#: Host or subdomain: what may stand before a host.
BELOW = r"(?s)^(?:[^/?#]*\.)?"
#: A token of a rule with a fixed mark on each side.
FIXED_TOKEN = "(?<=[^0-9a-z*])[0-9a-z]+(?=[^0-9a-z*])"


def fold(x: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(x, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z in lower case; empty for null and without ://."""
    return fold(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ? or #; empty for null and without ://."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def address_of(url: Column) -> Column:
    """The URL without its scheme, the host in lower case."""
    return F.concat(host_of(url), path_of(url), F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")))


def tokens_of(address: Column) -> Column:
    """The distinct runs of digits and letters."""
    return F.array_distinct(F.regexp_extract_all(fold(address), F.lit("[0-9a-z]+"), F.lit(0)))


def _literal(x: Column) -> Column:
    return F.regexp_replace(x, r"([\\.\[\]{}()*+?^$|])", r"\\$1")


def host_rules(rules: DataFrame) -> DataFrame:
    """Rules out of (verdict, host, path): each fits its host and all subdomains where the path starts with its own, case counting.

    They go before pattern rules. Rows with a null are no rules; repeated ones count once.
    """
    host, path = fold(F.col("host")), F.col("path")
    regex = F.concat(F.lit(BELOW), _literal(host), F.lit(r"(?=[/?#]|\z)"), _literal(path))
    marks = F.concat(F.lit("|"), host, F.when(path == "", "^").otherwise(fold(path)))
    rank = F.struct(F.lit(1).alias("tier"), F.length(F.concat(host, path)).alias("size"), F.length(host).alias("host_size"), (F.col("verdict") == "block").cast("int").alias("block"), F.concat(host, path).alias("rule"))
    return _known(rules).select(rank.alias("rank"), "verdict", F.lit(True).alias("cased"), regex.alias("regex"), marks.alias("marks")).where("regex is not null").distinct()


def pattern_rules(rules: DataFrame) -> DataFrame:
    """Rules out of (verdict, pattern), looked for anywhere in the URL without its scheme, case not counting.

    `||` at the start stands for the start of the host or of a part of it, `|` for the URL's start or end, `*` for
    any characters, `^` for one that is no letter, digit, `_`, `.`, `%` or `-`, or the end. Null patterns are no rules.
    """
    pattern = fold(F.col("pattern"))
    start = F.when(pattern.startswith("||"), F.lit(BELOW)).when(pattern.startswith("|"), F.lit("(?s)^")).otherwise(F.lit("(?s)"))
    body = F.regexp_replace(F.regexp_replace(pattern, r"^\|{1,2}", ""), r"\|$", "")
    shown = F.replace(F.replace(_literal(body), F.lit(r"\*"), F.lit(".*")), F.lit(r"\^"), F.lit(r"(?:[^0-9a-z_.%-]|\z)"))
    regex = F.concat(start, shown, F.when(F.length(body) > 0, F.when(pattern.endswith("|"), r"\z").otherwise("")).otherwise(""))
    rank = F.struct(F.lit(0).alias("tier"), F.length(pattern).alias("size"), F.lit(0).alias("host_size"), (F.col("verdict") == "block").cast("int").alias("block"), F.col("pattern").alias("rule"))
    return _known(rules).select(rank.alias("rank"), "verdict", F.lit(False).alias("cased"), regex.alias("regex"), pattern.alias("marks")).where("regex is not null").distinct()


def _known(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("verdict").isin("allow", "block"))


def rules_of(spark: SparkSession, hosts: Iterable[tuple[str, str, str]] = (), patterns: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """Both kinds of rules from lists of (verdict, host, path) and (verdict, pattern)."""
    one = spark.createDataFrame(list(hosts), "verdict string, host string, path string")
    two = spark.createDataFrame(list(patterns), "verdict string, pattern string")
    return host_rules(one).union(pattern_rules(two))


def build_index(rules: DataFrame, urls: DataFrame, column: str = "url") -> DataFrame:
    """Rules with `token`, the one of their fixed tokens that the fewest of `urls` have (of equal counts the first by name).

    A rule without a fixed token has the empty one, which every URL has. The counts take in all URLs; only
    tokens that some rule has are counted, a row a token and task before the shuffle.
    """
    listed = settle(rules.withColumn("tokens", F.array_distinct(F.regexp_extract_all(F.col("marks"), F.lit(FIXED_TOKEN), F.lit(0)))), "url-rules")
    wanted = settle(listed.select(F.explode("tokens").alias("token")).distinct(), "url-rule-tokens")
    seen = urls.select(F.explode(tokens_of(address_of(F.col(f"`{column}`")))).alias("token"))
    counts = seen.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    each = listed.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
    rarest = each.groupBy("rank", "verdict", "cased", "regex").agg(F.min_by("token", F.struct(F.coalesce("times", F.lit(0)), "token")).alias("token"))
    without = listed.where(F.size("tokens") == 0).select("rank", "verdict", "cased", "regex", F.lit("").alias("token"))
    return settle(rarest.unionByName(without), "url-index")


def judge(df: DataFrame, index: DataFrame, column: str = "url", otherwise: str = "allow") -> DataFrame:
    """`df` with host, path, rule, pattern and verdict.

    Of the host rules that fit, the longest gives `rule` and the verdict (of equal lengths the one with the longer host,
    then the one that blocks); else the longest pattern that fits gives `pattern` and the verdict; else
    it is `otherwise`. Null URLs and those without :// have an empty host and path, and no rule fits them. Rows that are
    repeated, or share a URL, are each judged; an empty table stays empty. A column of `df` with a new
    column's name keeps it, and the new one gets an underscore. URLs of any length are read whole.

    Candidates are run where the URL's tokens stand; one row for each URL that a rule fits goes on, added up
    in each task first, and meets the rows by their URL.
    """
    url = F.col(f"`{column}`")
    address = address_of(F.col("url"))
    own = df.select(url.alias("url")).where("url is not null").select("url", F.explode(F.array_append(tokens_of(address), F.lit(""))).alias("token"))
    met = own.join(index, "token")
    target = F.when(F.col("cased"), address).otherwise(fold(address))
    fits = met.where(F.regexp_like(target, F.col("regex")) & (address != ""))
    best = fits.groupBy("url").agg(F.max(F.struct("rank", "verdict")).alias("best"))
    names = {x: free_name(x, df.columns) for x in ("host", "path", "rule", "pattern", "verdict")}
    key, kept = free_name("key", df.columns), free_name("best", df.columns)
    joined = df.join(best.select(F.col("url").alias(key), F.col("best").alias(kept)), url == F.col(key), "left")
    rank = F.col(kept)["rank"]
    return joined.select(
        *(F.col(f"`{c}`") for c in df.columns), host_of(url).alias(names["host"]), path_of(url).alias(names["path"]),
        F.when(rank["tier"] == 1, rank["rule"]).alias(names["rule"]), F.when(rank["tier"] == 0, rank["rule"]).alias(names["pattern"]),
        F.coalesce(F.col(kept)["verdict"], F.lit(otherwise)).alias(names["verdict"]),
    )
