"""The operators applied to the test tables, each with the same result as DuckDB SQL.

The tables hold no dictionary, so each operator works on a table of the same shape:
words are tokens or part names, an entry's translations are the names its brand lists, and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexforge.functions import ipa as ipa_functions
from lexforge.functions import similarity, text
from lexforge.operators import align, clean, examples, monitor, parse, quality, senses, stats
from lexforge.plans.recovery import scratch
from lexforge.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# DuckDB's forms of the tokenisers and of the similarity.
RAW_TOKENS = r"list_filter(regexp_split_to_array(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), ' '), lambda w: length(w) > {n})"
ES_TOKENS = rf"""list_transform({RAW_TOKENS.format(n=2)}, lambda w: lower(trim(w, '.,!?;:()[]"''')))"""
HE_TOKENS = rf"""list_transform({RAW_TOKENS.format(n=1)}, lambda w: trim(w, '.,!?;:()[]"'''))"""


def lcs_sql(pairs: str) -> str:
    """CTEs `scored` (x, y, score) for a relation `pairs` (x, y): one row of the table at a time."""
    return f"""
step AS (
  SELECT x, y, 0 AS i, list_transform(range(0, length(y) + 1), lambda k: 0) AS r FROM {pairs}
  UNION ALL
  SELECT x, y, i + 1, list_reduce(list_concat([[0]], list_transform(range(1, length(y) + 1), lambda k: [CAST(k AS BIGINT)])),
    lambda acc, k: list_append(acc, CASE WHEN substr(y, CAST(k[1] AS INT), 1) = substr(x, i + 1, 1) THEN r[k[1]] + 1 ELSE greatest(r[k[1] + 1], acc[-1]) END))
  FROM step WHERE i < length(x)
), scored AS (
  SELECT x, y, CASE WHEN length(x) + length(y) = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * (2 * r[-1]) / (length(x) + length(y)) END AS score
  FROM step WHERE i = length(x)
)"""


# Scans, projections and filters


@query("""
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
FROM events GROUP BY event_type""")
def json_props(spark, sf):
    k = F.element_at(F.from_json("props", "map<string,string>"), "k").cast("long")
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k_sum"))


@query("""
SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, '') AS source FROM documents
WHERE lang IN ('es', 'fr', 'de') AND coalesce(text, '') != ''""")
def lang_filter_project(spark, sf):
    own = table(spark, sf, "documents").where(F.col("lang").isin("es", "fr", "de") & (F.coalesce("text", F.lit("")) != ""))
    return own.select("doc_id", F.coalesce("lang", F.lit("unknown")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))


@query(f"""
WITH t AS (SELECT doc_id, {ES_TOKENS} AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
f AS (SELECT doc_id, word, min(i) AS i FROM p WHERE word != '' GROUP BY doc_id, word)
SELECT t.doc_id, coalesce(string_agg(word, ' ' ORDER BY i), '') AS words FROM t LEFT JOIN f USING (doc_id) GROUP BY t.doc_id""")
def translations_distinct(spark, sf):
    own = table(spark, sf, "documents")
    return own.select("doc_id", text.joined(text.first_distinct(text.tokenize_spanish(F.col("text")))).alias("words"))


@query(rf"""
WITH p AS (SELECT unnest({RAW_TOKENS.format(n=0)}) AS word FROM documents)
SELECT word, count(*) AS n FROM p
WHERE word != '' AND (word IN ('{"', '".join(clean.ABBREVIATIONS)}') OR NOT regexp_matches(word, '^\p{{Lu}}')) GROUP BY word""")
def proper_noun_filter(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split(text.strip(F.col("text")), text.SPACE)).alias("word")).where("word != ''")
    return clean.filter_proper_nouns(words).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


TAGS = {"ECONOMY": "Name", "PROMO": "PROPN", "SMALL": "proper noun"}


@query(f"""
SELECT p_partkey, p_brand AS word, pos FROM (SELECT *, CASE p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in TAGS.items())} WHEN 'LARGE' THEN NULL ELSE lower(p_type) END AS pos, lower(p_name) AS low FROM part)
WHERE pos IS NULL OR lower(pos) NOT IN ('{"', '".join(clean.PROPER_TAGS)}')""")
def proper_noun_tags(spark, sf):
    """Rows with a tag, some of them null; the words themselves are in lower case."""
    pos = F.when(F.col("p_type") == "LARGE", F.lit(None))
    for kind, tag in TAGS.items():
        pos = pos.when(F.col("p_type") == kind, tag)
    part = table(spark, sf, "part").select("p_partkey", "p_brand", F.col("p_name").alias("word"), pos.otherwise(F.lower("p_type")).alias("pos"))
    return clean.filter_proper_nouns(part).select("p_partkey", F.col("p_brand").alias("word"), "pos")


@query("""
WITH u AS (
  SELECT *, CASE lang WHEN 'es' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END AS turn FROM documents WHERE lang IN ('es', 'fr', 'de')
), n AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY turn, doc_id) AS k FROM u)
SELECT lang, source, doc_id, lang AS bridge_source FROM n WHERE k = 1""")
def bridge_union_dedup(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("lang").alias("source_lang"), F.col("source").alias("word"), F.lit("x").alias("pos"), F.col("doc_id").alias("row_idx"), "doc_id")
    out = clean.combine_bridges(**{x: docs.where(F.col("source_lang") == x) for x in ("es", "fr", "de")})
    return out.select(F.col("source_lang").alias("lang"), F.col("word").alias("source"), "doc_id", "bridge_source")


@query(f"""
WITH t AS (SELECT doc_id, len({ES_TOKENS}) AS a, len({HE_TOKENS}) AS b, length(source) AS l FROM documents),
s AS (
  SELECT doc_id, CAST(0.4 AS DOUBLE) * a + CAST(0.4 AS DOUBLE) * b + CAST(0.2 AS DOUBLE) * a + CAST(0.1 AS DOUBLE) * b + CAST(0.3 AS DOUBLE) * a
    + CAST(0.3 AS DOUBLE) * greatest(0::DOUBLE, (10::DOUBLE - l) / 10::DOUBLE) AS frequency_score FROM t
)
SELECT doc_id, frequency_score, CAST(dense_rank() OVER (ORDER BY frequency_score DESC) AS INT) AS frequency_rank FROM s""")
def frequency_rank(spark, sf):
    counts = table(spark, sf, "documents").select("doc_id", F.size(text.tokenize_spanish(F.col("text"))).alias("a"), F.size(text.tokenize_hebrew(F.col("text"))).alias("b"), F.length("source").alias("l"))
    a, b = F.col("a"), F.col("b")
    rows = counts.select("doc_id", clean.frequency_score(a, b, a, b, a, F.col("l")).alias("frequency_score"))
    return clean.dense_rank_desc(rows, "frequency_score", "frequency_rank")


# JSON lines and what is parsed out of them: a part is a record, with parts of it missing or broken as its own columns have it


#: What `code` says where `lang_code` says the key.
CODES = {"es": "he", "he": "es", "en": "en"}


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """(row_idx, value): a line for each part. Lines of the largest sizes lack their end, those of size 1 are blank, and of odd sizes the key of a null tag is absent. `code` names another language than `lang_code`."""
    part = table(spark, sf, "part")
    sound = lambda key, value: F.create_map(F.lit(key), value)
    kind, size = F.col("p_type"), F.col("p_size")
    gloss = lambda *x: F.struct(F.array(*x).cast("array<string>").alias("glosses"))
    word = lambda language, x: F.struct(F.lit(language).alias("lang_code"), F.lit(CODES[language]).alias("code"), x.alias("word"))
    record = F.struct(
        F.when(size != 2, F.col("p_name")).otherwise("").alias("word"), F.when(kind != "ECONOMY", kind).alias("pos"),
        F.when(size <= 20, "es").when(size <= 40, "he").otherwise("fr").alias("lang_code"),
        F.when(size % 4 == 0, F.array(sound("audio", kind), sound("ipa", F.col("p_name")), sound("ipa", kind))).when(size % 4 == 1, F.array(sound("audio", kind))).otherwise(F.array().cast("array<map<string,string>>")).alias("sounds"),
        F.when(size % 3 == 0, F.array(gloss(), gloss(kind, F.col("p_name")), gloss(F.col("p_brand")))).when(size % 3 == 1, F.array(gloss())).alias("senses"),
        F.when(size % 5 > 0, F.array(*(word(x, F.col(c)) for x, c in (("he", "p_brand"), ("en", "p_name"), ("he", "p_type"), ("he", "p_brand"), ("es", "p_name"))), word("he", F.lit("")))).alias("translations"),
    )
    whole = {"ignoreNullFields": "false"}
    text = F.when((size % 2 == 1) & (kind == "ECONOMY"), F.to_json(record.dropFields("pos"), whole)).otherwise(F.to_json(record, whole))
    lines = part.select(F.col("p_partkey").alias("row_idx"), size.alias("size"), text.alias("text"))
    cut = F.substring(F.col("text"), F.lit(1), F.length("text") - 2)
    return lines.select("row_idx", F.when(F.col("size") == 1, "  ").when(F.col("size") >= 48, cut).otherwise(F.col("text")).alias("value"))


PARSED_SQL = """
WITH r AS (
  SELECT p_partkey AS row_idx, p_size AS s, CASE WHEN p_size != 2 THEN p_name ELSE '' END AS word, CASE WHEN p_type != 'ECONOMY' THEN p_type ELSE 'unknown' END AS pos,
    CASE WHEN p_size <= 20 THEN 'es' WHEN p_size <= 40 THEN 'he' ELSE 'fr' END AS lang, CASE WHEN p_size % 4 = 0 THEN p_name ELSE '' END AS ipa,
    CASE WHEN p_size % 3 = 0 THEN p_type || '|' || p_brand ELSE CASE WHEN p_size != 2 THEN p_name ELSE '' END END AS definitions,
    CASE WHEN p_size % 5 > 0 THEN p_brand || '|' || p_type ELSE '' END AS he, CASE WHEN p_size % 5 > 0 THEN p_name ELSE '' END AS en, CASE WHEN p_size % 5 > 0 THEN p_name ELSE '' END AS es
  FROM part WHERE p_size != 1 AND p_size < 48
)"""


def _flat(df: DataFrame) -> DataFrame:
    lists = [c for c, kind in df.dtypes if kind.startswith("array")]
    return df.select(*(F.array_join(c, "|").alias(c) if c in lists else F.col(c) for c in df.columns))


@query(PARSED_SQL + " SELECT row_idx, word, pos, ipa, definitions, en AS translations_en, '' AS translations_fr, '' AS translations_de, he AS translations_he FROM r WHERE lang = 'es' AND word != ''")
def parse_spanish(spark, sf):
    return _flat(parse.spanish_entries(readers.parse_json_lines(_lines(spark, sf))))


@query(PARSED_SQL + " SELECT row_idx, word, pos, ipa, definitions, en AS translations_en, '' AS translations_fr, '' AS translations_de, es AS translations_es FROM r WHERE lang = 'he' AND word != ''")
def parse_hebrew(spark, sf):
    return _flat(parse.hebrew_entries(readers.parse_json_lines(_lines(spark, sf))))


@query(PARSED_SQL + " SELECT row_idx, lang AS source_lang, word, pos, ipa, definitions, es AS translations_es, he AS translations_he FROM r WHERE lang IN ('es', 'he') AND s % 5 > 0 AND word != ''")
def parse_bridge(spark, sf):
    return _flat(parse.bridge_entries(readers.parse_json_lines(_lines(spark, sf))))


@query("SELECT p_partkey AS row_idx FROM part WHERE p_size >= 48")
def malformed_json_lines(spark, sf):
    return readers.malformed_lines(_lines(spark, sf)).select("row_idx")


# Files: the same lines, written to the shared folder and scanned


def _written(lines: DataFrame, columns: list[str], label: str, files: int, gzip: bool = False) -> str:
    """A folder of `files` text files, or more if the lines come from more splits than that, so that no task reads more than its share; they hold `columns`, tab-separated, in the order of `row_idx`."""
    spark = lines.sparkSession
    path = scratch(spark, label)
    parts = max(files, int(spark.conf.get("spark.sql.shuffle.partitions")), lines.rdd.getNumPartitions())
    ordered = lines.repartitionByRange(parts, "row_idx").sortWithinPartitions("row_idx").select(F.concat_ws("\t", *columns).alias("value"))
    ordered.write.option("compression", "gzip" if gzip else "none").text(path)
    return path


#: Places of the lines in their files, blank and broken ones included.
PLACED_SQL = PARSED_SQL + ", placed AS (SELECT r.*, n FROM r JOIN (SELECT p_partkey AS row_idx, row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part) USING (row_idx))"


@query(PLACED_SQL + " SELECT n AS row_idx, word, pos, ipa, definitions, en AS translations_en, '' AS translations_fr, '' AS translations_de, he AS translations_he FROM placed WHERE lang = 'es' AND word != ''")
def scan_json_lines(spark, sf):
    return _flat(parse.spanish_entries(readers.read_json_lines(spark, _written(_lines(spark, sf), ["value"], "jsonl", 3))))


@query(PLACED_SQL + " SELECT n AS row_idx, lang AS source_lang, word, pos, ipa, definitions, he AS translations_es, es AS translations_he FROM placed WHERE lang IN ('es', 'he') AND s % 5 > 0 AND word != ''")
def scan_gzip_bridge(spark, sf):
    """Several gzip files; the language of a translation is that of `code`."""
    return _flat(parse.bridge_entries(readers.read_translated(spark, _written(_lines(spark, sf), ["value"], "jsonl-gz", 4, gzip=True)), "code"))


@query("""
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, CAST(doc_id AS VARCHAR) AS id, lang, md5(trim(regexp_replace(text, '[\\s"]+', ' ', 'g'))) AS digest FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL""")
def scan_sentences(spark, sf):
    docs = table(spark, sf, "documents").where("text is not null and lang is not null")
    flat = docs.select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("id"), "lang", F.btrim(F.regexp_replace("text", '[\\s"]+', " ")).alias("text"))
    out = readers.read_sentences(spark, _written(flat, ["id", "lang", "text"], "tsv", 3))
    return out.select("row_idx", "id", "lang", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))


# Tokens and pairs


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest({ES_TOKENS}) AS word FROM documents) GROUP BY word")
def tokenize_es(spark, sf):
    own = table(spark, sf, "documents")
    return own.select(F.explode(text.tokenize_spanish(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest({HE_TOKENS}) AS word FROM benchmark) GROUP BY word")
def tokenize_short(spark, sf):
    own = table(spark, sf, "benchmark")
    return own.select(F.explode(text.tokenize_hebrew(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH n AS (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents WHERE lang IN ('es', 'fr'))
SELECT a.k - 1 AS row_idx, md5(a.text) AS es, md5(b.text) AS fr FROM n a JOIN n b USING (k) WHERE a.lang = 'es' AND b.lang = 'fr'""")
def pair_by_position(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_idx"), "lang", F.md5(F.col("text").cast("binary")).alias("text"))
    return examples.pair_by_position(docs, "es", "fr").withColumnRenamed("he", "fr")


# Alignment: an entry is a brand, its translations are the part names it lists


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    lists = part.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("x"), F.min("p_partkey").alias("row_idx"))
    names = F.transform("x", lambda r: r["p_name"])
    return lists.select("row_idx", F.col("p_brand").alias("word"), F.lit("i").alias("ipa"), F.lit("noun").alias("pos"), F.array("p_type").alias("definitions"), names.alias("translations_he"))


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("row_idx"), F.col("p_name").alias("word"), F.concat(F.lit("/"), F.substring("p_name", 1, 3), F.lit("/")).alias("ipa"), F.array("p_type").alias("definitions"))


DIRECT_SQL = """
e AS (SELECT p_brand, p_type, min(p_partkey) AS row_idx, list(p_name ORDER BY p_partkey) AS names FROM part GROUP BY p_brand, p_type),
h AS (SELECT p_name AS he_word, arg_min(p_type, p_partkey) AS he_definition FROM part GROUP BY p_name),
x AS (SELECT p_brand, p_type, row_idx, unnest(names) AS he_word, generate_subscripts(names, 1) AS sense_id FROM e)
"""


@query(f"""
WITH {DIRECT_SQL} SELECT row_idx, p_brand AS es_word, p_type AS es_definition, he_word, he_definition, CAST(sense_id AS INT) AS sense_id, 'direct' AS match_type FROM x JOIN h USING (he_word)""")
def align_direct(spark, sf):
    part = table(spark, sf, "part")
    he = part.select(F.col("p_partkey").alias("row_idx"), F.col("p_name").alias("word"), F.lit("").alias("ipa"), F.array("p_type").alias("definitions"))
    out = align.align_direct(_entries(spark, sf), he)
    return out.select(F.col("ord.a").alias("row_idx"), "es_word", "es_definition", "he_word", "he_definition", "sense_id", "match_type")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def align_anti(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return align.not_in(table(spark, sf, "customer"), "c_custkey", done, "o_custkey").select("c_custkey", "c_name")


@query("""
WITH b AS (
  SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts FROM lineitem GROUP BY l_orderkey
), first_order AS (SELECT o_custkey, min(o_orderkey) AS l_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM b) GROUP BY o_custkey),
x AS (SELECT o_custkey, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM first_order JOIN b USING (l_orderkey)),
h AS (SELECT p_partkey AS p, p_name FROM part)
SELECT CAST(o_custkey AS VARCHAR) AS es_word, CAST(arg_min(p, i) AS VARCHAR) AS he_word, arg_min(p_name, i) AS he_definition, 'triangulation' AS match_type FROM x JOIN h USING (p) GROUP BY o_custkey""")
def align_bridge(spark, sf):
    items = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("x"))
    lists = items.select("l_orderkey", F.transform("x", lambda r: r["l_partkey"].cast("string")).alias("translations_he"))
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    bridge = orders.join(lists, "l_orderkey").select(F.col("l_orderkey").alias("row_idx"), F.lit("es").alias("source_lang"), F.col("o_custkey").cast("string").alias("word"), "translations_he")
    es = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_idx"), F.col("c_custkey").cast("string").alias("word"), F.lit("").alias("ipa"), F.lit("").alias("pos"), F.array("c_name").alias("definitions"), F.array().cast("array<string>").alias("translations_he"))
    he = table(spark, sf, "part").select(F.col("p_partkey").alias("row_idx"), F.col("p_partkey").cast("string").alias("word"), F.lit("").alias("ipa"), F.array("p_name").alias("definitions"))
    return align.align_bridge(es, he, bridge).select("es_word", "he_word", "he_definition", "match_type")


def _nations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("row_idx"), F.col("n_name").alias("word"), F.lit("").alias("ipa"), F.lit("").alias("pos"), F.array("n_name").alias("definitions"), F.array().cast("array<string>").alias("translations_he"))


def _fuzzy_columns(out: DataFrame) -> DataFrame:
    return out.select("es_word", "he_word", F.regexp_extract("match_type", r"fuzzy_(.*)", 1).cast("double").alias("score"), "confidence")


@query(f"""
WITH RECURSIVE pairs AS (SELECT a.n_name AS x, b.n_name AS y, a.n_nationkey AS i, b.n_nationkey AS j FROM nation a JOIN nation b ON a.n_nationkey != b.n_nationkey),
uniq AS (SELECT DISTINCT x, y FROM pairs), {lcs_sql('uniq')}
SELECT x AS es_word, arg_min(y, (-score, j)) AS he_word, max(score) AS score, max(score) / 100 AS confidence FROM pairs JOIN scored USING (x, y) WHERE score >= 80 GROUP BY i, x""")
def align_fuzzy(spark, sf):
    """Every nation against all others."""
    return _fuzzy_columns(align.align_fuzzy(_nations(spark, sf), _nations(spark, sf), apart=True))


@query(f"""
WITH RECURSIVE k AS (SELECT DISTINCT p_name || ' ' || p_type AS t FROM part),
pairs AS (SELECT a.t AS x, b.t AS y FROM k a, k b WHERE a.t != b.t AND 200.0 * least(length(a.t), length(b.t)) >= 80 * (length(a.t) + length(b.t))),
{lcs_sql('pairs')} SELECT x, y, score FROM scored WHERE score >= 80""")
def fuzzy_score_matrix(spark, sf):
    keys = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("text")).distinct()
    pairs = align.similarity_join(keys.withColumn("id", F.col("text")), keys, 80.0)
    return pairs.where("text != match").select(F.col("text").alias("x"), F.col("match").alias("y"), "score")


@query(f"""
WITH RECURSIVE n AS (SELECT DISTINCT p_name FROM part), pairs AS (SELECT a.p_name AS x, b.p_name AS y FROM n a, n b WHERE a.p_name < b.p_name), {lcs_sql('pairs')}
SELECT x, y, score FROM scored""")
def fuzzy_ratio_sql(spark, sf):
    """Every two names of parts, by built-in functions alone."""
    pairs = _name_pairs(spark, sf).where("x < y")
    return pairs.select("x", "y", similarity.ratio_sql(F.col("x"), F.col("y")).alias("score"))


def _name_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(x, y): every name of a part beside every name, itself included."""
    names = table(spark, sf, "part").select(F.col("p_name").alias("x")).distinct()
    return names.crossJoin(names.withColumnRenamed("x", "y"))


def _cascade(spark: SparkSession, sf: str) -> DataFrame:
    """An entry for each brand, size and kind, its word the brand and size. It lists the names of its parts that some order has most of at the highest discount; the bridge
    lists those that some order has most of; what neither reaches is left to the definitions, which are the kinds."""
    part = table(spark, sf, "part").withColumn("word", F.concat_ws("|", "p_brand", "p_size"))
    most = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"), (F.col("l_discount") >= 0.1).alias("cheap")).groupBy("p_partkey").agg(F.bool_or("cheap").alias("cheap"))
    flagged = part.join(most, "p_partkey", "left")
    listed = F.when(F.col("cheap"), F.struct("p_partkey", "p_name"))
    es = flagged.groupBy("word", "p_type").agg(F.transform(F.array_sort(F.collect_list(listed)), lambda r: r["p_name"]).alias("translations_he"), F.min("p_partkey").alias("row_idx"))
    es = es.select("row_idx", "word", F.lit("i").alias("ipa"), F.lit("noun").alias("pos"), F.array("p_type").alias("definitions"), "translations_he")
    links = flagged.where("cheap is not null").groupBy("word").agg(F.min("p_partkey").alias("row_idx"), F.array_sort(F.collect_set("p_name")).alias("translations_he"))
    return align.align(clean.add_frequency_ranks(es), _targets(spark, sf), links.withColumn("source_lang", F.lit("es")))


@query("""
WITH most AS (SELECT l_partkey AS p_partkey, bool_or(l_discount >= 0.1) AS cheap FROM lineitem WHERE l_quantity >= 50 GROUP BY l_partkey),
p AS (SELECT part.*, cheap, p_brand || '|' || p_size AS word FROM part LEFT JOIN most USING (p_partkey)),
e0 AS (SELECT word, p_type, min(p_partkey) AS row_idx, coalesce(list(p_name ORDER BY p_partkey) FILTER (cheap), []) AS names FROM p GROUP BY word, p_type),
s AS (SELECT *, CAST(0.4 AS DOUBLE) * len(names) + CAST(0.4 AS DOUBLE) * 0 + CAST(0.2 AS DOUBLE) * 0 + CAST(0.1 AS DOUBLE) * 0 + CAST(0.3 AS DOUBLE) * 1 + CAST(0.3 AS DOUBLE) * greatest(0::DOUBLE, (10::DOUBLE - length(word)) / 10::DOUBLE) AS score FROM e0),
e AS (SELECT *, dense_rank() OVER (ORDER BY score DESC) AS rank FROM s),
h AS (SELECT p_name AS he_word, arg_min(p_type, p_partkey) AS he_definition FROM part GROUP BY p_name),
direct AS (
  SELECT 1 AS stage, row_idx AS a, i - 1 AS b, word AS es_word, p_type AS es_definition, he_word, he_definition, CAST(i AS INT) AS sense_id, 'direct' AS match_type, CAST(NULL AS DOUBLE) AS confidence
  FROM (SELECT word, p_type, row_idx, unnest(names) AS he_word, generate_subscripts(names, 1) AS i FROM e) JOIN h USING (he_word)
), rest AS (SELECT * FROM e WHERE word NOT IN (SELECT es_word FROM direct)),
link AS (SELECT word, min(p_name) AS he_word FROM p WHERE cheap IS NOT NULL GROUP BY word),
bridged AS (
  SELECT 2 AS stage, min(row_idx) AS a, 0 AS b, word AS es_word, arg_min(p_type, row_idx) AS es_definition, any_value(he_word) AS he_word, any_value(he_definition) AS he_definition, 1 AS sense_id, 'triangulation' AS match_type, CAST(NULL AS DOUBLE) AS confidence
  FROM rest JOIN link USING (word) JOIN h USING (he_word) GROUP BY word
), last AS (SELECT * FROM rest WHERE word NOT IN (SELECT es_word FROM bridged)),
txt AS (SELECT p_type, arg_max(p_name, p_partkey) AS he_word FROM part GROUP BY p_type),
fuzzy AS (
  SELECT 3 AS stage, rank AS a, row_idx AS b, word AS es_word, p_type AS es_definition, he_word, p_type AS he_definition, 1 AS sense_id, 'fuzzy_100.0' AS match_type, CAST(1.0 AS DOUBLE) AS confidence FROM last JOIN txt USING (p_type)
)
SELECT * FROM direct UNION ALL SELECT * FROM bridged UNION ALL SELECT * FROM fuzzy""")
def align_cascade(spark, sf):
    """All entries by all strategies, with the order of the rows: the entry and place of a direct link, the entry of a bridged one, the rank and entry of a fuzzy one."""
    return _cascade(spark, sf).select("ord.stage", "ord.a", "ord.b", "es_word", "es_definition", "he_word", "he_definition", "sense_id", "match_type", "confidence")


@query(f"""
WITH b AS (SELECT DISTINCT unnest({ES_TOKENS}) AS es_word FROM benchmark),
t AS (SELECT doc_id, {ES_TOKENS} AS w, {HE_TOKENS} AS h FROM documents),
d AS (SELECT DISTINCT doc_id, unnest(w) AS es_word FROM t),
o AS (SELECT DISTINCT doc_id, unnest(h) AS es_word FROM t)
SELECT b.es_word, count(doc_id) AS n_examples, coalesce(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id), '') AS ids
FROM b LEFT JOIN (SELECT doc_id, es_word FROM d JOIN o USING (doc_id, es_word)) d USING (es_word) GROUP BY b.es_word""")
def enrich_examples(spark, sf):
    """Words of the whole benchmark table in all documents."""
    return _examples_of(spark, sf, table(spark, sf, "benchmark"))


def _examples_of(spark: SparkSession, sf: str, items: DataFrame) -> DataFrame:
    words = items.select(F.explode(text.tokenize_spanish(F.col("text"))).alias("es_word")).distinct()
    # Both sides are the same text, which is split once.
    docs = table(spark, sf, "documents").select("doc_id", F.array_distinct(text.raw_tokens(F.col("text"))).alias("raw"))
    pairs = docs.select(F.col("doc_id").alias("row_idx"), F.col("doc_id").cast("string").alias("es"), F.lit("").alias("he"), text.spanish_tokens(F.col("raw")).alias("es_words"), text.hebrew_tokens(F.col("raw")).alias("he_words"))
    out = examples.enrich(words.withColumn("he_word", F.col("es_word")), pairs)
    return out.select("es_word", F.size("examples").cast("long").alias("n_examples"), F.array_join(F.transform("examples", lambda e: e["es"]), ",").alias("ids"))


def _cluster_sql(group: str, largest: int) -> str:
    return f"""
WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY {group}) AS n FROM part),
uniq AS (SELECT DISTINCT a.p_name AS x, b.p_name AS y FROM (SELECT DISTINCT p_name FROM part) a, (SELECT DISTINCT p_name FROM part) b), {lcs_sql('uniq')},
near AS (SELECT x, y FROM scored WHERE score > 70),
small AS (SELECT {group}, list(p_name ORDER BY k) AS names, list(p_partkey ORDER BY k) AS keys FROM p WHERE n BETWEEN 2 AND {largest} GROUP BY {group}),
walk AS (
  SELECT {group}, names, keys, 1 AS step_no, [names[1]] AS leaders, [1] AS own FROM small
  UNION ALL
  SELECT {group}, names, keys, step_no + 1, CASE WHEN hit IS NULL THEN list_append(leaders, names[step_no + 1]) ELSE leaders END,
    list_append(own, CAST(coalesce(hit, len(leaders) + 1) AS INT))
  FROM (
    SELECT w.*, (SELECT min(i) FROM (SELECT unnest(w.leaders) AS l, generate_subscripts(w.leaders, 1) AS i) JOIN near ON near.x = l AND near.y = w.names[w.step_no + 1]) AS hit
    FROM walk w WHERE w.step_no < len(w.names)
  )
), done AS (SELECT unnest(keys) AS p_partkey, unnest(own) AS c FROM walk WHERE step_no = len(names))
SELECT p_partkey, CAST(coalesce(c, 1) AS INT) AS semantic_cluster FROM p LEFT JOIN done USING (p_partkey)"""


def _clustered(spark: SparkSession, sf: str, *group: str) -> DataFrame:
    part = table(spark, sf, "part").withColumn("es_word", F.concat_ws("|", *group)).withColumn("ord", F.col("p_partkey"))
    return senses.cluster_senses(part, text="p_name")


@query(_cluster_sql("p_brand, p_size", 10))
def leader_cluster(spark, sf):
    return _clustered(spark, sf, "p_brand", "p_size").select("p_partkey", "semantic_cluster")


@query(_cluster_sql("p_brand, p_type", 10))
def leader_cluster_guard(spark, sf):
    return _clustered(spark, sf, "p_brand", "p_type").select("p_partkey", "semantic_cluster")


# Documents


def _documents(spark: SparkSession, sf: str, words: DataFrame | None = None) -> DataFrame:
    """A document for each customer, a sense for each line of its orders; the Hebrew word is the part's number, or what `words` (l_partkey, he_word) has for it."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.withColumn("he_word", F.col("l_partkey").cast("string")) if words is None else lines.join(words, "l_partkey")
    none = F.expr("cast(array() as array<struct<es:string,he:string>>)")
    rows = lines.select(
        F.struct("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus").alias("ord"), F.col("o_custkey").cast("string").alias("es_word"), F.lit("e").alias("es_ipa"), F.col("l_returnflag").alias("es_pos"),
        F.col("o_orderpriority").alias("es_definition"), "he_word", F.when(F.col("l_linestatus") == "F", F.lit("/x/")).alias("he_ipa"),
        F.col("l_linenumber").alias("sense_id"), none.alias("examples"),
    )
    return senses.structure(rows)


@query("""
SELECT 'es: ' || CAST(o_custkey AS VARCHAR) AS id, string_agg(CAST(l_linenumber AS VARCHAR) || '/' || CAST(l_partkey AS VARCHAR) || '/' || o_orderpriority || '/' || CASE WHEN l_linestatus = 'F' THEN '/x/' ELSE 'None' END, ';'
  ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus) AS senses
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def structure_nested(spark, sf):
    one = F.transform("entry.senses", lambda s: F.concat_ws("/", s["sense_id"].cast("string"), s["hebrew"], s["definition"], s["ipa_hebrew"]))
    return _documents(spark, sf).select("id", F.array_join(one, ";").alias("senses"))


@query("""
SELECT count(DISTINCT o_custkey) AS entries, count(*) AS senses, count(*) FILTER (l_linestatus = 'F') AS senses_with_ipa
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def final_document_stats(spark, sf):
    return senses.document_counts(_documents(spark, sf))


@query("""
WITH d AS (
  SELECT 'es: ' || CAST(o_custkey AS VARCHAR) AS id, string_agg(CAST(l_linenumber AS VARCHAR) || '/' || CAST(l_partkey AS VARCHAR) || '/' || o_orderpriority || '/' || CASE WHEN l_linestatus = 'F' THEN '/x/' ELSE 'None' END, ';'
    ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus) AS senses
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey
)
SELECT row_number() OVER (ORDER BY id) - 1 AS place, id, substr(id, 5) AS word, md5(senses) AS senses, 'es-he | he-es' AS language_direction, '1.0' AS version, '2024-01-01' AS generated_at FROM d""")
def publish_dictionary(spark, sf):
    """Written as one JSON document in parts, and every entry read back from the files."""
    path = scratch(spark, "dictionary")
    writers.write_dictionary(_documents(spark, sf), path, "2024-01-01")
    head, entries = readers.read_dictionary(spark, path)
    one = F.transform("entry.senses", lambda s: F.concat_ws("/", s["sense_id"].cast("string"), s["hebrew"], s["definition"], s["ipa_hebrew"]))
    rows = entries.select("place", "id", "entry.word", F.md5(F.array_join(one, ";").cast("binary")).alias("senses"))
    return rows.crossJoin(F.broadcast(head.drop("source")))  # one row


# Phonetic script: words of documents and names of parts, their letters taken for Hebrew letters and points

LATIN, SCRIPT = "abcdefghijklmnopqrstuvwxyz", "אבָדֶפגהיִכּמנולקרשֹׂוצחיז"


def _hebrew(x: Column) -> Column:
    return F.translate(F.lower(x), LATIN, SCRIPT)


def _hebrew_sql(x: str) -> str:
    return f"translate(lower({x}), '{LATIN}', '{SCRIPT}')"


def _ruled_sql(words: str, variant: str) -> str:
    """CTEs ending in `ruled_<variant>` (word, sound): a walk over each word, a place or two at a time."""
    letters = ipa_functions.CONSONANTS | (ipa_functions.SEPHARDIC if variant == "sephardic" else {})
    pick = lambda of, x: f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in of.items()) + " END"
    pairs = {a + b: v for (a, b), v in ipa_functions.POINTED.items()}
    points = "'" + "', '".join(ipa_functions.VOWELS) + "'"
    w = f"walk_{variant}"
    return f"""
{w} AS (
  SELECT word, 1 AS i, '' AS out FROM {words}
  UNION ALL
  SELECT word, i + CASE WHEN pair IS NOT NULL OR (c = 'י' AND d = 'י') THEN 2 ELSE 1 END,
    out || coalesce(pair, vowel, CASE WHEN letter IS NULL THEN '' WHEN c = 'ו' AND before IS NOT NULL AND d != '' AND d NOT IN ({points}) THEN 'o' WHEN c = 'י' AND d = 'י' THEN 'jj' ELSE letter END)
  FROM (
    SELECT word, i, out, c, d, {pick(pairs, 'c || d')} AS pair, {pick(ipa_functions.VOWELS, 'c')} AS vowel, {pick(letters, 'c')} AS letter, {pick(letters, 'p')} AS before
    FROM (SELECT *, substr(word, i, 1) AS c, substr(word, i + 1, 1) AS d, CASE WHEN i > 1 THEN substr(word, i - 1, 1) END AS p FROM {w} WHERE i <= length(word))
  )
), ruled_{variant} AS (SELECT word, nullif(out, '') AS sound FROM {w} WHERE i > length(word))"""


TOKENS_SQL = f"tokens AS (SELECT DISTINCT {_hebrew_sql('w')} AS word FROM (SELECT unnest({RAW_TOKENS.format(n=0)}) AS w FROM documents) WHERE w != '')"


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "documents").select(F.explode(F.split(text.strip(F.coalesce("text", F.lit(""))), text.SPACE)).alias("w")).where("w != ''").distinct()
    return raw.select(_hebrew(F.col("w")).alias("word")).distinct()


def _known(spark: SparkSession, sf: str) -> DataFrame:
    """A word table: names of promoted parts whole and first words of other names, read as their brands, which are not clean."""
    word = F.when(F.col("p_type") == "PROMO", _hebrew(F.col("p_name"))).otherwise(_hebrew(F.substring_index("p_name", " ", 1)))
    sound = F.when(F.col("p_type") != "ECONOMY", F.concat(F.lit("/"), F.lower("p_brand"), F.lit("(h)/ [x]")))
    return ipa_functions.build_lookup(table(spark, sf, "part").select(F.col("p_partkey").alias("row_idx"), word.alias("word"), sound.alias("ipa")))


KNOWN_SQL = f"""
known AS (
  SELECT CASE WHEN p_type = 'PROMO' THEN {_hebrew_sql('p_name')} ELSE {_hebrew_sql("split_part(p_name, ' ', 1)")} END AS word, arg_max(lower(p_brand), p_partkey) AS ipa
  FROM part WHERE p_type != 'ECONOMY' GROUP BY 1
)"""


def _read_sql(words: str) -> str:
    """CTEs ending in `reading` (word, ipa, method) for a relation of words and phrases."""
    return f"""
parts AS (
  SELECT word, CASE WHEN contains(word, ' ') THEN ' ' ELSE '-' END AS mark, unnest(p) AS part, generate_subscripts(p, 1) AS place
  FROM (SELECT word, list_filter(string_split(word, CASE WHEN contains(word, ' ') THEN ' ' ELSE '-' END), lambda x: x != '') AS p FROM {words})
), single AS (SELECT DISTINCT part AS word FROM parts), {_ruled_sql('single', 'modern')},
sounds AS (SELECT parts.*, known.ipa AS looked, coalesce(known.ipa, sound) AS sound FROM parts LEFT JOIN known ON known.word = part LEFT JOIN ruled_modern r ON r.word = part),
joined AS (SELECT word, CASE WHEN count(sound) = count(*) THEN replace(string_agg(sound, chr(1) ORDER BY place), chr(1), any_value(mark)) END AS ipa, bool_and(looked IS NOT NULL) AS all_looked FROM sounds GROUP BY word),
reading AS (
  SELECT w.word, '/' || coalesce(known.ipa, joined.ipa) || '/' AS ipa,
    CASE WHEN known.ipa IS NOT NULL THEN 'lookup' WHEN joined.ipa IS NULL THEN NULL WHEN all_looked THEN 'lookup' ELSE 'rules' END AS method
  FROM {words} w LEFT JOIN known USING (word) LEFT JOIN joined USING (word)
)"""


@query(f"WITH RECURSIVE {TOKENS_SQL}, {_ruled_sql('tokens', 'modern')}, {_ruled_sql('tokens', 'sephardic')} SELECT word, m.sound AS modern, s.sound AS sephardic FROM ruled_modern m JOIN ruled_sephardic s USING (word)")
def ipa_rules(spark, sf):
    """The rules in both variants, on every word of all documents."""
    return _tokens(spark, sf).select("word", ipa_functions.rules(F.col("word")).alias("modern"), ipa_functions.rules(F.col("word"), "sephardic").alias("sephardic"))


@query(f"""
WITH RECURSIVE {TOKENS_SQL}, {KNOWN_SQL}, names AS (SELECT DISTINCT {_hebrew_sql('p_name')} AS n, {_hebrew_sql('p_type')} AS t FROM part),
words AS (SELECT word FROM tokens UNION SELECT n FROM names UNION SELECT replace(n, ' ', '-') FROM names UNION SELECT n || ' ' || t FROM names UNION SELECT n || ' 7' FROM names),
{_read_sql('words')} SELECT word, ipa, method FROM reading""")
def ipa_lookup_chain(spark, sf):
    """Words of all documents, and phrases of part names with spaces and hyphens, some with a part that nothing reads: whole look-up, parts, rules."""
    names = table(spark, sf, "part").select(_hebrew(F.col("p_name")).alias("n"), _hebrew(F.col("p_type")).alias("t"))
    phrases = names.select(F.explode(F.array("n", F.replace("n", F.lit(" "), F.lit("-")), F.concat_ws(" ", "n", "t"), F.concat("n", F.lit(" 7")))).alias("word"))
    return ipa_functions.transliterate(_tokens(spark, sf).union(phrases), _known(spark, sf))


@query(f"""
WITH RECURSIVE names AS (SELECT DISTINCT p_name, {_hebrew_sql("split_part(p_name, ' ', 1)")} AS word, split_part(p_name, ' ', 1) AS latin FROM part),
one AS (SELECT DISTINCT word, latin FROM names), {_ruled_sql('one', 'modern')}
SELECT word, '[' || latin || ']' AS existing_ipa, '/' || sound || '/' AS generated_ipa, coalesce(sound, '') = latin AS exact_match,
  CASE WHEN coalesce(sound, '') = '' THEN 0.0::DOUBLE ELSE CAST(len(list_filter(string_split(sound, ''), lambda c: contains(latin, c))) AS DOUBLE) / greatest(length(sound), length(latin)) END AS similarity,
  CASE WHEN sound IS NOT NULL THEN 'rules' END AS method FROM one JOIN ruled_modern USING (word)""")
def ipa_compare(spark, sf):
    """What the rules make of the first words of part names, beside the words themselves in brackets."""
    first = F.substring_index("p_name", " ", 1)
    known = table(spark, sf, "part").select(_hebrew(first).alias("word"), F.concat(F.lit("["), first, F.lit("]")).alias("ipa")).distinct()
    return ipa_functions.compare_known(known, _known(spark, sf).limit(0))


RAW_SQL = {"ECONOMY": ("'/' || p_name || '/'", "p_name"), "PROMO": ("'[' || p_name || '] '", "p_name"), "SMALL": ("p_name || ' [' || p_brand || ']'", "p_name"), "MEDIUM": ("'/' || p_name || '/ ~ /' || p_brand || '/'", "p_name"),
    "LARGE": ("'/(' || p_name || ')/'", "NULL"), "STANDARD": ("'  ' || p_name || '   ' || p_brand || '(' || p_size || ')'", "p_name || ' ' || p_brand")}


@query(f"SELECT p_partkey, CASE p_type {' '.join(f"WHEN '{k}' THEN {raw}" for k, (raw, _) in RAW_SQL.items())} END AS raw, CASE p_type {' '.join(f"WHEN '{k}' THEN {out}" for k, (_, out) in RAW_SQL.items())} END AS ipa FROM part")
def ipa_clean(spark, sf):
    """Names of parts in slashes, brackets, with alternatives and optional parts."""
    raw = F.expr(f"CASE p_type {' '.join(f"WHEN '{k}' THEN {x}" for k, (x, _) in RAW_SQL.items())} END")
    return table(spark, sf, "part").select("p_partkey", raw.alias("raw")).withColumn("ipa", text.clean_ipa(F.col("raw")))


@query(f"""
WITH RECURSIVE {KNOWN_SQL}, j AS (
  SELECT o_custkey, l_linestatus = 'F' AS old, {_hebrew_sql('p_name')} AS word, o_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
), words AS (SELECT DISTINCT word FROM j), {_read_sql('words')}
SELECT 'es: ' || CAST(o_custkey AS VARCHAR) AS id, count(*) AS ipa_total, count(*) FILTER (NOT old AND ipa IS NOT NULL) AS ipa_generated, count(*) FILTER (old) AS ipa_skipped, count(*) FILTER (NOT old AND ipa IS NULL) AS ipa_failed,
  md5(string_agg(CASE WHEN old THEN '/x/' ELSE coalesce(ipa, 'None') END, ';' ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus)) AS readings
FROM j JOIN reading USING (word) GROUP BY o_custkey""")
def ipa_fill(spark, sf):
    """The nested documents, filled in place."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), _hebrew(F.col("p_name")).alias("he_word"))
    filled = ipa_functions.fill_documents(_documents(spark, sf, part), _known(spark, sf))
    readings = F.array_join(F.transform("entry.senses", lambda s: s["ipa_hebrew"]), ";")
    return filled.select("id", "ipa_total", "ipa_generated", "ipa_skipped", "ipa_failed", F.md5(readings.cast("binary")).alias("readings"))


@query("""
WITH n AS (SELECT DISTINCT p_name FROM part), p AS (SELECT a.p_name AS x, b.p_name AS y FROM n a, n b)
SELECT x, y, CAST(len(list_filter(string_split(x, ''), lambda c: contains(y, c))) AS DOUBLE) / greatest(length(x), length(y)) AS similarity FROM p""")
def ipa_overlap(spark, sf):
    """Every name of a part beside every name."""
    return _name_pairs(spark, sf).select("x", "y", text.overlap(F.col("x"), F.col("y")).alias("similarity"))


@query("""
SELECT c AS char, count(*) AS count FROM (SELECT unnest(string_split(p_name, '')) AS c FROM part) WHERE c NOT IN (' ', '-') GROUP BY c ORDER BY count DESC, char LIMIT 30""")
def char_frequency(spark, sf):
    return stats.character_counts(table(spark, sf, "part"), "p_name", " -").limit(30)


@query("""
WITH m AS (SELECT DISTINCT n_nationkey, unnest(string_split(n_name, '')) AS c FROM nation EXCEPT
  SELECT n_nationkey, unnest(string_split(r_name, '')) FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c AS char, count(*) AS count FROM m GROUP BY c ORDER BY count DESC, char LIMIT 20""")
def char_missing(spark, sf):
    both = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lost = both.select(F.explode(text.missing_characters(F.col("n_name"), F.col("r_name"))).alias("char"))
    return lost.groupBy("char").count().orderBy(F.desc("count"), "char").limit(20)


@query("SELECT p_name AS word, arg_max(p_type, p_partkey) AS ipa FROM part GROUP BY p_name")
def lookup_last_wins(spark, sf):
    return ipa_functions.build_lookup(table(spark, sf, "part").select(F.col("p_partkey").alias("row_idx"), F.col("p_name").alias("word"), F.col("p_type").alias("ipa")))


# Statistics and charts

R2 = "round_even({} * 100, 0) / 100"


def _doc_entries(spark: SparkSession, sf: str, lang: str) -> DataFrame:
    docs = table(spark, sf, "documents").where(F.col("lang") == lang)
    return docs.select(F.nullif("source", F.lit("src1")).alias("ipa"), F.col("source").alias("pos"), text.tokenize_spanish(F.col("text")).alias("definitions"), text.tokenize_hebrew(F.col("text")).alias("translations"))


@query(f"""
WITH t AS (SELECT lang, nullif(source, 'src1') AS ipa, len({ES_TOKENS}) AS d, len({HE_TOKENS}) AS t FROM documents WHERE lang IN ('es', 'fr'))
SELECT lang, count(*) AS total_entries, count(ipa) AS entries_with_ipa, {R2.format('CAST(count(ipa) AS DOUBLE) / count(*) * 100')} AS ipa_coverage_pct, CAST(sum(t) AS BIGINT) AS total_translations,
  {R2.format('CAST(sum(t) AS DOUBLE) / count(*)')} AS avg_translations_per_entry, {R2.format('avg(d)')} AS avg_definitions_per_entry FROM t GROUP BY lang""")
def parsing_stats(spark, sf):
    out = [stats.entry_stats(_doc_entries(spark, sf, x), "translations").withColumn("lang", F.lit(x)) for x in ("es", "fr")]
    return out[0].union(out[1]).drop("entries_with_nonempty_ipa")


@query("SELECT source, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY count DESC, source LIMIT 10")
def pos_histogram_top10(spark, sf):
    return stats.histogram(table(spark, sf, "documents"), "source").limit(10)


def _aligned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("es_word"), F.col("l_partkey").alias("he_word"), F.col("l_returnflag").alias("es_pos"), "l_linenumber", "l_suppkey")
    listed = rows.withColumn("examples", F.when(F.col("l_linenumber") > 2, F.sequence(F.lit(1), F.col("l_linenumber"))).otherwise(F.array().cast("array<int>")))
    return rows, listed


@query(f"""
WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
p AS (SELECT count(*) AS words, avg(n) AS a, max(n) AS m, count(*) FILTER (n > 1) AS poly FROM s),
e AS (SELECT count(*) AS n, count(DISTINCT l_partkey) AS he, count(*) FILTER (l_linenumber > 2) AS with_some, CAST(sum(CASE WHEN l_linenumber > 2 THEN l_linenumber ELSE 0 END) AS BIGINT) AS ex,
  avg(CASE WHEN l_linenumber > 2 THEN l_linenumber ELSE 0 END) AS ae FROM lineitem)
SELECT e.n AS total_alignments, words AS unique_spanish_words, he AS unique_hebrew_words, {R2.format('CAST(e.n AS DOUBLE) / words')} AS avg_translations_per_word,
  {R2.format('a')} AS avg_senses_per_word, m AS max_senses, poly AS polysemic_words_count, {R2.format('CAST(poly AS DOUBLE) / words * 100')} AS polysemic_words_pct,
  with_some AS entries_with_examples, {R2.format('CAST(with_some AS DOUBLE) / e.n * 100')} AS example_coverage_pct, ex AS total_examples, {R2.format('ae')} AS avg_examples_per_entry FROM p, e""")
def alignment_stats(spark, sf):
    out = stats.alignment_stats(*_aligned(spark, sf))
    return out.select("alignment.*", "polysemy.*", "enrichment.entries_with_examples", "enrichment.example_coverage_pct", "enrichment.total_examples", "enrichment.avg_examples_per_entry")


def _both_stats(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    es, fr = _doc_entries(spark, sf, "es"), _doc_entries(spark, sf, "fr")
    pairs = table(spark, sf, "benchmark").select(text.tokenize_spanish(F.col("text")).alias("es_words"), text.tokenize_hebrew(F.col("text")).alias("he_words"))
    return stats.parsing_stats(es.withColumn("translations_he", F.col("translations")), fr.withColumn("translations_es", F.col("translations")), pairs), stats.alignment_stats(*_aligned(spark, sf))


@query(f"""
WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT (SELECT count(*) FROM documents WHERE lang = 'es') AS total_spanish_entries, (SELECT count(*) FROM documents WHERE lang = 'fr') AS total_hebrew_entries,
  (SELECT count(*) FROM lineitem) AS total_alignments, (SELECT count(*) FROM s) AS final_dictionary_size,
  (SELECT {R2.format("CAST(count(nullif(source, 'src1')) AS DOUBLE) / count(*) * 100")} FROM documents WHERE lang = 'es') AS spanish_ipa_coverage,
  (SELECT count(*) FROM s WHERE n > 1) AS polysemic_words, (SELECT max(n) FROM s) AS max_senses_for_word""")
def progress_summary(spark, sf):
    out = stats.progress_summary(*_both_stats(spark, sf))
    return out.select("pipeline_overview.*", "data_quality.spanish_ipa_coverage", "linguistic_features.polysemic_words", "linguistic_features.max_senses_for_word")


def _pie_sql(chart: str, source: str, column: str) -> str:
    return f"(SELECT '{chart}' AS chart, {column} AS label, CAST(count(*) AS DOUBLE) AS value FROM {source} GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 10)"


@query(f"""
SELECT 'entry_counts' AS chart, CASE lang WHEN 'es' THEN 'Spanish' ELSE 'Hebrew' END AS label, CAST(count(*) AS DOUBLE) AS value FROM documents WHERE lang IN ('es', 'fr') GROUP BY lang
UNION ALL SELECT 'entry_counts', 'Examples', count(*) FROM benchmark
UNION ALL SELECT 'ipa_coverage', CASE lang WHEN 'es' THEN 'Spanish' ELSE 'Hebrew' END, {R2.format("CAST(count(nullif(source, 'src1')) AS DOUBLE) / count(*) * 100")} FROM documents WHERE lang IN ('es', 'fr') GROUP BY lang
UNION ALL {_pie_sql('spanish_pos', "(SELECT * FROM documents WHERE lang = 'es')", 'source')} UNION ALL {_pie_sql('hebrew_pos', "(SELECT * FROM documents WHERE lang = 'fr')", 'source')}""")
def chart_parsing(spark, sf):
    return stats.parsing_charts(_both_stats(spark, sf)[0])


@query(f"""
WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT 'overview' AS chart, 'Alignments' AS label, CAST(count(*) AS DOUBLE) AS value FROM lineitem
UNION ALL SELECT 'overview', 'Spanish words', count(*) FROM s UNION ALL SELECT 'overview', 'Hebrew words', count(DISTINCT l_partkey) FROM lineitem
UNION ALL SELECT 'polysemy', 'Monosemic', count(*) FROM s WHERE n = 1 UNION ALL SELECT 'polysemy', 'Polysemic', count(*) FROM s WHERE n > 1
UNION ALL SELECT 'example_coverage', 'value', {R2.format('CAST(count(*) FILTER (l_linenumber > 2) AS DOUBLE) / count(*) * 100')} FROM lineitem
UNION ALL SELECT 'example_coverage', 'reference', 50 UNION ALL SELECT 'example_coverage', 'threshold', 80 UNION ALL {_pie_sql('pos', 'lineitem', 'l_returnflag')}""")
def chart_alignment(spark, sf):
    return stats.alignment_charts(stats.alignment_stats(*_aligned(spark, sf)))


# Quality


@query("SELECT doc_id, copies FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS copies FROM documents) WHERE copies > 1")
def duplicates_flagged(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return quality.flag_duplicates(docs, "digest").select("doc_id", "copies")


def _check_sql(rows: list[tuple[str, str, str, str, float, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check, count(*) FILTER ({bad}) AS bad, count(*) AS total, CAST(count(*) FILTER ({bad}) AS DOUBLE) / count(*) AS rate, CAST({limit} AS DOUBLE) AS limit_, '{level}' AS level, CAST(count(*) FILTER ({bad}) AS DOUBLE) / count(*) <= CAST({limit} AS DOUBLE) AS passed FROM {source}"
        for name, source, bad, _, limit, level in rows
    )


def _checked(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("limit", "limit_")


ENTRY_SOURCE = f"(SELECT lang AS word, source AS pos, {ES_TOKENS} AS definitions FROM documents) e"


@query(_check_sql([
    ("empty_word", ENTRY_SOURCE, "word IS NULL OR word = ''", "", 0.0, "fatal"), ("pos_unknown", ENTRY_SOURCE, "pos IS NULL OR pos IN ('', 'unknown')", "", 0.2, "warning"),
    ("empty_definitions", ENTRY_SOURCE, "len(definitions) = 0", "", 0.1, "warning"), ("no_hebrew_script", ENTRY_SOURCE, "NOT regexp_matches(word, '[֐-׿]')", "", 0.05, "warning"),
]))
def entry_checks(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("lang").alias("word"), F.col("source").alias("pos"), text.tokenize_spanish(F.col("text")).alias("definitions"))
    return _checked(quality.entry_checks(docs, hebrew=True))


ALIGNED_SOURCE = "(SELECT *, count(*) OVER (PARTITION BY lang, source, quality) AS copies FROM documents JOIN labels USING (doc_id)) a"


@query(_check_sql([
    ("null_es_word", ALIGNED_SOURCE, "lang IS NULL", "", 0.0, "fatal"), ("null_he_word", ALIGNED_SOURCE, "source IS NULL", "", 0.0, "fatal"), ("null_sense_id", ALIGNED_SOURCE, "quality IS NULL", "", 0.0, "fatal"),
    ("sense_id_below_1", ALIGNED_SOURCE, "quality < 1", "", 0.0, "error"), ("duplicates", ALIGNED_SOURCE, "copies > 1", "", 0.0, "warning"),
    ("match_type", ALIGNED_SOURCE, "toxic = 1", "", 0.0, "warning"), ("confidence", ALIGNED_SOURCE, "toxic = 0 AND n_chars / 1000.0 > 1", "", 0.0, "warning"),
    ("no_hebrew_script", ALIGNED_SOURCE, "NOT regexp_matches(source, '[֐-׿]')", "", 0.05, "warning"), ("missing_ipa", ALIGNED_SOURCE, "lang = 'en'", "", 0.2, "warning"),
]))
def alignment_checks(spark, sf):
    return _checked(quality.alignment_checks(_labelled(spark, sf)))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select(
        F.col("doc_id").alias("row_idx"), F.col("lang").alias("es_word"), F.col("source").alias("he_word"), F.col("quality").alias("sense_id"), F.when(F.col("toxic") == 1, "other").otherwise("fuzzy_88.5").alias("match_type"),
        F.lit("").alias("es_definition"), F.when(F.col("lang") != "en", F.lit("/x/")).alias("he_ipa"), (F.col("n_chars") / 1000.0).alias("confidence"),
    )


EXAMPLE_SOURCE = "(SELECT conv_id, count(*) AS n, bool_or(role = 'system') AS system, max(text) AS word, count(*) OVER (PARTITION BY min(role), max(text), count(*)) AS copies, min(role) AS first FROM conversations GROUP BY conv_id) e"


@query(_check_sql([
    ("null_es_word", EXAMPLE_SOURCE, "first IS NULL", "", 0.0, "fatal"), ("null_he_word", EXAMPLE_SOURCE, "word IS NULL", "", 0.0, "fatal"), ("null_sense_id", EXAMPLE_SOURCE, "n IS NULL", "", 0.0, "fatal"),
    ("sense_id_below_1", EXAMPLE_SOURCE, "n < 1", "", 0.0, "error"), ("duplicates", EXAMPLE_SOURCE, "copies > 1", "", 0.0, "warning"), ("match_type", EXAMPLE_SOURCE, "n > 2", "", 0.0, "warning"),
    ("confidence", EXAMPLE_SOURCE, "n <= 2 AND n / 1.5 > 1", "", 0.0, "warning"), ("no_hebrew_script", EXAMPLE_SOURCE, "NOT regexp_matches(coalesce(word, ''), '[֐-׿]')", "", 0.05, "warning"),
    ("missing_ipa", EXAMPLE_SOURCE, "first IS NULL OR first = 'assistant'", "", 0.2, "warning"), ("broken_examples", EXAMPLE_SOURCE, "system", "", 0.0, "warning"),
]))
def example_checks(spark, sf):
    """All checks, over all conversations: a turn of the system lacks its Spanish side, and conversations of more than two turns have no known match type."""
    turn = F.struct(F.when(F.col("role") != "system", F.coalesce("text", F.lit(""))).alias("es"), F.coalesce("text", F.lit("")).alias("he"))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(turn).alias("examples"), F.min("role").alias("es_word"), F.max("text").alias("he_word"), F.count(F.lit(1)).alias("sense_id")).select(
        "es_word", "he_word", "sense_id", F.when(F.col("sense_id") > 2, "other").otherwise("fuzzy_80").alias("match_type"), F.lit("").alias("es_definition"), F.nullif("es_word", F.lit("assistant")).alias("he_ipa"), "examples", (F.col("sense_id") / 1.5).alias("confidence"),
    )
    return _checked(quality.example_checks(rows))


FAILING = (("duplicates", "copies > 1"), ("sense_id_below_1", "quality < 1"), ("match_type", "toxic = 1"), ("confidence", "toxic = 0 AND n_chars / 1000.0 > 1"), ("no_hebrew_script", "NOT regexp_matches(source, '[֐-׿]')"), ("missing_ipa", "lang = 'en'"))


@query(" UNION ALL ".join(f"(SELECT '{name}' AS check, CAST(row_number() OVER (ORDER BY doc_id) AS INT) AS place, doc_id AS row_idx, lang AS es_word, source AS he_word FROM {ALIGNED_SOURCE} WHERE {bad} ORDER BY doc_id LIMIT 10)" for name, bad in FAILING))
def failing_rows(spark, sf):
    """The first ten rows against each rule of aligned rows; some rules nearly all rows break."""
    rows = quality.with_duplicates(_labelled(spark, sf), "es_word", "he_word", "sense_id")
    return quality.failing_rows(rows, quality.alignment_rules(rows), "es_word", "he_word")


@query("""
WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT c AS check, 0 AS bad, count(DISTINCT o_custkey) AS total FROM j, (SELECT unnest(['missing_id_or_entry', 'missing_word', 'language', 'no_senses', 'missing_sense_id', 'missing_hebrew']) AS c) GROUP BY c
UNION ALL SELECT 'senses_without_ipa', count(*) FILTER (l_linestatus != 'F'), count(*) FROM j""")
def document_checks(spark, sf):
    return quality.document_checks(_documents(spark, sf)).select("check", "bad", "total")


def _report(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select(F.col("source").alias("es_word"), F.md5(F.col("text").cast("binary")).alias("he_word"), F.lit(1).alias("sense_id"), F.when(F.col("quality") == 1, "direct").otherwise("x").alias("match_type"), F.when(F.col("lang") == "en", "long").alias("he_ipa"))


@query("""
WITH d AS (SELECT source, md5(text) AS h, quality, lang FROM documents JOIN labels USING (doc_id)),
b AS (SELECT count(*) AS n, CAST(count(*) FILTER (quality = 1) AS DOUBLE) / count(*) AS direct_rate, CAST(count(*) FILTER (lang = 'en') AS DOUBLE) / count(*) AS cov FROM d),
w AS (SELECT count(*) FILTER (n > 1) AS poly, max(n) AS m, avg(n) AS a FROM (SELECT count(*) AS n FROM d GROUP BY source)),
c AS (SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS dup FROM (SELECT count(*) AS n FROM d GROUP BY source, h)),
s AS (SELECT *, CAST(100 AS DOUBLE) - CAST(30 AS DOUBLE) * (CAST(1 AS DOUBLE) - cov) - CASE WHEN dup > 0 THEN least(CAST(50 AS DOUBLE) * (CAST(dup AS DOUBLE) / n), CAST(20 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS raw FROM b, w, c)
SELECT n AS total_entries, direct_rate, cov AS ipa_coverage, poly AS polysemic_words, m AS max_senses, a AS avg_senses, dup AS duplicates, greatest(CAST(0 AS DOUBLE), raw) AS overall_quality_score,
  CASE WHEN raw >= 90 THEN 'EXCELLENT' WHEN raw >= 75 THEN 'GOOD' WHEN raw >= 60 THEN 'ACCEPTABLE' ELSE 'NEEDS_IMPROVEMENT' END AS verdict,
  array_to_string(list_filter([CASE WHEN direct_rate < 0.5 THEN 'low direct match rate' END, CASE WHEN cov < 0.8 THEN 'low IPA coverage' END, CASE WHEN dup > 0 THEN 'duplicate alignments' END], lambda x: x IS NOT NULL), ';') AS issues FROM s""")
def quality_report(spark, sf):
    return quality.quality_report(_report(spark, sf)).withColumn("issues", F.array_join("issues", ";"))


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column, count(*) FILTER (v IS NULL OR v = '') AS missing, CAST(count(*) FILTER (v IS NULL OR v = '') AS DOUBLE) / count(*) AS rate,
  CASE WHEN CAST(count(*) FILTER (v IS NULL OR v = '') AS DOUBLE) / count(*) < 0.05 THEN '✓' WHEN CAST(count(*) FILTER (v IS NULL OR v = '') AS DOUBLE) / count(*) < 0.2 THEN '⚠' ELSE '✗' END AS band
FROM (SELECT CAST({c} AS VARCHAR) AS v FROM documents LEFT JOIN labels USING (doc_id))""" for c in ("text", "lang", "source", "quality")))
def quality_bands(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return quality.completeness(docs, "text", "lang", "source", "quality")


@query("SELECT doc_id, regexp_matches(text, '[֐-׿]') AS hebrew, regexp_matches(text, '[à-ÿ]') AS accented FROM documents")
def script_containment(spark, sf):
    return table(spark, sf, "documents").select("doc_id", quality.has_script(F.col("text")).alias("hebrew"), quality.has_script(F.col("text"), "[à-ÿ]").alias("accented"))


# Monitoring


@query("""
WITH q AS (SELECT source, avg(quality) * 100 AS score, avg(quality) AS rate, count(*) AS n, count(*) FILTER (toxic = 1) AS bad FROM documents JOIN labels USING (doc_id) GROUP BY source),
a AS (
  SELECT source, CASE WHEN score < 60 THEN 'data_quality_critical' WHEN score < 75 THEN 'data_quality_degraded' END AS alert, CASE WHEN score < 60 THEN 'critical' ELSE 'warning' END AS severity FROM q
  UNION ALL SELECT source, CASE WHEN rate < 0.5 THEN 'ipa_coverage_critical' WHEN rate < 0.8 THEN 'ipa_coverage_low' END, CASE WHEN rate < 0.5 THEN 'critical' ELSE 'warning' END FROM q
  UNION ALL SELECT source, CASE WHEN bad > 0 AND CAST(bad AS DOUBLE) / n > 0.05 THEN 'high_duplicate_rate' WHEN bad > 0 THEN 'duplicates_found' END, CASE WHEN CAST(bad AS DOUBLE) / n > 0.05 THEN 'error' ELSE 'warning' END FROM q
  UNION ALL SELECT source, CASE WHEN n * 100 > 1800 THEN 'slow_pipeline_execution' END, 'warning' FROM q
)
SELECT source, alert, severity, severity IN ('error', 'critical') AS serious FROM a WHERE alert IS NOT NULL""")
def alerts_fired(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    per = docs.groupBy("source").agg(F.avg("quality").alias("rate"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") == 1).alias("bad"))
    c = F.col
    out = monitor.fired(per, monitor.quality_alert(c("rate") * 100), monitor.coverage_alert(c("rate")), monitor.duplicate_alert(c("bad"), c("n")), monitor.duration_alert(c("n") * 100))
    return out.select("source", "alert", "severity", monitor.severity_at_least(c("severity"), "error").alias("serious"))


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select(F.col("event_id").alias("seq"), F.col("event_type").alias("name"), "value", "ts", F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"))


@query("""SELECT event_type AS name, '{"user":"' || CAST(user_id AS VARCHAR) || '"}' AS label_key, arg_max(value, event_id) AS value FROM events GROUP BY event_type, user_id""")
def metrics_latest(spark, sf):
    return monitor.latest(_samples(spark, sf)).select("name", "label_key", "value")


@query("""SELECT event_type AS name, CAST(user_id AS VARCHAR) AS user_id, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY event_type, user_id""")
def metrics_counter(spark, sf):
    return monitor.counters(_samples(spark, sf).withColumn("user_id", F.col("labels")["user"]), "name", "user_id")


@query("""SELECT event_type AS name, event_type || '{user="' || CAST(user_id AS VARCHAR) || '"}' AS head, arg_max(value, event_id) AS value FROM events GROUP BY event_type, user_id""")
def metrics_exposition(spark, sf):
    """Name, labels and value of each line, read back from its text."""
    return monitor.prometheus_lines(_samples(spark, sf)).select("name", F.substring_index("line", " ", 1).alias("head"), F.substring_index("line", " ", -1).cast("double").alias("value"))


@query("""
WITH l AS (SELECT user_id, max(ts) AS last FROM events GROUP BY user_id), n AS (SELECT max(ts) AS now FROM events)
SELECT user_id, CAST(floor(epoch(now)) - floor(epoch(last)) AS DOUBLE) / 3600 AS age_hours, (floor(epoch(now)) - floor(epoch(last))) / 3600 > 24 AS stale FROM l, n""")
def staleness(spark, sf):
    events = table(spark, sf, "events")
    now = events.agg(F.max("ts").alias("now"))  # one row
    last = events.groupBy("user_id").agg(F.max("ts").alias("last")).crossJoin(now)
    return last.select("user_id", monitor.age_hours(F.col("last"), F.col("now")).alias("age_hours"), monitor.stale(F.col("last"), F.col("now"), 24).alias("stale"))


@query("""
SELECT * FROM (SELECT p_partkey, p_retailprice, 'best' AS side FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
UNION ALL SELECT * FROM (SELECT p_partkey, p_retailprice, 'worst' AS side FROM part ORDER BY p_retailprice, p_partkey LIMIT 10)""")
def best_worst(spark, sf):
    return stats.best_and_worst(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey")


@query("""
WITH n AS (SELECT DISTINCT p_name FROM part), p AS (
  SELECT CAST(len(list_filter(string_split(a.p_name, ''), lambda c: contains(b.p_name, c))) AS DOUBLE) / greatest(length(a.p_name), length(b.p_name)) AS s FROM n a, n b)
SELECT count(*) AS pairs, round(avg(s), 9) AS mean, count(*) FILTER (s = 1) AS exact, count(*) FILTER (s >= 0.7) AS high, count(*) FILTER (s < 0.3) AS low FROM p""")
def similarity_summary(spark, sf):
    """Over every name of a part beside every name."""
    scored = _name_pairs(spark, sf).select(text.overlap(F.col("x"), F.col("y")).alias("similarity"))
    return stats.similarity_summary(scored).withColumn("mean", F.round("mean", 9))


@query("""SELECT count(*) AS words, count(*) FILTER (m > 1) AS clustered_words FROM (SELECT p_name, max(l) AS m FROM (SELECT p_name, dense_rank() OVER (PARTITION BY p_name ORDER BY p_size) AS l FROM part) GROUP BY p_name)""")
def clustered_words(spark, sf):
    ranked = table(spark, sf, "part").withColumn("semantic_cluster", F.dense_rank().over(W.partitionBy("p_name").orderBy("p_size")))
    return stats.clustered_words(ranked, "p_name")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The cascade over brands and part names, structured into documents."""
    rows = _cascade(spark, sf).withColumn("examples", F.expr("cast(array() as array<struct<es:string,he:string>>)"))
    return senses.structure(senses.cluster_senses(rows)).select("id", F.size("entry.senses").alias("n_senses"), F.to_json("entry").alias("entry"))
