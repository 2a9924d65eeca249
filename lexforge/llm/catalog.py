"""The queries of the training-data operators, `opN_<name>`, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import chat, decontamination, jaccard_join, language_id, licenses, mixing, periodic_runs, repetition, secrets, sharding, token_files, url_filter, whitening
from lexforge.llm.catalog_values import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, URL_PATTERNS, URL_RULES
from lexforge.llm.oracles import oracle_sql  # noqa: F401
from lexforge.llm.shared import table


def op1_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    body = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", body), (-7, 1, "assistant", body)], rows.schema)
    return chat.chat_digest(chat.threads(rows.union(probe)))


def reply_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best branches of each tree of documents: a document answers the one of half its number, if that has its language, and is scored by its length."""
    docs = table(spark, sf_dir, "documents")
    half = F.floor(F.col("doc_id") / 2).alias("parent")
    messages = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("node"), half, F.col("source").alias("role"), F.col("doc_id").cast("string").alias("text"), (F.col("n_chars") % 7).cast("double").alias("score"))
    paths = chat.branches(messages, best=3).groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct("step", "text"))).alias("x"))
    return paths.select("tree", "leaf", "rank", F.size("x").cast("long").alias("n_messages"), F.array_join(F.transform("x", lambda m: m["text"]), ">").alias("path"))


def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op4_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, slop=1)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "n_near",
    )


def op6_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op7_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "license", "n_notices", F.array_join("notices", ",").alias("notices"))


def op8_adaptive_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(table(spark, sf_dir, "documents"), words=4, percent=85)


def mix_levels() -> dict:
    """Domain, language, source; a domain is a third of the numbered sources."""
    number = F.coalesce(F.expr("try_cast(regexp_extract(source, '[0-9]+$', 0) as bigint)"), F.lit(0))
    return {"domain": F.concat(F.lit("d"), (number % 3).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def op10_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mixing.draw(docs, mix_levels(), MIX_WEIGHTS, share=MIX_SHARE, epochs=MIX_EPOCHS, seed=MIX_SEED).select("doc_id", "source", "lang", "n_tokens", "copies")


def public_tokenizer(name: str) -> str:
    """Where the public tokenizer files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokens_roundtrip(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"), eos=2)


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    index = url_filter.build_index(url_filter.rules_of(spark, URL_RULES, URL_PATTERNS), pages)
    return url_filter.judge(pages, index).select("page_id", "host", "path", "rule", "verdict", "pattern")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows, components=4))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", periodic_runs.plant_period(F.col("text"), F.col("doc_id")).alias("text"))
    return periodic_runs.periodic_runs(docs, keep_text=False).drop("collapsed")


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_ppm_language_id, op2_reply_trees, op3_repetition_rules, op4_entropy_secrets, op5_benchmark_decontamination, op6_lpt_sharding, op7_license_digests, op8_adaptive_jaccard_join,
        op9_token_files, op10_hierarchical_mix, op11_url_filter, op12_embedding_whitening, op13_periodic_runs, reply_branches,
    )}
