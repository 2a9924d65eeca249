"""Texts longer than one numpy pass takes, through every operator that reads documents and through the stages."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lexforge.llm import decontamination, licenses, repetition, secrets, sharding, token_files
from lexforge.llm.words import SLICE_BYTES

#: 700,000 different words, some 6 MB; one passage of 40 words stands in it twice.
WORDS = [f"w{i:07}" for i in range(700_000)]
WORDS[500_000:500_040] = WORDS[100:140]
LONG = " ".join(WORDS)
SHORT = "a short text about a cat that sat on the mat and a dog that sat on the log"


@pytest.fixture(scope="module")
def long_docs(spark):
    assert len(LONG) > SLICE_BYTES
    rows = [(1, SHORT, "en", "s1", len(SHORT)), (2, LONG, "en", "s1", len(LONG)), (3, SHORT, "en", "s2", len(SHORT))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("key", F.lit("clash")).withColumn("tokens", F.lit("clash"))


def test_repetition(long_docs):
    r = repetition.repetition(long_docs).where("doc_id = 2").first()
    assert (r.n_words, r.n_repeat_words, r.kept) == (700_000, 80, True)


def test_secrets_and_licenses(spark, long_docs):
    key = "Zk8vQ2nRt5Lw9XyB3mCd7"
    rows = long_docs.withColumn("text", F.concat("text", F.lit(f" {key} token=abcdefgh1")))
    r = secrets.secret_digest(rows).where("doc_id = 2").first()
    assert (r.n_assign, r.n_entropy) == (1, 1)
    got = {r.doc_id: r for r in licenses.scan_licenses(rows.withColumn("text", F.concat("text", F.lit("\nReleased under the MIT License.")))).collect()}
    assert got[2].notices == ["MIT"] and got[1].notices == ["MIT"]


def test_decontamination(spark, long_docs):
    item = " ".join(WORDS[499_990:500_010])
    got = {r.doc_id: r for r in decontamination.decontaminate(long_docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    # The second half of the item stands in the passage's first copy as well.
    assert (got[2].n_words, got[2].n_hit, got[2]["items"]) == (700_000, 30, ["7"]) and not got[1].contaminated


def test_sharding(long_docs):
    got = {r.doc_id: r for r in sharding.shard_documents(long_docs, shards=3).collect()}
    assert got[1].shard == got[3].shard != got[2].shard and got[2].size == len(LONG) + 16 and got[2].text_crc32 == zlib.crc32(LONG.encode())


def test_tokens(long_docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    ids = [*tokenizers.Tokenizer.from_file(path).encode(LONG, add_special_tokens=False).ids, 2]
    r = token_files.tokens_roundtrip(long_docs, path).where("doc_id = 2").first()
    assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_stages(spark, long_docs, tmp_path):
    C = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([(1, "nothing like it at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = LONG.replace(WORDS[350_000], "another")
    copy = long_docs.where("doc_id = 2").withColumn("doc_id", F.lit(4).cast("long")).withColumn("text", F.lit(near))
    more = spark.range(10, 30).select(F.col("id").alias("doc_id"), F.lit(SHORT).alias("text"), F.lit("en").alias("lang"), F.lit("s1").alias("source"), F.lit(0).cast("long").alias("n_chars"), F.lit("").alias("key"), F.lit("").alias("tokens"))
    docs = long_docs.union(copy).union(more)  # enough of the short one to be learned
    kept = []
    for _, stage in C.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        kept.append(sorted({(r.doc_id, hashlib.md5(r.text.encode()).hexdigest()) for r in docs.collect()}))
    whole = hashlib.md5(LONG.encode()).hexdigest()
    assert {i for i, _ in kept[0]} == {1, 2, 3, 4, *range(10, 30)} and [i for i, _ in kept[1]] == [1, 2] and (2, whole) in kept[2] and {i for i, _ in kept[3]} <= {1, 2}
