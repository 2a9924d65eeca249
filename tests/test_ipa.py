import pytest
from pyspark.sql import functions as F

from lexforge.functions import ipa, text


def lookup(spark, **words):
    return spark.createDataFrame([(k, v) for k, v in words.items()] or [("", "")], "word string, ipa string").where("word != ''")


def read(spark, words, table=None, **options):
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    return {r.word: r.ipa for r in ipa.transliterate(frame, table if table is not None else lookup(spark), **options).collect()}


@pytest.mark.parametrize("word,want", [
    ("א", "ʔ"), ("ח", "χ"), ("ך", "χ"), ("ף", "f"), ("ץ", "ts"), ("בּ", "b"), ("שׂ", "s"), ("דו", "dv"), ("שוב", "ʃob"), ("רוֹב", "ʁvob"), ("ויי", "vjj"), ("הו", "hv"), ("וו", "vv"), ("ווא", "voʔ"), ("ב" * 50, "b" * 50),
    ("כּו", "kv"), ("כּוב", "kvb"), ("hello", None),
])
def test_rules(spark, word, want):
    got = spark.createDataFrame([(word,)], "w string").select(ipa.rules(F.col("w"))).first()[0]
    assert got == want


def test_variants(spark):
    assert read(spark, ["רחע"], variant="sephardic") == {"רחע": "/rħʕ/"}
    assert read(spark, ["רחע"], variant="yiddish") == read(spark, ["רחע"]) == {"רחע": "/ʁχʔ/"}


def test_chain_and_phrases(spark):
    table = lookup(spark, **{"בית": "bajit", "בית ספר": "whole"})
    got = read(spark, ["בית", " בית ", "בית ספר", "ספר בית", "בית-ספר", "בית xyz", "", None, "-"], table)
    assert got == {"בית": "/bajit/", " בית ": "/bajit/", "בית ספר": "/whole/", "ספר בית": "/spʁ bajit/", "בית-ספר": "/bajit-spʁ/", "בית xyz": None, "-": None}
    assert read(spark, ["ספר"], table, fallback_to_rules=False) == {"ספר": None}
    assert read(spark, ["ספר"], table, external=lambda w: F.lit("ext")) == {"ספר": "/ext/"}


DOC = "id string, entry struct<word:string,ipa:string,language:string,etymology:string,senses:array<struct<sense_id:int,definition:string,ipa_hebrew:string,hebrew:string,pos:string,examples:array<struct<es:string,he:string>>>>>"


def test_documents(spark):
    sense = lambda i, sound, word: (i, "d", sound, word, "noun", [])
    docs = spark.createDataFrame([("es: a", ("a", "", "es", None, [sense(1, "", "ספר"), sense(2, "/se.fer/", "ספר"), sense(3, "None", ""), sense(4, None, "בית")])), ("es: b", ("b", "", "es", None, []))], DOC)
    out = {r.id: r for r in ipa.fill_documents(docs, lookup(spark)).collect()}
    assert [s.ipa_hebrew for s in out["es: a"].entry.senses] == ["/spʁ/", "/se.fer/", "None", "/bjt/"]
    assert (out["es: a"].ipa_total, out["es: a"].ipa_generated, out["es: a"].ipa_skipped, out["es: a"].ipa_failed) == (4, 2, 1, 1)
    assert out["es: b"].ipa_total == 0 and out["es: b"].entry.senses == []
    again = {r.id: r for r in ipa.fill_documents(docs, lookup(spark), skip_existing=False).collect()}
    assert again["es: a"].entry.senses[1].ipa_hebrew == "/spʁ/"


def test_lookup_table(spark):
    data = [(0, "a", "/x/"), (2, "a", "[y] ~ z"), (1, "a", "/w/"), (3, "b", "(h)"), (4, "", "/q/"), (5, "c", None)]
    got = {r.word: r.ipa for r in ipa.build_lookup(spark.createDataFrame(data, "row_idx long, word string, ipa string")).collect()}
    assert got == {"a": "y"}


def test_comparison(spark):
    known = spark.createDataFrame([("ספר", "[spʁ]"), ("בית", "/ba.jit/"), ("hello", "/x/")], "word string, ipa string")
    got = {r.word: r for r in ipa.compare_known(known, lookup(spark)).collect()}
    assert got["ספר"].exact_match and got["ספר"].similarity == 1.0 and got["ספר"].method == "rules"
    assert got["בית"].similarity == pytest.approx(3 / 6) and got["hello"].similarity == 0.0 and got["hello"].method is None


def test_cleaning(spark):
    frame = spark.createDataFrame([("/ħɔː(h)/ [alt]",), ("/a b/ ~ /c/",), ("(ʔ)",), (None,), ("a   b",)], "x string")
    assert [r[0] for r in frame.select(text.clean_ipa(F.col("x"))).collect()] == ["ħɔː", "a b", None, None, "a b"]
    pair = spark.createDataFrame([("abc", "bcd"), ("", "a")], "a string, b string")
    assert [r[0] for r in pair.select(text.overlap(F.col("a"), F.col("b"))).collect()] == [pytest.approx(2 / 3), 0.0]
    assert pair.select(text.missing_characters(F.col("b"), F.col("a"))).first()[0] == ["d"]


def test_documents_are_made_once_and_filled_from_what_was_written(spark, tmp_path):
    from lexforge.functions.ipa import fill_documents

    ddl = "id string, entry struct<word:string,senses:array<struct<hebrew:string,ipa_hebrew:string>>>"
    spark.createDataFrame([("a", ("a", [("אב", "None"), ("גד", "/x/")]))], ddl).write.parquet(f"{tmp_path}/d")
    filled = fill_documents(spark.read.parquet(f"{tmp_path}/d"), spark.createDataFrame([("אב", "av")], "word string, ipa string"))
    assert not any(str(tmp_path) in f for f in filled.inputFiles())
    assert [s.ipa_hebrew for s in filled.first().entry.senses] == ["/av/", "/x/"]
