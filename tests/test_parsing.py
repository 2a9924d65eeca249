import gzip
import json

import pytest
from pyspark.sql import functions as F

from lexforge.functions import text
from lexforge.operators import clean, parse
from lexforge.sources import readers, writers
from lexforge.sources.catalog import Catalog, Dataset

LINES = [
    json.dumps({"word": "casa", "pos": "noun", "lang_code": "es", "sounds": [{"audio": "x"}, {"ipa": None}, {"ipa": "k"}], "senses": [{"glosses": []}, {"glosses": ["a", "b"]}, {}],
                "translations": [{"lang_code": "he", "word": "ב"}, {"lang_code": "he", "word": "א"}, {"lang_code": "he", "word": "ב"}, {"lang_code": "en", "word": ""}, {"code": "he", "word": "ג"}]}),
    "", "   ", "{not json", '[{"word": "list"}]',
    json.dumps({"word": "sol", "lang_code": "es", "sounds": [{"ipa": "sol"}]}),
    json.dumps({"word": "", "lang_code": "es"}), json.dumps({"word": "בית", "lang_code": "he", "pos": "noun", "translations": [{"lang_code": "es", "word": "casa"}]}),
    json.dumps({"word": "Haus", "lang_code": "de"}),
]


@pytest.mark.parametrize("packed", [False, True])
def test_json_lines(spark, tmp_path, packed):
    path = str(tmp_path / ("x.jsonl" + ".gz" * packed))
    with (gzip.open if packed else open)(path, "wt", encoding="utf-8") as out:
        out.write("\n".join(LINES))
    raw = readers.read_json_lines(spark, path)
    assert [r.word for r in raw.orderBy("row_idx").collect()] == ["casa", "sol", "", "בית", "Haus"]
    assert readers.malformed_lines(spark.read.text(path)).count() == 2
    es = {r.word: r for r in parse.spanish_entries(raw).collect()}
    assert set(es) == {"casa", "sol"}
    assert es["casa"].ipa is None and es["casa"].definitions == ["a"] and es["casa"].translations_he == ["ב", "א"] and es["casa"].translations_en == []
    assert es["sol"].ipa == "sol" and es["sol"].definitions == ["sol"] and es["sol"].pos == "unknown"
    assert [r.translations_es for r in parse.hebrew_entries(raw).collect()] == [["casa"]]
    assert {r.word: r.translations_he for r in parse.bridge_entries(raw, "code").collect()} == {"casa": ["ג"], "בית": []}
    assert {r.word for r in readers.read_translated(spark, path).collect()} == {"casa", "בית"}


def test_row_numbers_follow_the_files(spark, tmp_path):
    for name, n in (("b", 400), ("a", 300)):
        (tmp_path / f"{name}.txt").write_text("\n".join(f"{name}{i}" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        out = readers.with_row_idx(spark.read.text(str(tmp_path))).orderBy("row_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in out] == [f"a{i}" for i in range(300)] + [f"b{i}" for i in range(400)]
    assert [r.row_idx for r in out] == list(range(700))


def test_sentences_and_missing_files(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("1\tes\tHola\n2\the\tשלום\n")
    assert [(r.row_idx, r.id, r.lang, r.text) for r in readers.read_sentences(spark, str(tmp_path / "s.tsv")).orderBy("row_idx").collect()] == [(0, "1", "es", "Hola"), (1, "2", "he", "שלום")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_json_lines(spark, str(tmp_path / "none"))


def test_download(tmp_path):
    calls, path = [], str(tmp_path / "d" / "es.jsonl")

    def opener(url):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("down")
        return b"{}"

    assert readers.download("es", path, opener, "http://x", sleep=lambda s: None) == path and len(calls) == 3 and calls[0].endswith("Spanish.jsonl")
    readers.download("es", path, opener, "http://x")
    assert len(calls) == 3
    with pytest.raises(ValueError):
        readers.download("xx", path, opener, "http://x")
    with pytest.raises(OSError):
        readers.download("he", str(tmp_path / "he"), lambda u: (_ for _ in ()).throw(OSError()), "http://x", sleep=lambda s: None)


def test_catalog_and_sinks(spark, tmp_path):
    c = Catalog(spark, {"p": Dataset("parquet", str(tmp_path / "p")), "j": Dataset("json", str(tmp_path / "j"), "a long, b string"), "t": Dataset("text", str(tmp_path / "t"))})
    df = spark.createDataFrame([(1, "é"), (2, None)], "a long, b string")
    c.save("p", df), c.save("j", df), c.save("m", df), c.save("t", "x")
    assert c.load("p").count() == 2 and c.load("m") is df and (tmp_path / "t").read_text() == "x"
    assert '"b":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("part*")) and "é" in writers.as_json(df)
    with pytest.raises(KeyError):
        c.load("nothing")
    writers.write_lookup(spark.createDataFrame([("b", "1"), ("a", "2")], "word string, ipa string"), str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 2


def test_proper_nouns(spark):
    data = [("casa", "noun"), ("Casa", "noun"), ("USA", "noun"), ("perro", "Name"), ("gato", None), ("", "noun"), ("Élan", None), ("בית", "propn"), (None, "noun")]
    out = clean.filter_proper_nouns(spark.createDataFrame(data, "word string, pos string"))
    assert [r.word for r in out.collect()] == ["casa", "USA", "gato", "", None]


def test_bridges(spark):
    b = lambda *rows: spark.createDataFrame(list(rows), "row_idx long, source_lang string, word string, pos string, x string")
    out = clean.combine_bridges(english=b((5, "es", "a", "n", "e5"), (2, "es", "a", "n", "e2"), (3, "es", "a", None, "e3")), french=b((0, "es", "a", "n", "f"), (1, "he", "a", "n", "g"), (2, "es", "a", None, "h")))
    assert sorted((r.x, r.bridge_source) for r in out.collect()) == [("e2", "english"), ("e3", "english"), ("g", "french")]
    assert [r.x for r in out.orderBy("row_idx").collect()] == ["e2", "e3", "g"]


def test_scores_and_ranks(spark):
    data = [("casa", ["1"], ["1", "2"]), ("ab", [], None), ("muylargapalabra", ["1"], ["1", "2"]), ("cosa", ["9"], ["8", "7"])]
    out = {r.word: r for r in clean.add_frequency_ranks(spark.createDataFrame(data, "word string, translations_he array<string>, definitions array<string>")).collect()}
    assert out["casa"].frequency_score == pytest.approx(0.4 + 0.6 + 0.3 * 0.6) and out["ab"].frequency_score == pytest.approx(0.3 * 0.8)
    assert [out[w].frequency_rank for w in ("casa", "cosa", "muylargapalabra", "ab")] == [1, 1, 2, 3]


def test_tokens(spark):
    frame = spark.createDataFrame([("  La  casa, (es) GRANDE... ¿Qué? ;;; no\x1cbien",), (None,), ("",)], "t string")
    es = [r[0] for r in frame.select(text.tokenize_spanish(F.col("t"))).collect()]
    assert es == [["casa", "es", "grande", "¿qué", "", "bien"], [], []]
    assert frame.select(text.tokenize_hebrew(F.col("t"))).first()[0] == ["La", "casa", "es", "GRANDE", "¿Qué", "", "no", "bien"]
    picks = spark.createDataFrame([(["a", "b"], 1), (["a"], 4), ([], 0), (None, 0)], "d array<string>, i int")
    assert [r[0] for r in picks.select(text.pick(F.col("d"), F.col("i"))).collect()] == ["b", "a", "", ""]


def test_white_space_at_the_ends_makes_no_token(spark):
    frame = spark.createDataFrame([(t,) for t in ["", " ", None, "\x1c ab abc,\u3000", "\n\u2028ABC\x85 (", "...", "\u00a0x"]], "t string")
    got = frame.select(text.tokenize_spanish(F.col("t")), text.tokenize_hebrew(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [([], []), ([], []), ([], []), (["abc"], ["ab", "abc"]), (["abc"], ["ABC"]), ([""], [""]), ([], [])]
