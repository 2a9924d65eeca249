import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexforge.functions import similarity
from lexforge.operators import align, examples, senses
from lexforge.schemas import DICTIONARY
from lexforge.sources import readers, writers
from tests.helpers import BRIDGE, ES, HE, hebrew, one, spanish


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("ord").select(*columns).collect()]


def test_direct(spark):
    out = align.align(spanish(spark), hebrew(spark))
    assert rows(out, "es_word", "he_word", "sense_id", "match_type", "es_definition") == [
        ("casa", "בית", 1, "direct", "Edificio para habitar"), ("banco", "ספסל", 1, "direct", "Asiento largo"),
        ("banco", "בנק", 2, "direct", "Institución financiera"), ("gato", "חתול", 1, "direct", "Animal felino doméstico"),
    ]


def test_homographs_use_the_first_row_and_gaps_stay(spark):
    he = spark.createDataFrame([(5, "ב", "late", ["z"], []), (1, "ב", "early", ["a"], [])], HE)
    out = align.align_direct(one(spark, "x", ["א", "ב"], []), he)
    assert rows(out, "he_ipa", "he_definition", "sense_id", "es_definition") == [("early", "a", 2, "")]


def test_bridge_takes_the_first_hit_once(spark):
    bridge = spark.createDataFrame([
        (3, "es", "libro", "", "", [], [], ["ספר"]), (1, "es", "libro", "", "", [], [], ["אין", "מגילה", "ספר"]), (0, "he", "libro", "", "", [], [], ["ספר"]),
    ], BRIDGE)
    he = spark.createDataFrame([(0, "ספר", "/s/", ["Libro"], []), (1, "מגילה", "/m/", ["Rollo"], [])], HE)
    es = one(spark, "libro", [], ["Obra"]).union(one(spark, "libro", [], ["Otra"], row_idx=1))
    out = align.align(es, he, bridge)
    assert rows(out, "es_word", "he_word", "match_type", "sense_id", "es_definition", "confidence") == [("libro", "מגילה", "triangulation", 1, "Obra", None)]


def test_words_with_a_direct_link_are_not_aligned_again(spark):
    bridge = spark.createDataFrame([(0, "es", "casa", "", "", [], [], ["חתול"])], BRIDGE)
    out = align.align(spanish(spark), hebrew(spark), bridge)
    assert {r.match_type for r in out.collect()} == {"direct"}


def test_fuzzy(spark):
    he = spark.createDataFrame([
        (0, "א", "/a/", ["Animal felino doméstico"], []), (1, "ב", "/b/", ["Animal felino domestico"], []), (2, "ג", "/c/", ["Animal felino doméstico"], []), (3, "ד", "", [], []),
    ], HE)
    es = one(spark, "gato", [], ["Animal felino doméstico"]).union(one(spark, "x", [], ["Edificio para habitar"], row_idx=1)).union(one(spark, "y", [], [], row_idx=2))
    out = rows(align.align(es, he), "es_word", "he_word", "match_type", "confidence")
    assert out == [("gato", "ג", "fuzzy_100.0", 1.0)]  # the last row of the first best text


def test_fuzzy_ties_go_to_the_first_text(spark):
    he = spark.createDataFrame([(7, "b", "", ["abcdefghiy"], []), (3, "a", "", ["abcdefghix"], [])], HE)
    out = rows(align.align_fuzzy(one(spark, "w", [], ["abcdefghi"]), he), "he_word", "match_type")
    assert out == [("a", "fuzzy_94.73684210526316")]


@pytest.mark.parametrize("a,b,want", [
    ("Animal doméstico canino", "Animal doméstico de la familia canina", 73.33), ("Edificio para habitar", "Casa, edificio residencial", 46.81),
    ("Asiento largo para varias personas", "Asiento alargado", 56.0), ("", "", 100.0), ("a", "", 0.0),
])
def test_ratio(a, b, want):
    assert round(similarity.ratio(a, b), 2) == want


def test_two_forms_of_the_ratio_agree(spark):
    rnd = random.Random(1)
    pairs = [("".join(rnd.choices("abcé ", k=rnd.randrange(12))), "".join(rnd.choices("abcé ", k=rnd.randrange(12)))) for _ in range(120)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for r in frame.select("a", "b", similarity.ratio_sql(F.col("a"), F.col("b")).alias("s")).collect():
        assert r.s == pytest.approx(similarity.ratio(r.a, r.b))


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def some_texts(rnd, alphabet, count, most):
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(most))) for _ in range(count)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh ", "אבגד ", "a😀é\ud7ff\ud83d"])
def test_side_by_side_comparison_equals_the_plain_table(alphabet):
    """Also over several lanes and their carries, at the edges of a lane, and for texts too long for the lanes."""
    rnd = random.Random(len(alphabet))
    a = some_texts(rnd, alphabet, 25, 150) + ["", alphabet[0] * 64, alphabet[0] * 63 + alphabet[1], alphabet[0] * 65, alphabet[0] * 200, alphabet[0] * 520, (alphabet[:2] * 300)[:513]]
    b = some_texts(rnd, alphabet, 20, 150) + ["", alphabet[0] * 64, alphabet[0] * 128, alphabet[1] * 70, (alphabet[:2] * 300)[:400]]
    i, j = np.divmod(np.arange(len(a) * len(b)), len(b))
    want = np.array([plain_lcs(a[x], b[y]) for x, y in zip(i, j, strict=True)])
    assert want.tolist() == [similarity.lcs_length(a[x], b[y]) for x, y in zip(i, j, strict=True)]
    one, two = similarity.Block(a), similarity.Block(b)
    assert np.array_equal(similarity.lcs_lengths(one, two, i, j, np.zeros(len(i), np.int64)), want)
    least = np.array([rnd.randrange(1, 100) for _ in i])
    cut = similarity.lcs_lengths(one, two, i, j, least)
    assert np.all((cut == want) | ((cut == -1) & (want < least))) and (cut[want >= least] >= 0).all()
    assert np.all(similarity.most_common(one, two)[i, j] >= want)


def test_pairs_of_texts_of_one_script_equal_all_pairs():
    rnd = random.Random(9)
    words = ["casa", "perro", "grande", "lento", "agua", "el", "la", "de"]
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(3, 14))) for _ in range(150)]
    texts = sorted({t if rnd.random() < 0.5 else t.replace("a", "o", 1) + "s" for t in texts} | {""})
    for cutoff in (60.0, 80.0, 95.0):
        got = {(r["text"], r["match"]): r["score"] for r in similarity.similar_pairs(texts, texts[::2], cutoff).to_pylist()}
        assert got == {(x, y): similarity.ratio(x, y) for x in texts for y in texts[::2] if similarity.ratio(x, y) >= cutoff}


def test_leader_numbers_equal_a_walk():
    rnd = random.Random(12)
    lists = [["".join(rnd.choices("abc", k=rnd.randrange(9))) for _ in range(rnd.randrange(11))] for _ in range(300)]
    got = senses.leader_numbers(np.cumsum([0, *map(len, lists)]), [t for own in lists for t in own], 70.0).tolist()
    want = []
    for own in lists:
        leaders = []
        for t in own:
            at = next((i for i, x in enumerate(leaders) if similarity.ratio(x, t) > 70), len(leaders))
            if at == len(leaders):
                leaders.append(t)
            want.append(at + 1)
    assert got == want and max(want) > 4


def test_length_bands_lose_no_pair(spark):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choices("ab", k=rnd.randrange(30))) for _ in range(60)})
    frame = spark.createDataFrame([(w, w) for w in words], "id string, text string")
    got = {(r.text, r.match) for r in align.similarity_join(frame, frame, 80.0).collect()}
    assert got == {(a, b) for a in words for b in words if similarity.ratio(a, b) >= 80}


def test_order_of_partitions_does_not_matter(spark):
    a, b = spanish(spark), hebrew(spark)
    want = rows(align.align(a, b), "es_word", "he_word", "sense_id")
    assert rows(align.align(a.repartition(3, "word"), b.orderBy(F.desc("row_idx"))), "es_word", "he_word", "sense_id") == want


def test_empty_tables_keep_their_columns(spark):
    none = align.align(spark.createDataFrame([], ES), spark.createDataFrame([], HE), spark.createDataFrame([], BRIDGE))
    assert none.count() == 0 and "confidence" in none.columns


def test_points_match_byte_by_byte(spark):
    he = spark.createDataFrame([(0, "שָׁלוֹם", "", ["Paz"], [])], HE)
    assert align.align_direct(one(spark, "paz", ["שָׁלוֹם"], ["Paz"]), he).count() == 1
    assert align.align_direct(one(spark, "paz", ["שלום"], ["Paz"]), he).count() == 0


SENTENCES = "row_idx long, id string, lang string, text string"


def test_pairs_examples_and_documents(spark):
    sentences = spark.createDataFrame([
        (0, "1", "he", "זה בית גדול"), (1, "2", "es", "La casa es grande."), (2, "3", "es", "Otra casa, casa!"), (3, "4", "fr", "x"), (4, "5", "he", "עוד בית."), (5, "6", "es", "Sin par"),
    ], SENTENCES)
    pairs = examples.tokenized(examples.pair_by_position(sentences))
    assert [(r.es, r.he) for r in pairs.orderBy("row_idx").collect()] == [("La casa es grande.", "זה בית גדול"), ("Otra casa, casa!", "עוד בית.")]
    enriched = examples.enrich(align.align(spanish(spark), hebrew(spark)), pairs)
    found = {r.es_word: [x.es for x in r.examples] for r in enriched.collect()}
    assert found == {"casa": ["La casa es grande.", "Otra casa, casa!"], "banco": [], "gato": []}
    documents = senses.structure(senses.cluster_senses(enriched))
    ids = ["es: banco", "es: casa", "es: gato"]
    assert sorted(r.id for r in documents.collect()) == ids
    entry = documents.where("id = 'es: banco'").first().entry
    assert entry.word == "banco" and entry.language == "es" and entry.etymology is None
    assert [(s.sense_id, s.hebrew, s.definition) for s in entry.senses] == [(1, "ספסל", "Asiento largo"), (2, "בנק", "Institución financiera")]
    counts = senses.document_counts(documents).first()
    assert (counts.entries, counts.senses, counts.senses_with_ipa) == (3, 4, 4)
    lines = [r.line for r in senses.dictionary_lines(documents).orderBy("place").collect()]
    assert [json.loads(x.lstrip(","))["id"] for x in lines] == ids and [x[0] for x in lines] == ["{", ",", ","]


def test_the_written_dictionary_is_one_json_document(spark, tmp_path):
    """Put together in the order of names; the manifest says where each file begins; null fields and equal ids stay."""
    sense = lambda i: (i, f"d{i}", None, "ספר", "noun", [("x, y", "א\n\"")])
    docs = [(f"es: {w}", (w, "", "es", None, [sense(k) for k in range(i % 3)])) for i, w in enumerate(["b", "a", "ñ", "c", "a", *(f"w{i}" for i in range(40))])]
    frame = spark.createDataFrame(docs, DICTIONARY).repartition(5)
    manifest = writers.write_dictionary(frame, f"file://{tmp_path}/out", "2024-05-06").collect()
    whole = b"".join((tmp_path / "out" / r.file).read_bytes() for r in manifest)
    for r in manifest:
        assert whole[r.start : r.start + r.bytes] == (tmp_path / "out" / r.file).read_bytes()
    assert len(manifest) > 4 and [r.file for r in manifest] == sorted(r.file for r in manifest)
    read = json.loads(whole)
    assert read["metadata"]["generated_at"] == "2024-05-06" and [e["id"] for e in read["entries"]] == sorted(i for i, _ in docs)
    assert all(e["entry"]["etymology"] is None and "etymology" in e["entry"] for e in read["entries"])
    head, back = readers.read_dictionary(spark, f"file://{tmp_path}/out")
    assert head.first().version == "1.0" and sorted((r.id, r.entry) for r in back.drop("place").collect()) == sorted((r.id, r.entry) for r in frame.collect())
    assert [r.place for r in back.orderBy("id").collect()] == list(range(len(docs)))
    writers.write_dictionary(frame.limit(0), f"file://{tmp_path}/none")
    assert readers.read_dictionary(spark, f"file://{tmp_path}/none")[1].count() == 0


def test_pairs_by_links(spark):
    sentences = spark.createDataFrame([(0, "1", "es", "a"), (1, "2", "he", "b")], SENTENCES)
    links = spark.createDataFrame([("1", "2"), ("1", "9")], "left_id string, right_id string")
    assert [(r.es, r.he) for r in examples.pair_by_links(sentences, links).collect()] == [("a", "b")]


def test_clusters_follow_leaders(spark):
    texts = {"banco": ["Asiento largo para varias personas", "Asiento alargado", "Asiento largo para varias persona", None, ""], "casa": ["x"], "mucho": ["same"] * 11}
    data = [(w, i, t) for w, ts in texts.items() for i, t in enumerate(ts)]
    out = senses.cluster_senses(spark.createDataFrame(data, "es_word string, ord long, es_definition string"))
    got = {w: [r.semantic_cluster for r in sorted(out.where(F.col("es_word") == w).collect(), key=lambda r: r.ord)] for w in texts}
    assert got == {"banco": [1, 2, 1, 3, 3], "casa": [1], "mucho": [1] * 11}


def test_fuzzy_apart_from_its_own_row(spark):
    """One table on both sides: every row may match any other, also one of the same text, but not itself."""
    rows = [(i, w, "", "noun", [t], [], [], 1) for i, (w, t) in enumerate([("a", "NATION_0"), ("b", "NATION_1"), ("c", "same text"), ("d", "same text"), ("e", "quite alone")])]
    es = spark.createDataFrame(rows, ES)
    got = {r.es_word: (r.he_word, r.match_type) for r in align.align_fuzzy(es, es, apart=True).collect()}
    assert got == {"a": ("b", "fuzzy_87.5"), "b": ("a", "fuzzy_87.5"), "c": ("d", "fuzzy_100.0"), "d": ("c", "fuzzy_100.0")}
