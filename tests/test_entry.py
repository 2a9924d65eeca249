import duckdb
import pytest

import __spark_entry__ as E
from lexforge.functions.similarity import ratio
from lexforge.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if x is None or x != x:
        return "null"
    return repr(round(float(x), 9)) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_the_sql(spark, sf, name):
    got = QUERIES[name](spark, sf)
    if name not in ORACLES:
        assert got.count() >= 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert sorted(tuple(map(cell, r)) for r in got.select(*columns).collect()) == sorted(tuple(map(cell, r)) for r in want[columns].itertuples(index=False))


def test_entry(spark):
    out = E.entry(spark)
    assert out.columns == ["id", "n_senses", "entry"] and out.count() > 0


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_plans_push_filters_and_prune_columns(spark, sf):
    plan = QUERIES["lang_filter_project"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(lang" in plan and "n_chars" not in plan


def test_examples_of_all_benchmark_words(spark, tmp_path):
    """All items and all documents count; by brute force."""
    items = [(i, f"Word{i}, shared tail") for i in range(14)] + [(14, None)]
    docs = [(1, "a word3 word12 shared", "en"), (2, "word13 word13 shared!", "en"), (3, "word12", "es"), (4, None, "en")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.es_word: (r.n_examples, r.ids) for r in QUERIES["enrich_examples"](spark, str(tmp_path)).collect()}
    want = {f"word{i}": (0, "") for i in range(14)} | {"word3": (1, "1"), "word12": (2, "1,3"), "word13": (1, "2"), "shared": (2, "1,2"), "tail": (0, "")}
    assert got == want


def test_documents_are_split_once_for_their_examples(spark, sf, monkeypatch):
    from lexforge.operators import examples

    plans = {}
    monkeypatch.setattr(examples, "settle", lambda df, label, real=examples.settle: plans.update({label: df._jdf.queryExecution().optimizedPlan().toString()}) or real(df, label))
    QUERIES["enrich_examples"](spark, sf)
    over = [p for p in plans.values() if "documents.parquet" in p or "n_chars" in p or "doc_id" in p]
    assert len(over) == 1 and over[0].count("split(") == 1 and "regexp_replace" not in over[0]


@pytest.fixture()
def named_parts(spark, tmp_path):
    rows = [(1, "red pin", "Brand#1", "SMALL"), (2, "red pin", "Brand#2", "LARGE"), (3, "tin", "Brand#1", "SMALL"), (4, "blue nut", "Brand#3", "PROMO")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_every_two_names_are_scored(spark, named_parts):
    got = {(r.x, r.y): r.score for r in QUERIES["fuzzy_ratio_sql"](spark, named_parts).collect()}
    names = sorted({"red pin", "tin", "blue nut"})
    assert got == pytest.approx({(a, b): ratio(a, b) for i, a in enumerate(names) for b in names[i + 1 :]})


def test_every_name_beside_every_name_is_summed_up(spark, named_parts):
    """Of 9 pairs the 3 of a name with itself are exact."""
    got = QUERIES["similarity_summary"](spark, named_parts).first()
    assert (got.pairs, got.exact) == (9, 3)


def test_every_name_is_compared_with_every_name(spark, named_parts):
    got = {(r.x, r.y): r.similarity for r in QUERIES["ipa_overlap"](spark, named_parts).collect()}
    names = ("red pin", "tin", "blue nut")
    assert got == pytest.approx({(a, b): sum(c in b for c in a) / max(len(a), len(b)) for a in names for b in names})


def test_files_follow_the_number_of_partitions(spark, tmp_path, monkeypatch):
    """No fixed number of tasks writes all sentences."""
    from lexforge import queries

    seen = []
    monkeypatch.setattr(queries.readers, "read_sentences", lambda spark, path, real=queries.readers.read_sentences: seen.append(len(spark.read.text(path).inputFiles())) or real(spark, path))
    spark.range(3000).selectExpr("id as doc_id", "concat('text ', id) as text", "'es' as lang").repartition(9).write.parquet(f"{tmp_path}/documents.parquet")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = QUERIES["scan_sentences"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] >= 7
    assert sorted((r.row_idx, r.id) for r in rows) == [(i, str(i)) for i in range(3000)]
