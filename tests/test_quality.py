import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lexforge.operators import monitor, quality, stats

ALIGNED = "es_word string, he_word string, sense_id int, match_type string, es_definition string, he_ipa string, confidence double, es_pos string"
ROWS = [
    ("a", "בית", 1, "direct", "d", "/x/", None, "noun"), ("a", "בית", 1, "triangulation", "d", "", None, "noun"), ("b", "abc", 0, "fuzzy_85.7", "d", None, 0.857, "verb"), (None, "בית", 2, "other", "d", "/xx/", 7.0, None),
]


def checked(report):
    return {r.check: r.bad for r in report.collect()}


def test_alignment_checks(spark):
    got = checked(quality.alignment_checks(spark.createDataFrame(ROWS, ALIGNED)))
    assert got == {"null_es_word": 1, "null_he_word": 0, "null_sense_id": 0, "sense_id_below_1": 1, "duplicates": 2, "match_type": 1, "confidence": 0, "no_hebrew_script": 1, "missing_ipa": 2}
    with pytest.raises(ValueError, match="null_es_word: 1 of 4"):
        quality.enforce(quality.alignment_checks(spark.createDataFrame(ROWS, ALIGNED)))
    with pytest.raises(quality.MissingColumns):
        quality.alignment_checks(spark.createDataFrame([("a",)], "es_word string"))


def test_entry_and_document_checks(spark):
    entries = spark.createDataFrame([("בית", "noun", ["a"]), ("x", None, []), ("", "unknown", None)], "word string, pos string, definitions array<string>")
    assert checked(quality.entry_checks(entries, hebrew=True)) == {"empty_word": 1, "pos_unknown": 2, "empty_definitions": 2, "no_hebrew_script": 2}
    empty = quality.entry_checks(entries.limit(0)).collect()
    assert all(r.passed and r.rate == 0 for r in empty)
    docs = spark.createDataFrame([("1", ("w", "es", [(1, "h", "None")])), (None, ("", "fr", []))], "id string, entry struct<word:string,language:string,senses:array<struct<sense_id:int,hebrew:string,ipa_hebrew:string>>>")
    assert checked(quality.document_checks(docs)) == {"missing_id_or_entry": 1, "missing_word": 1, "language": 1, "no_senses": 1, "missing_sense_id": 0, "missing_hebrew": 0, "senses_without_ipa": 1}


def test_example_checks(spark):
    rows = spark.createDataFrame([(*r, [("a", None)] if r[0] == "b" else [("a", "b")]) for r in ROWS], ALIGNED + ", examples array<struct<es:string,he:string>>")
    assert checked(quality.example_checks(rows))["broken_examples"] == 1


def test_report(spark):
    r = quality.quality_report(spark.createDataFrame(ROWS, ALIGNED)).first()
    assert (r.total_entries, r.direct_rate, r.ipa_coverage, r.duplicates, r.max_senses, r.polysemic_words) == (4, 0.25, 0.5, 2, 2, 1)
    assert r.overall_quality_score == pytest.approx(100 - 15 - 20) and r.verdict == "ACCEPTABLE" and len(r.issues) == 3
    empty = quality.quality_report(spark.createDataFrame([], ALIGNED)).first()
    assert empty.total_entries == 0 and empty.overall_quality_score == 70.0


def test_bands(spark):
    out = spark.createDataFrame([(0.04, 0.9), (0.05, 0.5), (0.2, 0.4)], "m double, c double").select(quality.band(F.col("m")).alias("a"), quality.coverage_band(F.col("c")).alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [("✓", "✓"), ("⚠", "⚠"), ("✗", "✗")]


def test_statistics_and_charts(spark):
    e = "ipa string, pos string, definitions array<string>, translations_he array<string>, translations_es array<string>"
    entries = spark.createDataFrame([("", "noun", ["a", "b"], ["x"], None), (None, "noun", ["a"], [], ["y"]), ("k", None, None, None, [])], e)
    pairs = spark.createDataFrame([(["a"], ["b", "c"])], "es_words array<string>, he_words array<string>")
    p = stats.parsing_stats(entries, entries, pairs)
    r = p.first()
    assert (r.spanish.total_entries, r.spanish.entries_with_ipa, r.spanish.entries_with_nonempty_ipa, r.spanish.ipa_coverage_pct, r.spanish.total_translations) == (3, 2, 1, 66.67, 1)
    assert r.spanish.pos_distribution == {"noun": 2} and r.examples.avg_hebrew_words == 2.0
    aligned = spark.createDataFrame(ROWS, ALIGNED)
    a = stats.alignment_stats(aligned, aligned.withColumn("examples", F.array(F.lit(1))))
    s = stats.progress_summary(p, a).first()
    assert s.pipeline_overview.total_alignments == 4 and s.linguistic_features.polysemic_words == 1 and s.data_quality.example_coverage == 100.0
    assert {x.chart for x in stats.parsing_charts(p).collect()} == {"entry_counts", "ipa_coverage", "spanish_pos", "hebrew_pos"}
    assert {(x.label, x.value) for x in stats.alignment_charts(a).where("chart = 'polysemy'").collect()} == {("Monosemic", 1.0), ("Polysemic", 1.0)}
    none = stats.parsing_stats(entries.limit(0), entries.limit(0), pairs.limit(0)).first()
    assert none.spanish.ipa_coverage_pct == 0.0 and none.spanish.total_translations == 0


def test_samples(spark):
    m = monitor.MetricsCollector()
    m.record("n", 1, {"b": "2", "a": "1"}), m.record("n", 5, {"a": "1", "b": "2"}), m.record("n", 3), m.increment("c"), m.increment("c"), m.duration("run", 2.5)
    frame = m.frame(spark)
    got = {(r.name, r.label_key): r.value for r in monitor.latest(frame).collect()}
    assert got == {("n", '{"a":"1","b":"2"}'): 5.0, ("n", "{}"): 3.0, ("c", "{}"): 2.0, ("run_duration_seconds", "{}"): 2.5}
    lines = {r.line for r in monitor.prometheus_lines(frame).collect()}
    assert 'n{a="1",b="2"} 5.0' in lines and "c 2.0" in lines
    assert json.loads(m.export_json())["metrics"]["c"][1]["value"] == 2


def test_alerts(spark, tmp_path):
    manager, seen = monitor.AlertManager(), []
    manager.handlers = [lambda a: 1 / 0, seen.append, monitor.AlertManager.file_handler(str(tmp_path / "a"))]
    values = spark.createDataFrame([(50.0, 0.4, 6, 100, 1801.0), (70.0, 0.7, 5, 100, 1800.0), (80.0, 0.9, 0, 0, 1.0)], "q double, c double, d long, n long, s double")
    rules = (monitor.quality_alert(F.col("q")), monitor.coverage_alert(F.col("c")), monitor.duplicate_alert(F.col("d"), F.col("n")), monitor.duration_alert(F.col("s")))
    rows = monitor.fired(values, *rules)
    assert sorted((r.q, r.alert) for r in rows.collect()) == [
        (50.0, "data_quality_critical"), (50.0, "high_duplicate_rate"), (50.0, "ipa_coverage_critical"), (50.0, "slow_pipeline_execution"),
        (70.0, "data_quality_degraded"), (70.0, "duplicates_found"), (70.0, "ipa_coverage_low"),
    ]
    manager.fire_rows(rows)
    assert len(seen) == 7 and len(manager.at_least("error")) == 3 and len(os.listdir(tmp_path / "a")) == 7 and manager.frame(spark).count() == 7
    manager.save(str(tmp_path / "all.json"))
    with pytest.raises(ValueError):
        manager.fire("x", "loud", "m")


def test_health(tmp_path):
    out, report = tmp_path / "out", tmp_path / "r.json"
    h = monitor.HealthCheck((str(tmp_path),), (str(out),), str(report))
    assert h.check()["status"] == "unhealthy" and h.check()["checks"]["quality"] == "unknown"
    out.write_text("x"), report.write_text('{"overall_quality_score": 80}')
    assert h.check()["status"] == "healthy"
    assert h.check(now=time.time() + 169 * 3600)["checks"][f"output:{out}"] == "stale"


def test_streams(spark, tmp_path):
    from lexforge.streaming import monitoring

    spark.createDataFrame([("n", 50.0, "2024-01-01 00:00:00"), ("n", 70.0, "2024-01-01 00:01:00")], "name string, value double, t string").selectExpr("name", "value", "cast(t as timestamp) as ts", "map('a', '1') as labels").write.parquet(str(tmp_path / "s"))
    stream = lambda: spark.readStream.schema("name string, value double, ts timestamp, labels map<string,string>").parquet(str(tmp_path / "s"))

    def run(df, mode, name):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name).collect()

    assert [r.value for r in run(monitoring.latest_stream(stream()), "complete", "latest_s")] == [70.0]
    assert sorted(r.alert for r in run(monitoring.alert_stream(stream(), monitor.quality_alert(F.col("value"))), "append", "alerts_s")) == ["data_quality_critical", "data_quality_degraded"]
    assert [r.value for r in run(monitoring.counter_stream(stream(), "ts", "name"), "complete", "counts_s")] == [2.0]


def test_failing_rows_are_the_first_of_each_rule(spark):
    rows = [(i, "" if i % 3 == 0 else f"w{i}", None if i % 2 else "noun", [] if i == 7 else ["d"]) for i in range(200)] + [(3, "x", None, ["d"])]
    frame = spark.createDataFrame(rows, "row_idx long, word string, pos string, definitions array<string>").repartition(6)
    got = {}
    for r in quality.failing_rows(frame, quality.entry_rules(hebrew=True), "word", n=5).orderBy("check", "place").collect():
        got.setdefault(r.check, []).append((r.row_idx, r.word))
    assert got["empty_word"] == [(0, ""), (3, ""), (6, ""), (9, ""), (12, "")] and got["empty_definitions"] == [(7, "w7")]
    assert got["pos_unknown"] == [(1, "w1"), (3, ""), (3, "x"), (5, "w5"), (7, "w7")] and len(got["no_hebrew_script"]) == 5
    assert quality.failing_rows(frame.limit(0), quality.entry_rules(), "word").count() == 0
    plan = quality.failing_rows(frame, quality.entry_rules(), "word")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # each task keeps its own first rows before the shuffle


def test_documents_are_gone_through_once(spark, tmp_path):
    """All checks come from one scan; a null list has no senses, a null sense no transcription."""
    from lexforge.operators.quality import document_checks

    ddl = "id string, entry struct<word:string,language:string,senses:array<struct<sense_id:int,hebrew:string,ipa_hebrew:string>>>"
    rows = [("a", ("a", "es", [(1, "x", "/x/"), (2, None, "None"), None])), ("b", ("b", "xx", None)), (None, None), ("c", ("", "es", []))]
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/d")
    out = document_checks(spark.read.parquet(f"{tmp_path}/d"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert {r.check: (r.bad, r.total) for r in out.collect()} == {
        "missing_id_or_entry": (1, 4), "missing_word": (2, 4), "language": (2, 4), "no_senses": (3, 4), "missing_sense_id": (1, 4), "missing_hebrew": (1, 4), "senses_without_ipa": (2, 3),
    }
