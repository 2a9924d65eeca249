import json

from lexforge.operators.monitor import MetricsCollector
from lexforge.plans import runner
from lexforge.sources.catalog import Catalog, Dataset


def write(path, records):
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")
    return str(path)


def test_from_dumps_to_dictionary(spark, tmp_path):
    link = lambda code, word: {"lang_code": code, "code": code, "word": word}
    es = [
        {"word": "banco", "lang_code": "es", "pos": "noun", "senses": [{"glosses": ["Asiento largo"]}, {"glosses": ["Institución financiera"]}], "translations": [link("he", "ספסל"), link("he", "בנק")]},
        {"word": "libro", "lang_code": "es", "pos": "noun", "senses": [{"glosses": ["Obra"]}]}, {"word": "Madrid", "lang_code": "es", "pos": "name"},
    ]
    he = [{"word": w, "lang_code": "he", "pos": "noun", "sounds": [{"ipa": s}], "senses": [{"glosses": [g]}]} for w, s, g in (("ספסל", "/saf.sal/", "Asiento"), ("בנק", "/bank/", "Dinero"), ("ספר", "", "Libro"))]
    en = [{"word": "libro", "lang_code": "es", "translations": [link("he", "ספר")]}]
    (tmp_path / "s.tsv").write_text("1\tes\tEl banco abre\n2\the\tעל בנק גדול\n", encoding="utf-8")
    files = {"raw_spanish": es, "raw_hebrew": he, "raw_english": en, "raw_french": [], "raw_german": []}
    catalog = Catalog(spark, {n: Dataset("jsonl", write(tmp_path / f"{n}.jsonl", r)) for n, r in files.items()} | {"sentences": Dataset("sentences", str(tmp_path / "s.tsv"))})
    metrics = MetricsCollector()
    runner.run(catalog, folder=str(tmp_path / "work"), metrics=metrics)
    entries = json.loads("[" + "".join(r.line for r in catalog.load("dictionary").orderBy("place").collect()) + "]")
    got = {e["entry"]["word"]: [(s["sense_id"], s["hebrew"], s["ipa_hebrew"], len(s["examples"])) for s in e["entry"]["senses"]] for e in entries}
    assert got == {"banco": [(1, "ספסל", "/saf.sal/", 0), (2, "בנק", "/bank/", 1)], "libro": [(1, "ספר", "/spʁ/", 0)]}
    assert catalog.load("data_quality_report").first().total_entries == 3
    assert {r.check: r.bad for r in catalog.load("document_checks").collect()}["senses_without_ipa"] == 0
    assert len(metrics.samples) == sum(map(len, runner.PIPELINES.values()))


def test_steps_come_after_their_inputs():
    steps = [s for p in reversed(list(runner.PIPELINES.values())) for s in p]
    seen, made = set(), {o for s in steps for o in s.outputs}
    for s in runner.ordered(steps):
        assert all(i in seen or i not in made for i in s.inputs)
        seen |= set(s.outputs)
