"""The stages as named steps, and the order that their inputs give."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lexforge.functions import ipa
from lexforge.operators import align, clean, examples, monitor, parse, quality, senses, stats
from lexforge.sources.catalog import Catalog, Dataset


@dataclass(frozen=True)
class Step:
    run: Callable
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]


def _report(df: DataFrame) -> DataFrame:
    return quality.quality_report(df)


#: Sub-pipelines by name, each a list of steps.
PIPELINES: dict[str, list[Step]] = {
    "parsing": [
        Step(parse.spanish_entries, ("raw_spanish",), ("spanish_unfiltered",)), Step(parse.hebrew_entries, ("raw_hebrew",), ("hebrew_unfiltered",)),
        Step(lambda raw: parse.bridge_entries(raw, "code"), ("raw_english",), ("english_bridge",)),
        Step(parse.bridge_entries, ("raw_french",), ("french_bridge",)), Step(parse.bridge_entries, ("raw_german",), ("german_bridge",)),
    ],
    "cleaning": [
        Step(clean.filter_proper_nouns, ("spanish_unfiltered",), ("spanish_filtered",)), Step(clean.filter_proper_nouns, ("hebrew_unfiltered",), ("hebrew_filtered",)),
    ],
    "features": [Step(clean.add_frequency_ranks, ("spanish_filtered",), ("spanish_entries",)), Step(clean.add_frequency_ranks, ("hebrew_filtered",), ("hebrew_entries",))],
    "bridge": [Step(lambda en, fr, de: clean.combine_bridges(english=en, french=fr, german=de), ("english_bridge", "french_bridge", "german_bridge"), ("bridge_entries",))],
    "examples": [Step(lambda s: examples.tokenized(examples.pair_by_position(s)), ("sentences",), ("examples",))],
    "alignment": [
        Step(align.align, ("spanish_entries", "hebrew_entries", "bridge_entries"), ("aligned",)), Step(examples.enrich, ("aligned", "examples"), ("enriched_plain",)),
        Step(senses.cluster_senses, ("enriched_plain",), ("enriched",)), Step(senses.structure, ("enriched",), ("documents",)),
    ],
    "phonemization": [Step(ipa.build_lookup, ("hebrew_entries",), ("lookup",)), Step(ipa.fill_documents, ("documents", "lookup"), ("documents_with_ipa",))],
    "output": [Step(senses.dictionary_lines, ("documents_with_ipa",), ("dictionary",))],
    "statistics": [
        Step(stats.parsing_stats, ("spanish_entries", "hebrew_entries", "examples"), ("parsing_stats",)), Step(stats.parsing_charts, ("parsing_stats",), ("parsing_charts",)),
        Step(stats.alignment_stats, ("aligned", "enriched"), ("alignment_stats",)), Step(stats.alignment_charts, ("alignment_stats",), ("alignment_charts",)),
        Step(stats.progress_summary, ("parsing_stats", "alignment_stats"), ("progress_summary",)),
    ],
    "validation": [
        Step(quality.entry_checks, ("spanish_entries",), ("spanish_checks",)), Step(lambda d: quality.entry_checks(d, hebrew=True), ("hebrew_entries",), ("hebrew_checks",)),
        Step(quality.example_checks, ("enriched",), ("enriched_checks",)), Step(quality.document_checks, ("documents_with_ipa",), ("document_checks",)),
        Step(_report, ("enriched",), ("data_quality_report",)),
    ],
}


def ordered(steps: list[Step]) -> list[Step]:
    """Steps after those that make their inputs."""
    made = {o for s in steps for o in s.outputs}
    out, ready, left = [], set(), list(steps)
    while left:
        now = [s for s in left if all(i not in made or i in ready for i in s.inputs)]
        if not now:
            raise ValueError(f"steps wait for each other: {[s.outputs for s in left]}")
        out += now
        ready |= {o for s in now for o in s.outputs}
        left = [s for s in left if s not in now]
    return out


def run(catalog: Catalog, *names: str, folder: str, metrics: monitor.MetricsCollector | None = None) -> Catalog:
    """Run the named sub-pipelines, or all, over the catalogue's datasets.

    What a step makes is written to `folder`, which all executors share, and read from there
    by the steps after it; so a plan never spans two steps, and nothing is computed twice.
    """
    for step in ordered([s for n in names or PIPELINES for s in PIPELINES[n]]):
        began = time.time()
        for name, value in zip(step.outputs, (step.run(*(catalog.load(i) for i in step.inputs)),), strict=True):
            catalog.datasets.setdefault(name, Dataset("parquet", f"{folder}/{name}"))
            catalog.save(name, value)
        if metrics:
            metrics.duration("step", time.time() - began, {"output": step.outputs[0]})
    return catalog
