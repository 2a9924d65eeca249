"""A catalogue of named datasets: name, format, path and options."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lexforge.sources import readers, writers


@dataclass
class Dataset:
    """`kind`: jsonl, sentences, parquet, json or memory."""

    kind: str
    path: str | None = None
    ddl: str | None = None
    value: Any = None


@dataclass
class Catalog:
    spark: SparkSession
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def load(self, name: str) -> Any:
        """The dataset; a name that was only saved in memory is handed over as it is."""
        if name not in self.datasets:
            raise KeyError(f"no dataset {name!r}; known: {sorted(self.datasets)}")
        d = self.datasets[name]
        if d.kind == "memory":
            return d.value
        read = {
            "jsonl": readers.read_json_lines, "sentences": readers.read_sentences,
            "parquet": lambda s, p: s.read.parquet(p), "json": lambda s, p: readers.read_json_document(s, p, d.ddl),
        }[d.kind]
        return read(self.spark, d.path)

    def save(self, name: str, value: Any) -> None:
        d = self.datasets.setdefault(name, Dataset("memory"))
        if d.kind == "parquet" and isinstance(value, DataFrame):
            writers.write_parquet(value, d.path)
        elif d.kind == "json" and isinstance(value, DataFrame):
            writers.write_json_documents(value, d.path)
        elif d.kind == "text":
            writers.write_text(d.path, value)
        else:
            d.value = value
