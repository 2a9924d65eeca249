"""Metrics, alerts and health."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SEVERITIES = ("info", "warning", "error", "critical")
SAMPLES = "seq long, name string, value double, ts timestamp, labels map<string,string>"


def label_key(labels: Column) -> Column:
    """The labels as text with their keys in order, the same for equal maps."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def latest(samples: DataFrame, order: str = "seq") -> DataFrame:
    """(name, label_key, labels, value) of the last sample of each name and label set."""
    keyed = samples.withColumn("label_key", label_key(F.coalesce("labels", F.expr("cast(map() as map<string,string>)"))))
    return keyed.groupBy("name", "label_key").agg(F.max_by(F.struct("labels", "value"), order).alias("s")).select("name", "label_key", "s.labels", "s.value")


def prometheus_lines(samples: DataFrame) -> DataFrame:
    """A line of exposition text for each name and label set."""
    pairs = F.array_join(F.transform(F.map_entries(F.col("labels")), lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"'))), ",")
    marks = F.when(F.coalesce(F.size("labels"), F.lit(0)) > 0, F.concat(F.lit("{"), pairs, F.lit("}"))).otherwise(F.lit(""))
    return latest(samples).select("name", F.concat("name", marks, F.lit(" "), F.col("value").cast("string")).alias("line"))


def counters(events: DataFrame, *keys: str) -> DataFrame:
    """The value of a counter that went up by one for each row."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("value"))


@dataclass
class MetricsCollector:
    """Samples of the driver's run, handed to Spark as one table."""

    started: float = field(default_factory=time.time)
    samples: list[tuple[int, str, float, float, dict[str, str]]] = field(default_factory=list)

    def record(self, name: str, value: float, labels: dict[str, str] | None = None) -> None:
        self.samples.append((len(self.samples), name, float(value), time.time(), dict(labels or {})))

    def increment(self, name: str, labels: dict[str, str] | None = None) -> None:
        same = [v for _, n, v, _, own in self.samples if n == name and own == dict(labels or {})]
        self.record(name, (same[-1] if same else 0) + 1, labels)

    def duration(self, name: str, seconds: float, labels: dict[str, str] | None = None) -> None:
        self.record(f"{name}_duration_seconds", seconds, labels)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, n, v, t, own) for i, n, v, t, own in self.samples]
        return spark.createDataFrame(rows, SAMPLES.replace("ts timestamp", "ts double")).withColumn("ts", F.timestamp_seconds("ts"))

    def export_json(self) -> str:
        metrics: dict[str, list[dict]] = {}
        for _, n, v, t, own in self.samples:
            metrics.setdefault(n, []).append({"value": v, "timestamp": t, "labels": own})
        return json.dumps({"uptime_seconds": time.time() - self.started, "metrics": metrics}, indent=2)


def severity_at_least(severity: Column, least: str) -> Column:
    rank = F.element_at(F.create_map(*(F.lit(x) for i, s in enumerate(SEVERITIES) for x in (s, i))), severity)
    return rank >= SEVERITIES.index(least)


def quality_alert(score: Column) -> Column:
    return F.when(score < 60, F.struct(F.lit("data_quality_critical").alias("name"), F.lit("critical").alias("severity"))).when(
        score < 75, F.struct(F.lit("data_quality_degraded").alias("name"), F.lit("warning").alias("severity")),
    )


def coverage_alert(rate: Column) -> Column:
    return F.when(rate < 0.5, F.struct(F.lit("ipa_coverage_critical").alias("name"), F.lit("critical").alias("severity"))).when(
        rate < 0.8, F.struct(F.lit("ipa_coverage_low").alias("name"), F.lit("warning").alias("severity")),
    )


def duplicate_alert(duplicates: Column, total: Column) -> Column:
    rate = F.when(total > 0, duplicates / total).otherwise(F.lit(0.0))
    return F.when((duplicates > 0) & (rate > 0.05), F.struct(F.lit("high_duplicate_rate").alias("name"), F.lit("error").alias("severity"))).when(
        duplicates > 0, F.struct(F.lit("duplicates_found").alias("name"), F.lit("warning").alias("severity")),
    )


def duration_alert(seconds: Column, limit: float = 1800) -> Column:
    return F.when(seconds > limit, F.struct(F.lit("slow_pipeline_execution").alias("name"), F.lit("warning").alias("severity")))


def fired(df: DataFrame, *alerts: Column) -> DataFrame:
    """A row for each rule that holds, with `alert` and `severity`."""
    rows = F.filter(F.array(*alerts), lambda a: a.isNotNull())
    return df.withColumn("_a", F.explode(rows)).select(*df.columns, F.col("_a.name").alias("alert"), F.col("_a.severity").alias("severity"))


@dataclass
class Alert:
    name: str
    severity: str
    message: str
    context: dict = field(default_factory=dict)
    ts: float = field(default_factory=time.time)


@dataclass
class AlertManager:
    """Alerts of the driver's run; a handler that fails does not stop the others."""

    alerts: list[Alert] = field(default_factory=list)
    handlers: list[Callable[[Alert], None]] = field(default_factory=list)

    def fire(self, name: str, severity: str, message: str, context: dict | None = None) -> Alert:
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity: {severity!r}")
        alert = Alert(name, severity, message, dict(context or {}))
        self.alerts.append(alert)
        for handler in self.handlers:
            try:
                handler(alert)
            except Exception as e:  # noqa: BLE001  a handler's own fault
                print(f"alert handler failed: {e}")
        return alert

    def fire_rows(self, rows: DataFrame) -> None:
        """Fire what `fired` found; there are as many rows as rules that hold."""
        for r in rows.select("alert", "severity").toLocalIterator():
            self.fire(r.alert, r.severity, r.alert.replace("_", " "))

    def at_least(self, severity: str) -> list[Alert]:
        return [a for a in self.alerts if SEVERITIES.index(a.severity) >= SEVERITIES.index(severity)]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(a.name, a.severity, a.message, {k: str(v) for k, v in a.context.items()}, a.ts) for a in self.alerts]
        return spark.createDataFrame(rows, "name string, severity string, message string, context map<string,string>, ts double").withColumn("ts", F.timestamp_seconds("ts"))

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as out:
            json.dump([vars(a) for a in self.alerts], out, ensure_ascii=False, indent=2)

    @staticmethod
    def file_handler(folder: str) -> Callable[[Alert], None]:
        """Writes each alert to a file of its own."""

        def write(alert: Alert) -> None:
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, f"{alert.name}_{alert.ts:.6f}.json"), "w", encoding="utf-8") as out:
                json.dump(vars(alert), out, ensure_ascii=False, indent=2)

        return write


def age_hours(then: Column, now: Column) -> Column:
    return (F.unix_timestamp(now) - F.unix_timestamp(then)) / 3600.0


def stale(then: Column, now: Column, hours: float = 168) -> Column:
    return age_hours(then, now) > hours


@dataclass
class HealthCheck:
    """Folders exist, outputs are there and fresh, and the quality score is good: healthy only if all are."""

    folders: tuple[str, ...]
    outputs: tuple[str, ...]
    report: str | None = None
    stale_hours: float = 168

    def _output(self, path: str, now: float) -> str:
        if not os.path.exists(path):
            return "missing"
        return "stale" if (now - os.path.getmtime(path)) / 3600 > self.stale_hours else "healthy"

    def _quality(self) -> str:
        if not self.report or not os.path.exists(self.report):
            return "unknown"
        with open(self.report, encoding="utf-8") as f:
            score = json.load(f).get("overall_quality_score", 0)
        return "healthy" if score >= 75 else "degraded" if score >= 60 else "unhealthy"

    def check(self, now: float | None = None) -> dict:
        now = time.time() if now is None else now
        parts = {f"folder:{p}": "healthy" if os.path.isdir(p) else "missing" for p in self.folders}
        parts |= {f"output:{p}": self._output(p, now) for p in self.outputs} | {"quality": self._quality()}
        return {"status": "healthy" if all(x == "healthy" for x in parts.values()) else "unhealthy", "checks": parts}


def numbered(df: DataFrame, *order: str, name: str = "seq") -> DataFrame:
    """A sample order inside each metric name."""
    return df.withColumn(name, F.row_number().over(W.partitionBy("name").orderBy(*order)).cast("long"))
