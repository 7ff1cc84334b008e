"""Metric documents as long-form rows in an append-only Parquet table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators import ranking
from rowsmith.sources.files import read_documents
from rowsmith.sources.log import AppendLog, read_or_empty

METRIC_COLUMNS = (
    "model_id string, timestamp timestamp, suffix string, split string, "
    "scope string, class string, metric string, value double"
)
METRIC_SCHEMA = METRIC_COLUMNS + ", entry_id string"

OVERALL = ("accuracy", "precision", "recall", "f1_score", "balanced_accuracy", "roc_auc", "total_samples", "num_classes")

_VALUES = "accuracy double, precision double, recall double, f1_score double, roc_auc double"
# A stored document: metrics at the top level, or below test_metrics after training.
DOCUMENT_SCHEMA = (
    "model_id string, timestamp string, "
    f"metrics struct<{_VALUES.replace(' double', ':double')}, model_name:string, "
    f"test_metrics:struct<{_VALUES.replace(' double', ':double')}>>"
)


def flatten_metrics(document: dict) -> list[tuple[str, str, str | None, str, float]]:
    """Rows ``(split, scope, class, metric, value)`` of a metrics document.

    The document is either one set of metrics, taken as test metrics, or has
    ``train_metrics`` and ``test_metrics`` below it.
    """
    if "test_metrics" in document or "train_metrics" in document:
        parts = [(s, document[f"{s}_metrics"]) for s in ("train", "test") if f"{s}_metrics" in document]
    else:
        parts = [("test", document)]
    rows = []
    for split, part in parts:
        rows += [(split, "overall", None, m, float(part[m])) for m in OVERALL if part.get(m) is not None]
        for label, scores in part.get("per_class", {}).items():
            rows += [(split, "class", label, m, float(v)) for m, v in scores.items()]
        rows += [(split, "class", label, "support", float(n)) for label, n in part.get("support", {}).items()]
        report = part.get("classification_report", {})
        for scope in ("macro", "weighted"):
            rows += [(split, scope, None, m, float(v)) for m, v in report.get(f"{scope} avg", {}).items()]
    return rows


class MetricsStore:
    """Metric entries below ``path``. Every save writes a folder of its own, so writers never
    touch each other's files and readers see whole entries."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = AppendLog(spark, f"{self.path}/entries", METRIC_SCHEMA, "entry_id")

    def all_rows(self) -> DataFrame:
        return self.log.rows()

    def compact(self, retention: timedelta = timedelta(days=7)) -> int:
        """Gather the entries so far in few files; see ``AppendLog.compact``."""
        return self.log.compact(retention)

    def rows(self) -> DataFrame:
        """All rows but those of deleted entries."""
        gone = read_or_empty(self.spark, f"{self.path}/deleted", "entry_id string")
        rows = self.all_rows()
        return rows.join(gone.distinct(), "entry_id", "left_anti").select(*rows.columns)

    def delete(self, entry_ids: DataFrame) -> None:
        """Take entries out of every reader's sight; their ids are appended to a table of their own."""
        entry_ids = entry_ids.select("entry_id").distinct()
        if not entry_ids.isEmpty():
            entry_ids.write.mode("append").parquet(f"{self.path}/deleted")

    def cleanup(self, keep_latest: int = 10) -> None:
        """Delete all but the newest entries of each model and suffix."""
        self.delete(ranking.outdated_entries(self.rows(), keep_latest))

    def save(self, document: dict, model_id: str, suffix: str = "", timestamp: datetime | None = None) -> str:
        """Append one entry and return its id."""
        stamp = timestamp or datetime.now(timezone.utc)
        flat = [(model_id, stamp, suffix, *row) for row in flatten_metrics(document)]
        if not flat:
            raise ValueError("the document holds no metrics")
        return self.append(self.spark.createDataFrame(flat, METRIC_COLUMNS).coalesce(1))

    def append(self, rows: DataFrame) -> str:
        """Append metric rows computed by Spark as one entry."""
        return self.log.append(rows)

    def load(self, model_id: str, suffix: str = "") -> DataFrame:
        """Rows of the newest entry of a model and suffix; an absent entry raises."""
        wanted = self.rows().filter((F.col("model_id") == model_id) & (F.col("suffix") == suffix))
        newest = wanted.agg(F.max_by("entry_id", F.struct("timestamp", "entry_id")).alias("e")).first()["e"]
        if newest is None:
            raise LookupError(f"no metrics stored for {model_id!r} with suffix {suffix!r}")
        return wanted.filter(F.col("entry_id") == newest)

    def entries(self) -> DataFrame:
        return ranking.entries(self.rows())

    def latest(self) -> DataFrame:
        return ranking.latest_entry_values(self.rows())

    def compare(self, primary: str = "f1_score") -> DataFrame:
        return ranking.compare_models(self.rows(), primary)

    def best_model_id(self, primary: str = "f1_score") -> str | None:
        return ranking.best_model(self.compare(primary), primary).first()["model_id"]


def read_metric_documents(spark: SparkSession, path: str) -> DataFrame:
    """Latest test metrics per model from a folder of JSON documents, one per line.

    Unreadable documents are skipped; a newer document of a model replaces older ones.
    """
    docs = read_documents(spark, path, DOCUMENT_SCHEMA).filter(
        F.col("_corrupt_record").isNull() & F.col("model_id").isNotNull()
    )
    newest = F.max_by(F.struct("timestamp", "metrics"), F.col("timestamp"))
    latest = docs.groupBy("model_id").agg(newest.alias("d"))
    return latest.select(
        "model_id",
        F.col("d.timestamp").alias("timestamp"),
        *[F.coalesce(f"d.metrics.test_metrics.{m}", f"d.metrics.{m}").alias(m) for m in ranking.COMPARED],
        F.col("d.metrics.model_name").alias("model_name"),
    )


def metric_documents(rows: DataFrame) -> DataFrame:
    """Long-form rows back to documents: ``(model_id, timestamp, suffix, metrics)`` per entry."""
    overall = rows.filter("scope = 'overall'")
    per_split = overall.groupBy("model_id", "suffix", "timestamp", "split").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m")
    )
    keyed = F.struct(F.concat("split", F.lit("_metrics")), "m")
    return per_split.groupBy("model_id", "suffix", "timestamp").agg(
        F.map_from_entries(F.collect_list(keyed)).alias("metrics")
    )
