"""Model registry: saved pipelines and an append-only event table."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators import ranking
from rowsmith.session import create_exclusively, drop_path, list_folders
from rowsmith.sources.files import write_document
from rowsmith.sources.log import AppendLog
from rowsmith.sources.metrics import MetricsStore, metric_documents

EVENT_COLUMNS = (
    "model_id string, event string, created timestamp, artifact string, model_type string, "
    "file_size bigint, pipeline_steps array<string>, classes array<string>, metadata map<string,string>"
)
EVENT_SCHEMA = EVENT_COLUMNS + ", event_id string"


class ModelNotFound(LookupError):
    """The id is not in the registry."""


def model_labels(model: PipelineModel) -> list[str] | None:
    """Class labels in probability order, if the pipeline ends by naming its predictions."""
    last = model.stages[-1] if model.stages else None
    return list(last.getLabels()) if isinstance(last, IndexToString) else None


class ModelRegistry:
    """Models below ``path``. An id is replaced or deleted by appending an event; artifacts are
    written to a new folder each time, so a reader never loses the model it is loading."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = AppendLog(spark, f"{self.path}/events", EVENT_SCHEMA, "event_id")
        self.metrics = MetricsStore(spark, f"{self.path}/metrics")

    def events(self) -> DataFrame:
        return self.log.rows()

    def current(self) -> DataFrame:
        return ranking.current_models(self.events())

    def _append(self, rows: DataFrame) -> str:
        return self.log.append(rows)

    def compact(self, retention: timedelta = timedelta(days=7)) -> int:
        """Gather events and metric entries so far in few files, so that readers list few folders."""
        return self.log.compact(retention) + self.metrics.compact(retention)

    def exists(self, model_id: str) -> bool:
        wanted = self.events().filter(F.col("model_id") == model_id)
        return not ranking.current_models(wanted).isEmpty()

    def save_model(
        self,
        model: PipelineModel,
        model_id: str,
        metadata: dict[str, Any] | None = None,
        overwrite: bool = True,
    ) -> str:
        """Write the fitted pipeline, then register it. Returns the artifact path.

        With ``overwrite=False`` an existing id raises, and of several writers of a new id one succeeds.
        """
        if overwrite:
            return self._save(model, model_id, metadata)
        claim = self._claim(model_id)
        try:
            # Whoever saved between the look and the claim is seen now.
            if self.exists(model_id):
                raise self._taken(model_id)
            return self._save(model, model_id, metadata)
        except BaseException:
            drop_path(self.spark, claim)
            raise

    @staticmethod
    def _taken(model_id: str) -> ValueError:
        return ValueError(f"model {model_id!r} already exists; pass overwrite=True to replace it")

    def _claim(self, model_id: str) -> str:
        """A file that one writer only can create for a new id, and again after each deletion of the id.

        A driver that dies between its claim and its event leaves the claim; the id can then be saved with ``overwrite=True``.
        """
        own = self.events().filter(F.col("model_id") == model_id)
        newest = F.max_by(F.struct("event", "event_id"), F.struct("created", "event_id"))
        last = own.agg(newest.alias("e")).first()["e"]
        if last is not None and last["event"] == "save":
            raise self._taken(model_id)
        claim = f"{self.path}/claims/{hashlib.sha256(model_id.encode()).hexdigest()}/{'first' if last is None else last['event_id']}"
        if not create_exclusively(self.spark, claim):
            raise self._taken(model_id)
        return claim

    def _save(self, model: PipelineModel, model_id: str, metadata: dict[str, Any] | None) -> str:
        artifact = f"{self.path}/artifacts/{model_id}/{uuid.uuid4().hex}"
        model.write().save(artifact)
        row = (
            model_id,
            "save",
            datetime.now(timezone.utc),
            artifact,
            type(model).__name__,
            folder_size(self.spark, artifact),
            [type(s).__name__ for s in model.stages],
            model_labels(model),
            {k: v if isinstance(v, str) else json.dumps(v, default=str) for k, v in (metadata or {}).items()},
        )
        self._append(self.spark.createDataFrame([row], EVENT_COLUMNS).coalesce(1))
        return artifact

    def info(self, model_id: str) -> DataFrame:
        """The model's registry row with its newest overall test metrics; unknown ids raise."""
        found = ranking.current_models(self.events().filter(F.col("model_id") == model_id))
        if found.isEmpty():
            raise ModelNotFound(f"model {model_id!r} not found; available: {self.list_models()}")
        own = self.metrics.rows().filter(F.col("model_id") == model_id)
        rated = ranking.compare_models(ranking.metrics_since_delete(own, self.events()))
        return found.join(rated.drop("timestamp"), "model_id", "left")

    def load_model(self, model_id: str) -> PipelineModel:
        return PipelineModel.load(self.info(model_id).first()["artifact"])

    def list_models(self) -> list[str]:
        return [r["model_id"] for r in self.current().select("model_id").orderBy("model_id").collect()]

    def summary(self) -> DataFrame:
        return ranking.models_summary(self.current())

    def latest_model_id(self) -> str | None:
        return ranking.latest_model(self.current()).first()["model_id"]

    def load_latest_model(self) -> PipelineModel | None:
        model_id = self.latest_model_id()
        return None if model_id is None else self.load_model(model_id)

    def best_model_id(self, primary: str = "f1_score") -> str | None:
        """Best by metric among the models that still exist."""
        rows = ranking.metrics_of_known(self.metrics.rows(), self.current(), self.events())
        return ranking.best_model(ranking.compare_models(rows, primary), primary).first()["model_id"]

    def load_best_model(self, primary: str = "f1_score") -> PipelineModel | None:
        model_id = self.best_model_id(primary)
        return None if model_id is None else self.load_model(model_id)

    def serving_choice(self, primary: str = "f1_score") -> DataFrame:
        return ranking.serving_choice(self.current(), self.metrics.rows(), primary, self.events())

    def load_for_serving(self, primary: str = "f1_score") -> tuple[str | None, PipelineModel | None]:
        """The best model by metric, else the newest one, else nothing."""
        model_id = self.serving_choice(primary).first()["model_id"]
        return model_id, None if model_id is None else self.load_model(model_id)

    def delete_model(self, model_id: str, delete_metrics: bool = True) -> None:
        """Append a delete event. Its metrics no longer show in comparisons, also after a new save of the id.

        With ``delete_metrics`` they are no longer readable either.
        """
        if not self.exists(model_id):
            raise ModelNotFound(f"model {model_id!r} not found; available: {self.list_models()}")
        self._delete(self.spark.createDataFrame([(model_id,)], "model_id string"))
        if delete_metrics:
            self.metrics.delete(self.metrics.all_rows().filter(F.col("model_id") == model_id).select("entry_id"))

    def compare(self, primary: str = "f1_score") -> DataFrame:
        """The models that exist with their newest test metrics, best first."""
        return ranking.compare_models(ranking.metrics_of_known(self.metrics.rows(), self.current(), self.events()), primary)

    def cleanup(self, keep_latest: int = 10) -> None:
        """Delete all but the newest models."""
        lost = ranking.outdated(self.current(), keep_latest)
        if not lost.isEmpty():
            self._delete(lost)

    def vacuum(self, retention: timedelta = timedelta(days=7)) -> int:
        """Remove the artifact folders that no current model uses, and return their number.

        An artifact goes once it was replaced or deleted longer than ``retention`` ago, so a reader has that long
        to load what it looked up. A folder without any event, as a failed save leaves it, goes when it is that old.
        """
        before = datetime.now(timezone.utc) - retention
        gone = ranking.dead_artifacts(self.events(), F.lit(before)).select("artifact")
        found = list_folders(self.spark, f"{self.path}/artifacts/*/*")
        there = self.spark.createDataFrame(found, "artifact string, modified timestamp")
        registered = self.events().filter("artifact IS NOT NULL").select(folder_name(F.col("artifact")).alias("name"))
        named = there.withColumn("name", folder_name(F.col("artifact")))
        dead = named.join(gone.select(folder_name(F.col("artifact")).alias("name")), "name", "left_semi")
        orphans = named.filter(F.col("modified") < F.lit(before)).join(registered, "name", "left_anti")
        count = 0
        for r in dead.unionByName(orphans).select("artifact").toLocalIterator():
            drop_path(self.spark, r["artifact"])
            count += 1
        return count

    def _delete(self, lost: DataFrame) -> None:
        rows = ranking.tombstones(lost, F.lit(datetime.now(timezone.utc)))
        have = set(rows.columns)
        columns = [c.split(" ", 1) for c in EVENT_COLUMNS.split(", ")]
        full = rows.select(*[F.col(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in columns])
        self._append(full.coalesce(1))

    def export_model(self, model_id: str, target: str, include_metrics: bool = True) -> None:
        """Copy the pipeline, its registry row and its metrics to a folder."""
        info = self.info(model_id)
        row = info.first()
        PipelineModel.load(row["artifact"]).write().overwrite().save(f"{target}/model")
        document = {k: row[k] for k in ("model_id", "created", "model_type", "file_size", "pipeline_steps", "classes", "metadata")}
        write_document(self.spark, document, f"{target}/metadata")
        if include_metrics:
            rows = self.metrics.rows().filter(F.col("model_id") == model_id)
            metric_documents(rows).coalesce(1).write.mode("overwrite").json(f"{target}/metrics")

    def import_model(
        self, model_path: str, model_id: str, metadata_path: str | None = None, overwrite: bool = False
    ) -> str:
        """Register an exported pipeline. It must load; its identity is the one given here."""
        try:
            model = PipelineModel.load(model_path)
        except Exception as e:
            raise ValueError(f"no readable model at {model_path}: {e}") from e
        metadata: dict[str, str] = {}
        if metadata_path:
            row = self.spark.read.schema("metadata map<string,string>").json(metadata_path).first()
            metadata = (row and row["metadata"]) or {}
        return self.save_model(model, model_id, metadata, overwrite)


def folder_name(path: Column) -> Column:
    """The last part of a path; artifact folders have names of their own."""
    return F.substring_index(path, "/", -1)


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder; only the file listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length").alias("n")).first()["n"] or 0
