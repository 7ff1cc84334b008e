"""Fit a pipeline on the training part, evaluate both parts, register the result."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.clean import quote
from rowsmith.operators.evaluate import metrics_document
from rowsmith.operators.features import FittedPreprocessor, Preprocessor
from rowsmith.operators.split import class_counts, train_test_split
from rowsmith.plans.classifiers import FEATURES, LABEL, PREDICTION, WEIGHT, class_weights, fit_classifier_stage, make_classifier
from rowsmith.session import materialise
from rowsmith.sources.registry import ModelRegistry
from rowsmith.spec import ExperimentSpec, TableSpec

PREDICTED = "rs_predicted"


@dataclass
class Prepared:
    """Training rows as ``(label, features)`` and the native stages that made them."""

    rows: DataFrame
    preprocessor: FittedPreprocessor
    labels: list[str]
    counts: dict[str, int]

    @property
    def size(self) -> int:
        return sum(self.counts.values())

    def estimator(self, name: str, params: dict[str, Any], seed: int) -> Estimator:
        """An unfitted classifier for these rows."""
        weighting = params.get("class_weight")
        by_label = None if weighting is None else class_weights(weighting, self.counts)
        weight = None if by_label is None else sum(by_label[c] * n for c, n in self.counts.items())
        return make_classifier(name, params, seed, self.size, len(self.labels), weight)

    def weighted(self, rows: DataFrame, params: dict[str, Any]) -> DataFrame:
        """``rows`` with the weight of each label, where the parameters ask for weights."""
        weighting = params.get("class_weight")
        if weighting is None:
            return rows
        by_label = class_weights(weighting, self.counts)
        cells = [x for i, c in enumerate(self.labels) for x in (F.lit(float(i)), F.lit(by_label[c]))]
        return rows.withColumn(WEIGHT, F.create_map(*cells)[F.col(LABEL)])


def prepare(train: DataFrame, spec: TableSpec, experiment: ExperimentSpec) -> Prepared:
    """Fit the preprocessor on ``train`` and turn its rows into indexed labels and vectors."""
    target = spec.target.name
    train = train.filter(F.col(quote(target)).isNotNull())
    counts = dict(class_counts(train, F.col(quote(target)).cast("string")))
    fitted = Preprocessor(spec, **experiment.preprocess).fit(train)
    labels = sorted(counts)
    rows = vectors(train, fitted, labels, target)
    return Prepared(rows, fitted, labels, counts)


def vectors(
    df: DataFrame, fitted: FittedPreprocessor, labels: list[str], target: str, unseen: str = "error"
) -> DataFrame:
    """``(label, features)`` of the rows, from fitted state.

    With ``unseen="keep"`` other labels get the index after the last, which no model predicts.
    """
    index = StringIndexerModel.from_labels(labels, inputCol="rs_target", outputCol=LABEL, handleInvalid=unseen)
    rows = df.withColumn("rs_target", F.col(quote(target)).cast("string"))
    return PipelineModel([index, *fitted.stages(FEATURES)]).transform(rows).select(LABEL, FEATURES)


def fit_classifier(prepared: Prepared, experiment: ExperimentSpec) -> PipelineModel:
    """Fit the classifier and return preprocessing, classifier and label naming as one pipeline."""
    estimator = prepared.estimator(experiment.model, experiment.params, experiment.seed)
    rows = prepared.weighted(prepared.rows, experiment.params)
    model = fit_classifier_stage(estimator, rows, experiment.model, experiment.params, prepared.size)
    fitted = model.stages if isinstance(estimator, Pipeline) else [model]
    name = IndexToString(inputCol=PREDICTION, outputCol=PREDICTED, labels=prepared.labels)
    return PipelineModel([*prepared.preprocessor.stages(FEATURES), *fitted, name])


def fit_pipeline(train: DataFrame, spec: TableSpec, experiment: ExperimentSpec) -> PipelineModel:
    return fit_classifier(prepare(train, spec, experiment), experiment)


def split_metrics(model: PipelineModel, parts: DataFrame, spec: TableSpec) -> dict[str, dict]:
    """Metrics of every value of ``split``; all parts are scored and counted in one job."""
    target = spec.target.name
    counted = (
        model.transform(parts)
        .groupBy("split", F.col(quote(target)).cast("string").alias("t"), F.col(PREDICTED).alias("p"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    return {
        split: metrics_document([(r["t"], r["p"], r["n"]) for r in counted if r["split"] == split])
        for split in ("train", "test")
    }


@dataclass
class TrainResult:
    model: PipelineModel
    results: dict[str, Any]
    parts: DataFrame
    model_id: str | None = None


def describe(experiment: ExperimentSpec, spec: TableSpec, metrics: dict[str, dict]) -> dict[str, Any]:
    return {
        "model_name": experiment.model,
        "model_params": experiment.params,
        "data_info": {
            "train_size": metrics["train"]["total_samples"],
            "test_size": metrics["test"]["total_samples"],
            "features": spec.features,
            "target_classes": [c for c, n in metrics["train"]["support"].items() if n],
        },
        "train_metrics": metrics["train"],
        "test_metrics": metrics["test"],
        "seed": experiment.seed,
    }


def model_id_for(experiment: ExperimentSpec, suffix: str = "") -> str:
    return experiment.model.lower() + (f"_{suffix}" if suffix else "")


def register_result(
    registry: ModelRegistry, model: PipelineModel, results: dict[str, Any], model_id: str
) -> None:
    """Save the pipeline with its parameters, and its metrics under the same id."""
    metadata = {k: results[k] for k in ("model_name", "model_params", "best_params") if k in results}
    metadata["features"] = results["data_info"]["features"]
    registry.save_model(model, model_id, metadata)
    registry.metrics.save(results, model_id)


def split_parts(df: DataFrame, spec: TableSpec, experiment: ExperimentSpec) -> DataFrame:
    """Key, features, target and ``split`` of the rows that have a target.

    The rows are written once to the shared folder, because splitting, fitting and evaluating
    read them about ten times: nothing upstream is computed again, and each pass reads only its
    columns. A table that already has a ``split`` column keeps it.
    """
    wanted = [c for c in (*spec.key, *spec.columns, "split") if c in df.columns]
    labelled = df.filter(F.col(quote(spec.target.name)).isNotNull())
    rows = materialise(labelled.select(*[F.col(quote(c)) for c in wanted]), "rows")
    if "split" in wanted:
        return rows
    return train_test_split(
        rows, spec.key, spec.target.name, experiment.test_size, experiment.seed, experiment.stratify
    )


def train(
    df: DataFrame,
    spec: TableSpec,
    experiment: ExperimentSpec,
    registry: ModelRegistry | None = None,
    suffix: str = "",
) -> TrainResult:
    """Split, fit on the training rows, measure both parts and optionally register the model."""
    spec = experiment.restrict(spec)
    parts = split_parts(df, spec, experiment)
    model = fit_pipeline(parts.filter("split = 'train'"), spec, experiment)
    results = describe(experiment, spec, split_metrics(model, parts, spec))
    done = TrainResult(model, results, parts)
    if registry is not None:
        done.model_id = model_id_for(experiment, suffix)
        register_result(registry, model, results, done.model_id)
    return done
