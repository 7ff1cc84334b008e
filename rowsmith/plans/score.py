"""Score new rows with a fitted pipeline."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.clean import check_scoring_input, fail_on_violation, quote, rejected_rows, valid_rows
from rowsmith.operators.vote import score_columns, soft_vote
from rowsmith.plans.classifiers import PROBABILITY
from rowsmith.plans.train import PREDICTED
from rowsmith.sources.registry import model_labels
from rowsmith.spec import TableSpec

RESULTS = ("prediction", "confidence", "probabilities")


def has_probabilities(scored: DataFrame) -> bool:
    return PROBABILITY in scored.columns


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Input columns plus ``prediction``, ``confidence`` and the ``probabilities`` map; the last
    two are null for classifiers without probabilities."""
    scored = model.transform(df)
    if has_probabilities(scored):
        added = score_columns(vector_to_array(PROBABILITY), model_labels(model))
    else:
        added = {
            "confidence": F.lit(None).cast("double"),
            "probabilities": F.lit(None).cast("map<string,double>"),
        }
    added["prediction"] = F.col(PREDICTED)
    kept = [F.col(quote(c)) for c in df.columns if c not in RESULTS]
    return scored.select(*kept, *[added[c].alias(c) for c in RESULTS])


def predict_proba(df: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    """``keep`` columns and one probability column per class."""
    scored = model.transform(df)
    if not has_probabilities(scored):
        raise ValueError("this classifier gives no probabilities")
    cells = vector_to_array(PROBABILITY)
    return scored.select(
        *[F.col(quote(k)) for k in keep], *[cells[i].alias(c) for i, c in enumerate(model_labels(model))]
    )


def score(
    df: DataFrame, model: PipelineModel, spec: TableSpec, mode: str = "strict"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Validate and score. ``strict`` fails on the first bad row, ``drop`` leaves bad rows out,
    ``quarantine`` returns scored rows and rejected rows."""
    checked = check_scoring_input(df, spec)
    if mode == "strict":
        return predict(fail_on_violation(checked), model)
    if mode == "drop":
        return predict(valid_rows(checked), model)
    if mode == "quarantine":
        return predict(valid_rows(checked), model), rejected_rows(checked)
    raise ValueError(f"unknown mode {mode!r}; use strict, drop or quarantine")


def ensemble(
    df: DataFrame, models: list[PipelineModel], keep: list[str], weights: list[float] | None = None
) -> DataFrame:
    """Soft vote of several pipelines over the same classes, row by row without a join."""
    labels = model_labels(models[0])
    if any(model_labels(m) != labels for m in models):
        raise ValueError("the models were trained on different classes")
    rows, columns = df, []
    for i, model in enumerate(models):
        columns.append(f"rs_vote{i}")
        scored = model.transform(rows)
        if not has_probabilities(scored):
            raise ValueError("a soft vote needs classifiers with probabilities")
        kept = [F.col(quote(c)) for c in rows.columns]
        rows = scored.select(*kept, vector_to_array(PROBABILITY).alias(columns[-1]))
    voted = soft_vote(rows, columns, labels, weights)
    return voted.select(*[F.col(quote(k)) for k in keep], "prediction", "confidence", "probabilities")
