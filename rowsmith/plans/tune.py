"""Exhaustive grid search with stratified folds.

The preprocessor is fitted once per fold on that fold's training rows, so no statistics leak
from the held-out rows, and all candidates of the fold share the prepared vectors. Candidates of tree
models that differ in depth, forest size or the minimum of a split are parts of one larger model: it is
fitted once for each fold, and one pass over the held-out rows counts what all of them predict.
"""

from __future__ import annotations

import itertools
import math
import statistics
from dataclasses import replace
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.evaluate import check_label_scoring, score_pairs, score_value
from rowsmith.operators.split import stratified_folds
from rowsmith.plans.classifiers import LABEL, PREDICTION, PROBABILITY, fit_classifier_stage
from rowsmith.plans.train import (
    TrainResult,
    describe,
    fit_pipeline,
    model_id_for,
    prepare,
    register_result,
    split_metrics,
    split_parts,
    vectors,
)
from rowsmith.plans.trees import TREES, count_nested, families, largest
from rowsmith.session import Scratch
from rowsmith.sources.registry import ModelRegistry
from rowsmith.spec import ExperimentSpec, TableSpec

PREFIX = "classifier__"
# Scorers that need probabilities: every candidate is fitted by itself.
PROBABILITY_SCORERS = ("roc_auc", "roc_auc_ovr", "roc_auc_ovr_weighted", "roc_auc_ovo", "roc_auc_ovo_weighted", "average_precision", "neg_log_loss")


def expand_grid(grid: list[dict[str, list[Any]]] | tuple[dict[str, list[Any]], ...]) -> list[dict[str, Any]]:
    """All candidates: for each dictionary the cartesian product of its lists, one after another."""
    candidates = []
    for part in grid:
        names = [name.removeprefix(PREFIX) for name in part]
        candidates += [dict(zip(names, values)) for values in itertools.product(*part.values())]
    return candidates


def _fold_scores(
    folds: DataFrame, fold: int, candidates: list[dict[str, Any]], spec: TableSpec, experiment: ExperimentSpec
) -> list[float]:
    """Score of every candidate on one held-out fold."""
    prepared = prepare(folds.filter(F.col("fold") != fold), spec, experiment)
    # A held-out row counts even if its label is absent from the training side: it cannot be right.
    held_out = folds.filter(F.col("fold") == fold)
    fit_rows = prepared.rows.persist(StorageLevel.MEMORY_AND_DISK)
    check_rows = vectors(held_out, prepared.preprocessor, prepared.labels, spec.target.name, unseen="keep")
    check_rows = check_rows.persist(StorageLevel.MEMORY_AND_DISK)
    names = F.array(*[F.lit(str(float(i))) for i in range(len(prepared.labels))])

    whole = [{**experiment.params, **candidate} for candidate in candidates]
    nested = experiment.tune.nested and experiment.model in TREES and experiment.tune.scoring not in PROBABILITY_SCORERS
    groups = families(whole) if nested else [(None, [i]) for i in range(len(whole))]

    def fitted(params: dict[str, Any]):
        estimator = prepared.estimator(experiment.model, params, experiment.seed)
        return fit_classifier_stage(estimator, prepared.weighted(fit_rows, params), experiment.model, params, prepared.size)

    def run(group: tuple[dict[str, Any] | None, list[int]]) -> list[float]:
        rest, places = group
        own = [whole[i] for i in places]
        if rest is None:
            return [separate(params) for params in own]
        check_label_scoring(experiment.tune.scoring)
        counted = count_nested(fitted({**rest, **largest(own)}), check_rows, own, prepared.size, LABEL)
        return [score_pairs([(str(t), str(p), n) for t, p, n in pairs], experiment.tune.scoring) for pairs in counted]

    def separate(params: dict[str, Any]) -> float:
        scored = fitted(params).transform(check_rows)
        proba = None
        if PROBABILITY in scored.columns:
            proba = "rs_proba"
            scored = scored.withColumn(proba, F.map_from_arrays(names, vector_to_array(PROBABILITY)))
        return score_value(scored, LABEL, PREDICTION, experiment.tune.scoring, proba)

    try:
        with ThreadPool(max(1, experiment.tune.parallelism)) as pool:
            by_group = pool.map(inheritable_thread_target(fit_rows.sparkSession)(run), groups)
        scores = {i: score for (_, places), found in zip(groups, by_group) for i, score in zip(places, found)}
        return [scores[i] for i in range(len(whole))]
    finally:
        fit_rows.unpersist()
        check_rows.unpersist()


def cross_validate(
    train_rows: DataFrame, candidates: list[dict[str, Any]], spec: TableSpec, experiment: ExperimentSpec
) -> list[dict[str, Any]]:
    """Mean and population deviation of the fold scores of every candidate, in grid order."""
    cv = experiment.tune.cv
    folds = stratified_folds(train_rows, spec.key, spec.target.name, cv, experiment.seed)
    with Scratch(train_rows.sparkSession, "tune") as scratch:
        # Written by fold: every pass over a training side then skips the held-out files.
        folds = scratch.write(folds, "folds", partition_by=["fold"])
        by_fold = [_fold_scores(folds, i, candidates, spec, experiment) for i in range(cv)]
    table = []
    for params, scores in zip(candidates, zip(*by_fold)):
        table.append(
            {"params": params, "mean": statistics.fmean(scores), "std": statistics.pstdev(scores), "scores": scores}
        )
    return table


def tune(
    df: DataFrame,
    spec: TableSpec,
    experiment: ExperimentSpec,
    registry: ModelRegistry | None = None,
) -> TrainResult:
    """Grid search on the training part, refit of the best candidate, metrics of both parts."""
    if experiment.tune is None:
        raise ValueError("the experiment has no tuning section")
    spec = experiment.restrict(spec)
    parts = split_parts(df, spec, experiment)
    train_rows = parts.filter("split = 'train'")
    table = cross_validate(train_rows, expand_grid(experiment.tune.grid), spec, experiment)
    # On equal means the earlier candidate wins; an undefined mean ranks last.
    best = max(table, key=lambda c: float("-inf") if math.isnan(c["mean"]) else c["mean"])
    chosen = replace(experiment, params={**experiment.params, **best["params"]})
    model = fit_pipeline(train_rows, spec, chosen)
    results = describe(chosen, spec, split_metrics(model, parts, spec)) | {
        "tuning_config": {
            "grid": list(experiment.tune.grid),
            "cv": experiment.tune.cv,
            "scoring": experiment.tune.scoring,
        },
        "best_params": best["params"],
        "best_score": best["mean"],
        "cv_results": {
            "mean_test_scores": [c["mean"] for c in table],
            "std_test_scores": [c["std"] for c in table],
            "params": [c["params"] for c in table],
        },
    }
    done = TrainResult(model, results, parts)
    if registry is not None:
        done.model_id = model_id_for(experiment, "tuned")
        register_result(registry, model, results, done.model_id)
    return done
