"""Run several experiments over one table and compare them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowsmith.plans.train import TrainResult, register_result, train
from rowsmith.plans.tune import tune
from rowsmith.sources.registry import ModelRegistry
from rowsmith.spec import ExperimentSpec, TableSpec


def run_experiments(
    df: DataFrame, spec: TableSpec, experiments: dict[str, ExperimentSpec], registry: ModelRegistry
) -> dict[str, TrainResult]:
    """Train (or tune, where a grid is given) every experiment and register it under its name."""
    done = {}
    for name, experiment in experiments.items():
        result = (train if experiment.tune is None else tune)(df, spec, experiment)
        register_result(registry, result.model, result.results, name)
        result.model_id = name
        done[name] = result
    return done


def compare_experiments(registry: ModelRegistry, primary: str = "f1_score") -> DataFrame:
    return registry.compare(primary)
