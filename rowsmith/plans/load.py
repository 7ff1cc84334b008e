"""From a raw CSV file to clean rows, optionally split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.operators.clean import clean, features_and_target
from rowsmith.operators.split import train_test_split
from rowsmith.sources.files import read_csv
from rowsmith.spec import TableSpec


def load_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    split: bool = False,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
    mode: str = "strict",
) -> DataFrame:
    """Clean rows that have a target; with ``split`` also a column of ``train`` and ``test``."""
    rows = features_and_target(clean(read_csv(spark, path), spec, mode), spec)
    if not split:
        return rows
    return train_test_split(rows, spec.key, spec.target.name, test_size, seed, stratify)
