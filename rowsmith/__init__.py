"""Tabular classification as Spark jobs: clean, profile, split, encode, train,
evaluate, register and score tables described by a ``TableSpec``."""

from rowsmith.spec import (
    CategoryField,
    DateYear,
    ExperimentSpec,
    NumericField,
    TableSpec,
    TargetField,
    TuneSpec,
)

__all__ = [
    "CategoryField",
    "DateYear",
    "ExperimentSpec",
    "NumericField",
    "TableSpec",
    "TargetField",
    "TuneSpec",
]
