"""Turn class probabilities into predictions, for one model or for several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_columns(probabilities: Column, labels: list[str]) -> dict[str, Column]:
    """Prediction, confidence and the label map; the earlier label wins ties."""
    names = F.array(*[F.lit(label) for label in labels])
    best = F.array_max(probabilities)
    return {
        "prediction": F.element_at(names, F.array_position(probabilities, best).cast("int")),
        "confidence": best,
        "probabilities": F.map_from_arrays(names, probabilities),
    }


def assemble_scores(df: DataFrame, proba: str, labels: list[str]) -> DataFrame:
    return df.withColumns(score_columns(F.col(proba), labels))


def mean_probabilities(columns: list[str], n_labels: int, weights: list[float] | None = None) -> Column:
    """Weighted mean of several probability arrays, element by element."""
    weights = weights or [1.0] * len(columns)
    total = float(sum(weights))
    cells = []
    for i in range(n_labels):
        parts = [F.col(c)[i] * F.lit(w) for c, w in zip(columns, weights)]
        cells.append(sum(parts[1:], parts[0]) / F.lit(total))
    return F.array(*cells)


def soft_vote(df: DataFrame, columns: list[str], labels: list[str], weights: list[float] | None = None) -> DataFrame:
    """Average the probability arrays of several models on the same row and take the best label.

    The models score the same DataFrame one after another, so no join by key is needed.
    """
    averaged = df.withColumn("voted", mean_probabilities(columns, len(labels), weights))
    return assemble_scores(averaged, "voted", labels).drop("voted")
