"""Counts that describe a clean table. Each is one map-side combined aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.clean import quote
from rowsmith.spec import TableSpec


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per label, most frequent first."""
    return (
        df.filter(F.col(quote(target)).isNotNull())
        .groupBy(F.col(quote(target)).alias("label"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "label")
    )


def row_summary(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Total rows, rows with a target and feature counts."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count(quote(spec.target.name)).alias("rows_with_target"),
        F.lit(len(spec.numeric)).alias("numeric_features"),
        F.lit(len(spec.categorical)).alias("categorical_features"),
        F.lit(len(spec.features)).alias("total_features"),
    )


def missing_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Features with missing values among rows that have a target; one pass for all features."""
    present = [f for f in spec.features if f in df.columns]
    wide = df.filter(F.col(quote(spec.target.name)).isNotNull()).agg(
        *[F.count_if(F.col(quote(f)).isNull()).alias(f"m{i}") for i, f in enumerate(present)]
    )
    entries = [
        F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("missing"))
        for i, f in enumerate(present)
    ]
    return wide.select(F.inline(F.array(*entries))).filter("missing > 0")


def distinct_labels(df: DataFrame, *columns: str) -> DataFrame:
    """Sorted union of the values of one or more label columns."""
    parts = F.array(*[F.col(quote(c)).cast("string") for c in columns])
    return (
        df.select(F.explode(parts).alias("label"))
        .filter(F.col("label").isNotNull())
        .distinct()
        .orderBy("label")
    )
