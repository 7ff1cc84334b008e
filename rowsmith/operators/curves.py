"""Average precision, and ROC AUC over pairs of classes, without sorting all rows in one task.

As for AUC, equal scores collapse before anything is shuffled and scores are cut into ranges. Precision is a ratio of running
counts, so each range first learns how many rows of either kind lie above it.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.operators.auc import _range_edges, grouped_auc
from rowsmith.operators.clean import quote


def grouped_average_precision(scored: DataFrame) -> DataFrame:
    """``grp, average_precision, positives`` from rows ``(grp, score, hit)``.

    Scores are thresholds from the highest down; rows of one score pass together. The value is null where a group has
    no positives, or a row without a score.
    """
    known = F.col("score").isNotNull() & ~F.isnan("score")
    unscored = scored.groupBy("grp").agg(F.count_if(~known).alias("unscored"), F.count_if("hit").alias("positives"))
    scored = scored.filter(known)
    counted = scored.groupBy("grp", "score").agg(F.count_if("hit").alias("pos"), F.count("*").alias("n"))
    edges = _range_edges(scored)
    if edges:
        cut = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol="score", outputCol="part")
        counted = cut.transform(counted)
    else:
        counted = counted.withColumn("part", F.lit(0.0))
    above = W.partitionBy("grp").orderBy(F.col("part").desc()).rowsBetween(W.unboundedPreceding, -1)
    parts = counted.groupBy("grp", "part").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    zero = F.lit(0)
    before = parts.select("grp", "part", F.coalesce(F.sum("pos").over(above), zero).alias("pos_above"), F.coalesce(F.sum("n").over(above), zero).alias("n_above"))
    within = W.partitionBy("grp", "part").orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, 0)
    running = counted.withColumn("pos_here", F.sum("pos").over(within)).withColumn("n_here", F.sum("n").over(within)).join(before, ["grp", "part"])
    precision = (F.col("pos_above") + F.col("pos_here")) / (F.col("n_above") + F.col("n_here"))
    totals = running.groupBy("grp").agg(F.try_divide(F.sum(F.col("pos") * precision), F.sum("pos")).alias("average_precision"))
    return unscored.join(totals, "grp", "left").select("grp", F.when(F.col("unscored") == 0, F.col("average_precision")).alias("average_precision"), "positives")


def binary_average_precision(df: DataFrame, y_true: str, score: Column, positive: str) -> DataFrame:
    """One row: average precision of ``score`` for the label ``positive``."""
    hit = F.col(quote(y_true)).cast("string") == F.lit(str(positive))
    rows = df.select(F.lit("all").alias("grp"), score.cast("double").alias("score"), hit.alias("hit")).filter(F.col("hit").isNotNull())
    return grouped_average_precision(rows).drop("grp")


def _class_scores(df: DataFrame, y_true: str, proba: str) -> DataFrame:
    label = F.col(quote(y_true)).cast("string")
    rows = df.filter(label.isNotNull()).select(label.alias("truth"), F.explode(F.col(quote(proba))).alias("label", "score"))
    return rows.withColumn("score", F.col("score").cast("double"))


def average_precision_per_class(df: DataFrame, y_true: str, proba: str) -> DataFrame:
    """``label, average_precision, positives`` of each class against the rest from a map column ``label -> probability``."""
    rows = _class_scores(df, y_true, proba).select(F.col("label").alias("grp"), "score", (F.col("truth") == F.col("label")).alias("hit"))
    return grouped_average_precision(rows).withColumnRenamed("grp", "label")


def ovo_auc_per_pair(df: DataFrame, y_true: str, proba: str) -> DataFrame:
    """``a, b, roc_auc, support`` of each pair of classes, among the rows of both: the mean of the AUC of either class's score.

    ``support`` counts the rows of the pair. A pair of which one class has no rows is undefined.
    """
    rows = df.filter(F.col(quote(y_true)).isNotNull()).select(F.col(quote(y_true)).cast("string").alias("truth"), F.col(quote(proba)).alias("p"))
    # A row meets every other class, with its own class's score and with the other's.
    met = rows.select("truth", "p", F.explode(F.array_except(F.map_keys("p"), F.array("truth"))).alias("other"))
    a, b = F.least("truth", "other"), F.greatest("truth", "other")
    each = met.select("truth", "p", F.explode(F.array(F.struct(a.alias("a"), b.alias("b"), a.alias("of")), F.struct(a.alias("a"), b.alias("b"), b.alias("of")))).alias("grp"))
    scored = each.select("grp", F.col("p")[F.col("grp.of")].cast("double").alias("score"), (F.col("truth") == F.col("grp.of")).alias("hit"))
    halves = grouped_auc(scored)
    whole = F.when(F.count("roc_auc") == 2, F.avg("roc_auc")).alias("roc_auc")
    return halves.groupBy("grp.a", "grp.b").agg(whole, F.max(F.col("support") + F.col("negatives")).alias("support"))


def ovo_auc(df: DataFrame, y_true: str, proba: str, average: str = "macro") -> float | None:
    """The mean over pairs of classes, evenly or by the rows of each pair; None if a pair is undefined."""
    weight = F.col("support").cast("double") if average == "weighted" else F.lit(1.0)
    value = F.sum(F.col("roc_auc") * weight) / F.sum(weight)
    return ovo_auc_per_pair(df, y_true, proba).agg(F.when(F.count_if(F.col("roc_auc").isNull()) == 0, value).alias("v")).first()["v"]


def average_precision(df: DataFrame, y_true: str, proba: str) -> float | None:
    """The mean over classes; None if a class is undefined."""
    classes = average_precision_per_class(df, y_true, proba)
    return classes.agg(F.when(F.count_if(F.col("average_precision").isNull()) == 0, F.avg("average_precision")).alias("v")).first()["v"]
