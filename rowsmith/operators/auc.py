"""ROC AUC without sorting all rows in one task.

Equal scores collapse to one row with their positive and negative counts before anything is
shuffled. The scores are cut into value ranges of similar size; each range computes its own part
of the rank sum, and only one total per range is combined at the end.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.operators.clean import quote

SCORES_PER_RANGE = 500_000
# Rows that place the range borders. Any borders give the same result; good ones balance the tasks.
GUIDE_ROWS = 2_000_000


def _range_edges(scored: DataFrame) -> list[float]:
    """Inner borders of the value ranges, from quantiles of a sample of the scores."""
    size = scored.agg(F.count("score").alias("n")).first()["n"]
    ranges = -(-size // SCORES_PER_RANGE)
    if ranges < 2:
        return []
    guide = scored if size <= GUIDE_ROWS else scored.sample(GUIDE_ROWS / size, seed=0)
    steps = [i / ranges for i in range(1, ranges)]
    edges = guide.agg(F.percentile_approx("score", steps, max(1_000, 5 * ranges)).alias("e")).first()["e"]
    return sorted(set(edges or []))


def grouped_auc(scored: DataFrame) -> DataFrame:
    """AUC per group from rows ``(grp, score, hit)``, with ``support`` = number of positives.

    The value is null where a group has only positives or only negatives, or a row without a score.
    """
    known = F.col("score").isNotNull() & ~F.isnan("score")
    unscored = scored.groupBy("grp").agg(F.count_if(~known).alias("unscored"), F.count_if(F.col("hit") & ~known).alias("missed"))
    scored = scored.filter(known)
    counted = (
        scored.groupBy("grp", "score")
        .agg(
            F.count_if(F.col("hit")).cast("double").alias("pos"),
            F.count_if(~F.col("hit")).cast("double").alias("neg"),
        )
    )
    edges = _range_edges(scored)
    if edges:
        cut = Bucketizer(
            splits=[float("-inf"), *edges, float("inf")], inputCol="score", outputCol="part"
        )
        counted = cut.transform(counted)
    else:
        counted = counted.withColumn("part", F.lit(0.0))
    below = W.partitionBy("grp", "part").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0.0))
    parts = (
        counted.withColumn("won", F.col("pos") * (neg_below + F.col("neg") / 2))
        .groupBy("grp", "part")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    earlier = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    neg_before = F.coalesce(F.sum("neg").over(earlier), F.lit(0.0))
    totals = (
        parts.withColumn("won", F.col("won") + F.col("pos") * neg_before)
        .groupBy("grp")
        .agg(
            F.try_divide(F.sum("won"), F.sum("pos") * F.sum("neg")).alias("roc_auc"),
            F.sum("pos").cast("bigint").alias("support"),
            F.sum("neg").cast("bigint").alias("negatives"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return unscored.join(totals, "grp", "left").select(
        "grp",
        F.when(F.col("unscored") == 0, F.col("roc_auc")).alias("roc_auc"),
        (F.coalesce("support", zero) + F.col("missed")).alias("support"),
        (F.coalesce("negatives", zero) + F.col("unscored") - F.col("missed")).alias("negatives"),
    )


def binary_auc(df: DataFrame, y_true: str, score: Column, positive: str) -> DataFrame:
    """One row: AUC of ``score`` for the label ``positive``."""
    rows = df.select(
        F.lit("all").alias("grp"),
        score.cast("double").alias("score"),
        (F.col(quote(y_true)).cast("string") == F.lit(str(positive))).alias("hit"),
    ).filter(F.col("hit").isNotNull())
    return grouped_auc(rows).select("roc_auc", F.col("support").alias("positives"), "negatives")


def ovr_auc_per_class(df: DataFrame, y_true: str, proba: str) -> DataFrame:
    """AUC of each class against the rest from a map column ``label -> probability``."""
    label = F.col(quote(y_true)).cast("string")
    rows = (
        df.filter(label.isNotNull())
        .select(label.alias("truth"), F.explode(F.col(quote(proba))).alias("grp", "score"))
        .select("grp", F.col("score").cast("double").alias("score"), (F.col("truth") == F.col("grp")).alias("hit"))
    )
    return grouped_auc(rows).withColumnRenamed("grp", "label")


def average_auc(average: str = "weighted") -> Column:
    """Aggregate over class AUCs: by prevalence (``weighted``) or evenly (``macro``).

    A class without positives or negatives makes the average undefined.
    """
    weight = F.col("support").cast("double") if average == "weighted" else F.lit(1.0)
    value = F.sum(F.col("roc_auc") * weight) / F.sum(weight)
    return F.when(F.count_if(F.col("roc_auc").isNull()) == 0, value)


def roc_auc(
    df: DataFrame, y_true: str, proba: str, labels: list[str] | None = None, average: str = "weighted"
) -> float | None:
    """The AUC of a probability map column as a number, or None where it is undefined.

    ``labels`` are the classes seen in truth and prediction; with two of them the score of the
    later one is used, otherwise one-vs-rest. Probabilities that do not sum to 1, or that name
    other classes than the truth, give None.
    """
    truth = [
        r["label"]
        for r in df.select(F.col(quote(y_true)).cast("string").alias("label")).na.drop().distinct().collect()
    ]
    classes = sorted(labels or truth)
    p = F.col(quote(proba))
    if len(classes) == 2:
        found = binary_auc(df, y_true, F.try_element_at(p, F.lit(classes[1])), classes[1]).first()
        return found["roc_auc"] if found else None
    total = F.aggregate(F.map_values(p), F.lit(0.0), lambda a, x: a + x)
    bad = (F.abs(total - 1) > 1e-6) | (F.array_sort(F.map_keys(p)) != F.lit(sorted(truth)))
    if len(truth) < 2 or not df.filter(F.col(quote(y_true)).isNotNull() & F.coalesce(bad, F.lit(True))).isEmpty():
        return None
    if average == "micro":
        rows = df.filter(F.col(quote(y_true)).isNotNull()).select(
            F.col(quote(y_true)).cast("string").alias("truth"), F.explode(p).alias("label", "score")
        )
        hit = (F.col("truth") == F.col("label")).alias("hit")
        return grouped_auc(rows.select(F.lit("all").alias("grp"), "score", hit)).first()["roc_auc"]
    per_class = ovr_auc_per_class(df, y_true, proba)
    return per_class.agg(average_auc(average).alias("roc_auc")).first()["roc_auc"]
