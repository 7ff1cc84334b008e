"""Classification and regression metrics from distributed aggregates.

The predictions are read once and collapse, on the map side, to one row per pair of labels.
Every label metric is then arithmetic on that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.expressions import ratio_or_zero
from rowsmith.operators.clean import quote

SCORES = ("precision", "recall", "f1_score")
# Labels of a full matrix, and different label pairs that are collected for a document.
MAX_CLASSES, MAX_PAIRS = 10_000, 1_000_000


# The predicted label of rows that a model gave no prediction for: never right.
UNSCORED = "(unscored)"


def label_pairs(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Occurring pairs ``(y_true, y_pred, n)``.

    Rows without truth are left out, there is nothing to compare them with. Rows without a prediction
    count as wrong, under the predicted label ``UNSCORED``.
    """
    t, p = F.col(quote(y_true)).cast("string"), F.col(quote(y_pred)).cast("string")
    return (
        df.filter(t.isNotNull())
        .select(t.alias("y_true"), F.coalesce(p, F.lit(UNSCORED)).alias("y_pred"))
        .groupBy("y_true", "y_pred")
        .agg(F.count("*").alias("n"))
    )


def confusion_matrix(df: DataFrame, y_true: str, y_pred: str, max_classes: int = MAX_CLASSES) -> DataFrame:
    """The full matrix over the union of labels, zero cells included; at most ``max_classes`` squared cells."""
    pairs = label_pairs(df, y_true, y_pred)
    labels = pairs.select(F.explode(F.array("y_true", "y_pred")).alias("label")).distinct()
    names = [r["label"] for r in labels.limit(max_classes + 1).collect()]
    if len(names) > max_classes:
        raise ValueError(f"more than {max_classes} labels: their full matrix would be too large")
    every = F.array(*map(F.lit, sorted(names))) if names else F.array().cast("array<string>")
    rows = labels.select(F.col("label").alias("y_true"), F.explode(every).alias("y_pred"))
    return rows.join(pairs, ["y_true", "y_pred"], "left").na.fill(0, ["n"])


def collected_pairs(pairs: DataFrame, max_pairs: int = MAX_PAIRS) -> list[tuple[str, str, int]]:
    """Counted label pairs on the driver; beyond ``max_pairs`` of them it raises."""
    rows = pairs.limit(max_pairs + 1).collect()
    if len(rows) > max_pairs:
        raise ValueError(f"more than {max_pairs} different pairs of labels: use the table operators instead of one document")
    return [(r["y_true"], r["y_pred"], r["n"]) for r in rows]


def label_counts(pairs: list[tuple[str, str, int]]) -> tuple[dict[str, int], dict[str, int], dict[str, int]]:
    """Hits, true rows and predicted rows of every label, in one pass over counted pairs."""
    labels = sorted({x for t, p, _ in pairs for x in (t, p)})
    hits, truth, guess = (dict.fromkeys(labels, 0) for _ in range(3))
    for t, p, n in pairs:
        truth[t] += n
        guess[p] += n
        if t == p:
            hits[t] += n
    return hits, truth, guess


def confusion_array(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """The matrix as one row: ``labels`` and ``matrix`` as an array of rows."""
    line = (
        confusion_matrix(df, y_true, y_pred)
        .groupBy("y_true")
        .agg(F.array_sort(F.collect_list(F.struct("y_pred", "n"))).alias("cells"))
        .select(F.struct("y_true", F.col("cells.n").alias("n")).alias("line"))
    )
    return line.agg(F.array_sort(F.collect_list("line")).alias("lines")).select(
        F.col("lines.y_true").alias("labels"), F.col("lines.n").alias("matrix")
    )


def _label_totals(pairs: DataFrame) -> DataFrame:
    """Per label: hits, true rows (support) and predicted rows."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), hit.alias("tp"), F.col("n").alias("t"), zero.alias("p")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("tp"), zero.alias("t"), F.col("n").alias("p")),
    )
    return (
        pairs.select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("tp").alias("tp"), F.sum("t").alias("support"), F.sum("p").alias("predicted"))
    )


def _scores(tp: Column, support: Column, predicted: Column) -> dict[str, Column]:
    return {
        "precision": ratio_or_zero(tp, predicted),
        "recall": ratio_or_zero(tp, support),
        "f1_score": ratio_or_zero(2 * tp, predicted + support),
    }


def per_class_metrics(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Precision, recall, F1 and support of every label; 0/0 counts as 0."""
    totals = _label_totals(label_pairs(df, y_true, y_pred))
    scores = _scores(F.col("tp"), F.col("support"), F.col("predicted"))
    return totals.withColumns(scores).select("label", *SCORES, "support", "tp", "predicted")


def averages_row(per_class: DataFrame) -> DataFrame:
    """One row with accuracy and the weighted, macro and micro averages."""
    n = F.sum("support")
    out = [
        n.alias("total_samples"),
        F.count("*").alias("num_classes"),
        ratio_or_zero(F.sum("tp"), n).alias("accuracy"),
    ]
    for s in SCORES:
        out.append(ratio_or_zero(F.sum(F.col(s) * F.col("support")), n).alias(f"weighted_{s}"))
        out.append(F.avg(s).alias(f"macro_{s}"))
    # Balanced accuracy leaves out labels that never occur as truth.
    out.append(F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"))
    micro = _scores(F.sum("tp"), n, F.sum("predicted"))
    out += [c.alias(f"micro_{s}") for s, c in micro.items()]
    return per_class.agg(*out)


def overall_metrics(df: DataFrame, y_true: str, y_pred: str, average: str = "weighted") -> DataFrame:
    """Accuracy with precision, recall and F1 under one averaging rule, plus counts."""
    if average not in ("weighted", "macro", "micro"):
        raise ValueError(f"unknown average {average!r}")
    row = averages_row(per_class_metrics(df, y_true, y_pred))
    return row.select(
        "accuracy",
        *[F.col(f"{average}_{s}").alias(s) for s in SCORES],
        "total_samples",
        "num_classes",
    )


def averages(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """Long table ``(average, precision, recall, f1_score)`` for all averaging rules."""
    row = averages_row(per_class_metrics(df, y_true, y_pred))
    entries = [
        F.struct(F.lit(a).alias("average"), *[F.col(f"{a}_{s}").alias(s) for s in SCORES])
        for a in ("weighted", "macro", "micro")
    ]
    return row.select(F.inline(F.array(*entries)))


def report_from_pairs(pairs: DataFrame) -> DataFrame:
    """Classification report: one row per label, then accuracy, macro and weighted averages.

    ``rollup`` yields the label rows and the total row from the same small shuffle.
    """
    totals = _label_totals(pairs)
    scored = totals.withColumns(_scores(F.col("tp"), F.col("support"), F.col("predicted")))
    n = F.sum("support")
    rolled = scored.rollup("label").agg(
        F.grouping_id().alias("level"),
        n.alias("support"),
        ratio_or_zero(F.sum("tp"), n).alias("accuracy"),
        *[F.avg(s).alias(f"macro_{s}") for s in SCORES],
        *[ratio_or_zero(F.sum(F.col(s) * F.col("support")), n).alias(f"weighted_{s}") for s in SCORES],
    )

    def line(scope: str, name: Column, cells: list[Column]) -> Column:
        return F.struct(
            F.lit(scope).alias("scope"),
            name.alias("label"),
            *[c.alias(s) for s, c in zip(SCORES, cells)],
            F.col("support").alias("support"),
        )

    per_label = F.array(line("class", F.col("label"), [F.col(f"macro_{s}") for s in SCORES]))
    summary = F.array(
        line("accuracy", F.lit("accuracy"), [F.col("accuracy")] * 3),
        line("macro", F.lit("macro avg"), [F.col(f"macro_{s}") for s in SCORES]),
        line("weighted", F.lit("weighted avg"), [F.col(f"weighted_{s}") for s in SCORES]),
    )
    return rolled.select(F.inline(F.when(F.col("level") == 0, per_label).otherwise(summary)))


def classification_report(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    return report_from_pairs(label_pairs(df, y_true, y_pred))


def regression_metrics(df: DataFrame, y_true: str, y_pred: str) -> DataFrame:
    """MAE, MSE, RMSE, R² and row count in one aggregate.

    Rows without truth are left out. A row without a prediction has no error, so it fails the job.
    """
    t, p = F.col(quote(y_true)).cast("double"), F.col(quote(y_pred)).cast("double")
    stop = F.raise_error(F.lit("a row with a true value has no prediction")).cast("double")
    pair = df.filter(t.isNotNull()).select(t.alias("t"), F.coalesce(p, stop).alias("p"))
    d = F.col("t") - F.col("p")
    sums = pair.agg(
        F.avg(F.abs(d)).alias("mae"),
        F.avg(d * d).alias("mse"),
        F.var_pop("t").alias("spread"),
        F.count("*").alias("total_samples"),
    )
    # A constant truth has R² 1 for exact predictions and 0 otherwise.
    flat = F.when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(F.col("total_samples") < 2, F.lit(None).cast("double")).otherwise(
        F.when(F.col("spread") == 0, flat).otherwise(1 - F.col("mse") / F.col("spread"))
    )
    return sums.select("mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"), "total_samples")


def evaluate(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    proba: str | None = None,
    average: str = "weighted",
) -> dict:
    """All metrics as one nested document. The pairs of labels are one aggregate; AUC reads the predictions
    several times more, so hand in a written table where scoring them is costly.

    What reaches the driver is one row per pair of labels.
    """
    from rowsmith.operators.auc import roc_auc

    pairs = collected_pairs(label_pairs(df, y_true, y_pred))
    doc = metrics_document(pairs, average)
    if proba is not None:
        doc["roc_auc"] = roc_auc(df, y_true, proba, labels=doc["classes"], average=average)
    return doc


def metrics_document(pairs: list[tuple[str, str, int]], average: str = "weighted") -> dict:
    """The nested document for counted label pairs."""
    hits, support, guessed = label_counts(pairs)
    classes = list(hits)
    total = sum(n for *_, n in pairs)

    def share(part: float, whole: float) -> float:
        return part / whole if whole else 0.0

    per_class = {}
    for c in classes:
        per_class[c] = {
            "precision": share(hits[c], guessed[c]),
            "recall": share(hits[c], support[c]),
            "f1_score": share(2 * hits[c], guessed[c] + support[c]),
        }
    accuracy = share(sum(hits.values()), total)
    micro = dict.fromkeys(SCORES, accuracy)
    macro = {s: share(sum(m[s] for m in per_class.values()), len(classes)) for s in SCORES}
    weighted = {s: share(sum(per_class[c][s] * support[c] for c in classes), total) for s in SCORES}
    chosen = {"weighted": weighted, "macro": macro, "micro": micro}[average]
    cells = {(t, p): n for t, p, n in pairs}
    lines = {c: {**per_class[c], "support": support[c]} for c in classes}
    recalls = [per_class[c]["recall"] for c in classes if support[c]]
    return {
        "accuracy": accuracy,
        **chosen,
        "balanced_accuracy": share(sum(recalls), len(recalls)),
        "per_class": per_class,
        "confusion_matrix": {
            "labels": classes,
            "matrix": [[cells.get((t, p), 0) for p in classes] for t in classes],
        },
        "classification_report": {
            **lines,
            "accuracy": accuracy,
            "macro avg": {**macro, "support": total},
            "weighted avg": {**weighted, "support": total},
        },
        "support": support,
        "total_samples": total,
        "num_classes": len(classes),
        "classes": classes,
    }


def matthews(pairs: list[tuple[str, str, int]]) -> float:
    """Correlation of truth and prediction over counted label pairs; 0 where it is undefined."""
    right, truth, guess = label_counts(pairs)
    total = sum(n for *_, n in pairs)
    cov = sum(right.values()) * total - sum(truth[c] * guess[c] for c in right)
    spread = (total**2 - sum(n * n for n in truth.values())) * (total**2 - sum(n * n for n in guess.values()))
    return cov / spread**0.5 if spread else 0.0


def jaccard(pairs: list[tuple[str, str, int]], average: str) -> float:
    """Hits over the union of true and predicted rows, per label and averaged."""
    hit, truth, guess = label_counts(pairs)
    labels = list(hit)
    union = {c: truth[c] + guess[c] - hit[c] for c in labels}
    if average == "micro":
        return sum(hit.values()) / sum(union.values()) if labels else 0.0
    weight = truth if average == "weighted" else dict.fromkeys(labels, 1)
    total = sum(weight.values())
    return sum(weight[c] * hit[c] / union[c] for c in labels) / total if total else 0.0


def log_loss(df: DataFrame, y_true: str, proba: str) -> float:
    """Mean negative log probability of the true label from a probability map column."""
    label = F.col(quote(y_true)).cast("string")
    tiny = F.lit(2.220446049250313e-16)
    p = F.coalesce(F.try_element_at(F.col(quote(proba)), label), F.lit(0.0))
    kept = df.filter(label.isNotNull())
    return kept.agg(F.avg(-F.log(F.least(F.greatest(p, tiny), 1 - tiny))).alias("loss")).first()["loss"]


AVERAGED = {"f1": "f1_score", "precision": "precision", "recall": "recall"}


def score_value(
    df: DataFrame, y_true: str, y_pred: str, scoring: str = "accuracy", proba: str | None = None
) -> float:
    """One number for tuning, under the usual scorer names; higher is better."""
    if scoring in ("average_precision", "roc_auc_ovo", "roc_auc_ovo_weighted"):
        if proba is None:
            raise ValueError(f"scoring {scoring!r} needs a classifier with probabilities")
        from rowsmith.operators import curves

        if scoring == "average_precision":
            value = curves.average_precision(df, y_true, proba)
        else:
            value = curves.ovo_auc(df, y_true, proba, "weighted" if scoring.endswith("weighted") else "macro")
        return float("nan") if value is None else value
    if scoring in ("roc_auc", "roc_auc_ovr", "roc_auc_ovr_weighted", "neg_log_loss"):
        if proba is None:
            raise ValueError(f"scoring {scoring!r} needs a classifier with probabilities")
        if scoring == "neg_log_loss":
            return -log_loss(df, y_true, proba)
        from rowsmith.operators.auc import roc_auc

        average = "weighted" if scoring.endswith("weighted") else "macro"
        value = roc_auc(df, y_true, proba, average=average)
        return float("nan") if value is None else value
    check_label_scoring(scoring)
    return score_pairs([(r["y_true"], r["y_pred"], r["n"]) for r in label_pairs(df, y_true, y_pred).collect()], scoring)


def check_label_scoring(scoring: str) -> None:
    """Raises unless the scorer needs only labels and predicted labels."""
    name, _, average = scoring.partition("_")
    by_average = name in (*AVERAGED, "jaccard") and average in ("macro", "micro", "weighted")
    if not by_average and scoring not in ("accuracy", "balanced_accuracy", "matthews_corrcoef"):
        raise ValueError(f"unknown scoring {scoring!r}")


def score_pairs(pairs: list[tuple[str, str, int]], scoring: str) -> float:
    """The score of counted pairs of label and predicted label."""
    check_label_scoring(scoring)
    name, _, average = scoring.partition("_")
    if scoring == "matthews_corrcoef":
        return matthews(pairs)
    if name == "jaccard":
        return jaccard(pairs, average)
    if name in AVERAGED and average:
        return metrics_document(pairs, average)[AVERAGED[name]]
    return metrics_document(pairs)[scoring]
