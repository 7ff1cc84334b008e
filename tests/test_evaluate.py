import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowsmith.operators import auc as U
from rowsmith.operators import evaluate as E
from rowsmith.operators.vote import assemble_scores, soft_vote

# Counts and results of a published run, for three classes.
LABELS = ["Adelie", "Chinstrap", "Gentoo"]
TRAIN = [[122, 0, 0], [1, 53, 0], [0, 0, 99]]
TEST = [[30, 0, 0], [0, 14, 0], [0, 0, 25]]


def expand(spark, matrix, labels=LABELS):
    rows = [(t, p) for t, line in zip(labels, matrix) for p, n in zip(labels, line) for _ in range(n)]
    return spark.createDataFrame(rows, "t string, p string").repartition(5)


def test_published_training_metrics(spark):
    df = expand(spark, TRAIN)
    doc = E.evaluate(df, "t", "p")
    assert doc["accuracy"] == pytest.approx(0.9963636363636363, abs=1e-15)
    assert doc["precision"] == pytest.approx(0.9963932002956393, abs=1e-14)
    assert doc["recall"] == pytest.approx(0.9963636363636363, abs=1e-14)
    assert doc["f1_score"] == pytest.approx(0.9963540651604738, abs=1e-14)
    assert doc["confusion_matrix"] == {"labels": LABELS, "matrix": TRAIN}
    assert doc["support"] == {"Adelie": 122, "Chinstrap": 54, "Gentoo": 99}
    assert doc["per_class"]["Adelie"]["precision"] == pytest.approx(0.991869918699187)
    assert doc["per_class"]["Adelie"]["f1_score"] == pytest.approx(0.9959183673469387)
    assert doc["per_class"]["Chinstrap"]["recall"] == pytest.approx(0.9814814814814815)
    assert doc["per_class"]["Chinstrap"]["f1_score"] == pytest.approx(0.9906542056074766)
    macro = doc["classification_report"]["macro avg"]
    assert macro["precision"] == pytest.approx(0.997289972899729)
    assert macro["recall"] == pytest.approx(0.9938271604938271)
    assert macro["f1_score"] == pytest.approx(0.995524190984805)
    assert (doc["total_samples"], doc["num_classes"], doc["classes"]) == (275, 3, LABELS)


def test_published_test_metrics(spark):
    doc = E.evaluate(expand(spark, TEST), "t", "p", average="macro")
    assert [doc[m] for m in ("accuracy", "precision", "recall", "f1_score")] == [1.0] * 4
    assert doc["support"] == {"Adelie": 30, "Chinstrap": 14, "Gentoo": 25}


@pytest.mark.parametrize("matrix", [TRAIN, TEST, [[3, 2, 0], [1, 4, 5], [0, 0, 7]], [[0, 3, 0], [0, 2, 0], [0, 1, 1]]])
def test_tables_agree_with_document(spark, matrix):
    df = expand(spark, matrix).persist()
    doc = E.evaluate(df, "t", "p")
    overall = E.overall_metrics(df, "t", "p").first()
    for m in ("accuracy", *E.SCORES, "total_samples", "num_classes"):
        assert overall[m] == pytest.approx(doc[m])
    for r in E.per_class_metrics(df, "t", "p").collect():
        assert {s: r[s] for s in E.SCORES} == pytest.approx(doc["per_class"][r["label"]])
    report = {r["label"]: r for r in E.classification_report(df, "t", "p").collect()}
    for name in ("macro avg", "weighted avg"):
        for s in (*E.SCORES, "support"):
            assert report[name][s] == pytest.approx(doc["classification_report"][name][s])
    assert report["accuracy"]["f1_score"] == pytest.approx(doc["accuracy"])
    one = E.confusion_array(df, "t", "p").first()
    assert {"labels": one["labels"], "matrix": one["matrix"]} == doc["confusion_matrix"]
    by_average = {r["average"]: r for r in E.averages(df, "t", "p").collect()}
    assert by_average["micro"]["f1_score"] == pytest.approx(doc["accuracy"])
    df.unpersist()


def test_labels_on_one_side_only(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a"), (None, "a"), ("a", None)], "t string, p string")
    doc = E.evaluate(df, "t", "p")
    assert doc["per_class"]["b"] == {"precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    assert doc["per_class"]["c"] == {"precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    # The row without a prediction counts, as wrong.
    assert doc["total_samples"] == 4
    assert doc["balanced_accuracy"] == pytest.approx(1 / 6)
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in E.confusion_matrix(df, "t", "p").collect()}
    assert len(cells) == 16 and cells["a", E.UNSCORED] == 1 and cells["c", "a"] == 1 and cells["b", "b"] == 0


def test_scores_for_tuning(spark):
    df = expand(spark, TRAIN)
    doc = E.evaluate(df, "t", "p", average="macro")
    assert E.score_value(df, "t", "p") == doc["accuracy"]
    assert E.score_value(df, "t", "p", "f1_macro") == doc["f1_score"]
    assert E.score_value(df, "t", "p", "balanced_accuracy") == pytest.approx(doc["recall"])
    for name in ("magic", "f1_median", "jaccard"):
        with pytest.raises(ValueError, match="unknown scoring"):
            E.score_value(df, "t", "p", name)
    with pytest.raises(ValueError, match="probabilities"):
        E.score_value(df, "t", "p", "roc_auc_ovr")
    with pytest.raises(ValueError, match="unknown average"):
        E.overall_metrics(df, "t", "p", "median")


def test_other_scorers(spark):
    df = expand(spark, [[3, 1], [2, 4]], ["a", "b"])
    assert E.score_value(df, "t", "p", "matthews_corrcoef") == pytest.approx((3 * 4 - 1 * 2) / (4 * 6 * 5 * 5) ** 0.5)
    assert E.score_value(df, "t", "p", "jaccard_macro") == pytest.approx((3 / 6 + 4 / 7) / 2)
    assert E.score_value(df, "t", "p", "jaccard_weighted") == pytest.approx((4 * 3 / 6 + 6 * 4 / 7) / 10)
    assert E.score_value(df, "t", "p", "jaccard_micro") == pytest.approx(7 / 13)
    assert E.matthews([("a", "a", 5)]) == 0.0
    q = spark.createDataFrame([("a", {"a": 0.5, "b": 0.5}), ("b", {"a": 0.75, "b": 0.25})], "t string, q map<string,double>")
    assert E.score_value(q, "t", "t", "neg_log_loss", "q") == pytest.approx(-1.5 * math.log(2))


def brute_auc(rows):
    pos = [s for s, hit in rows if hit]
    neg = [s for s, hit in rows if not hit]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_range", [500_000, 7])
def test_auc_with_ties(spark, monkeypatch, per_range):
    monkeypatch.setattr(U, "SCORES_PER_RANGE", per_range)
    monkeypatch.setattr(U, "GUIDE_ROWS", per_range * 20)
    rng = random.Random(1)
    rows = [(round(rng.gauss(0.3 * (i % 3 == 0), 1), 1), i % 3 == 0) for i in range(400)]
    # One score holds a third of all rows.
    rows += [(0.25, i % 4 == 0) for i in range(200)]
    df = spark.createDataFrame([(s, "yes" if hit else "no") for s, hit in rows], "s double, y string").repartition(4)
    up = U.binary_auc(df, "y", F.col("s"), "yes").first()
    assert up["roc_auc"] == pytest.approx(brute_auc(rows))
    assert up["positives"] + up["negatives"] == len(rows)
    assert U.binary_auc(df, "y", -F.col("s"), "yes").first()["roc_auc"] == pytest.approx(1 - up["roc_auc"])


def proba_rows(spark, n=300):
    rng = random.Random(3)
    rows = []
    for _ in range(n):
        y = rng.choice("abc")
        w = {c: rng.random() + (0.5 if c == y else 0) for c in "abc"}
        total = sum(w.values())
        rows.append((y, max(w, key=w.get), {c: v / total for c, v in w.items()}))
    return rows, spark.createDataFrame(rows, "t string, p string, q map<string,double>")


def test_one_against_the_rest(spark):
    rows, df = proba_rows(spark)
    per_class = {c: brute_auc([(q[c], t == c) for t, _, q in rows]) for c in "abc"}
    support = {c: sum(t == c for t, *_ in rows) for c in "abc"}
    weighted = sum(per_class[c] * support[c] for c in "abc") / len(rows)
    assert U.roc_auc(df, "t", "q") == pytest.approx(weighted)
    assert U.roc_auc(df, "t", "q", average="macro") == pytest.approx(sum(per_class.values()) / 3)
    pooled = brute_auc([(q[c], t == c) for t, _, q in rows for c in "abc"])
    assert U.roc_auc(df, "t", "q", average="micro") == pytest.approx(pooled)
    assert E.evaluate(df, "t", "p", proba="q")["roc_auc"] == pytest.approx(weighted)
    assert E.score_value(df, "t", "p", "roc_auc_ovr", "q") == pytest.approx(sum(per_class.values()) / 3)


def test_undefined_auc_is_none(spark):
    _, df = proba_rows(spark, 30)
    assert U.roc_auc(df.filter("t = 'a'"), "t", "q") is None
    assert U.roc_auc(df.filter("t <> 'c'"), "t", "q", labels=["a", "b", "c"]) is None
    skewed = df.withColumn("q", F.transform_values("q", lambda k, v: v * 2))
    assert U.roc_auc(skewed, "t", "q") is None


def test_binary_auc_uses_the_later_label(spark):
    rows = [("neg", "neg", {"neg": 0.8, "pos": 0.2}), ("pos", "neg", {"neg": 0.6, "pos": 0.4}), ("neg", "pos", {"neg": 0.3, "pos": 0.7})]
    df = spark.createDataFrame(rows, "t string, p string, q map<string,double>")
    assert E.evaluate(df, "t", "p", proba="q")["roc_auc"] == 0.5


def test_regression(spark):
    rng = random.Random(5)
    rows = [(x := rng.gauss(0, 2), x + 0.1 * rng.gauss(0, 1)) for _ in range(100)]
    got = E.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    mean = sum(y for y, _ in rows) / 100
    mse = sum((y - p) ** 2 for y, p in rows) / 100
    assert got["mae"] == pytest.approx(sum(abs(y - p) for y, p in rows) / 100)
    assert (got["mse"], got["rmse"]) == pytest.approx((mse, mse**0.5))
    assert got["r2"] == pytest.approx(1 - mse * 100 / sum((y - mean) ** 2 for y, _ in rows))
    assert got["total_samples"] == 100


@pytest.mark.parametrize(("rows", "r2"), [([(1.0, 1.0), (1.0, 1.0)], 1.0), ([(1.0, 2.0), (1.0, 1.0)], 0.0), ([(1.0, 2.0)], None)])
def test_regression_of_constant_truth(spark, rows, r2):
    assert E.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()["r2"] == r2


def test_soft_vote(spark):
    df = spark.createDataFrame([(1, [0.6, 0.4], [0.1, 0.9]), (2, [0.5, 0.5], [0.5, 0.5])], "k int, a array<double>, b array<double>")
    rows = soft_vote(df, ["a", "b"], ["x", "y"]).orderBy("k").collect()
    assert [(r["prediction"], r["confidence"]) for r in rows] == [("y", pytest.approx(0.65)), ("x", 0.5)]
    heavy = soft_vote(df, ["a", "b"], ["x", "y"], weights=[9, 1]).filter("k = 1").first()
    assert heavy["prediction"] == "x"
    one = assemble_scores(df, "a", ["x", "y"]).filter("k = 1").first()
    assert (one["prediction"], one["confidence"], one["probabilities"]) == ("x", 0.6, {"x": 0.6, "y": 0.4})


def test_rows_without_prediction_or_score(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", None), (None, "a")], "t string, p string")
    doc = E.evaluate(df, "t", "p")
    assert (doc["accuracy"], doc["total_samples"]) == (pytest.approx(1 / 3), 3)
    scored = spark.createDataFrame([("g", 0.9, True), ("g", 0.1, False), ("g", None, True), ("g", float("nan"), False)], "grp string, score double, hit boolean")
    assert [tuple(r) for r in U.grouped_auc(scored).collect()] == [("g", None, 2, 2)]
    numbers = spark.createDataFrame([(1.0, 1.0), (2.0, None)], "t double, p double")
    with pytest.raises(PySparkException, match="no prediction"):
        E.regression_metrics(numbers, "t", "p").collect()


def test_many_classes_are_counted_in_one_pass(spark):
    pairs = [(f"c{i}", f"c{(i + j) % 5000}", 1 + j) for i in range(5000) for j in range(20)]
    hits, truth, guess = E.label_counts(pairs)
    assert sum(truth.values()) == sum(guess.values()) == 5000 * 210 and set(hits.values()) == {1}
    assert E.jaccard(pairs, "micro") == pytest.approx(1 / 419)
    wide = spark.createDataFrame([(f"c{i}", "c0") for i in range(30)], "t string, p string")
    with pytest.raises(ValueError, match="more than 10 labels"):
        E.confusion_matrix(wide, "t", "p", max_classes=10)
    with pytest.raises(ValueError, match="more than 10 different pairs"):
        E.collected_pairs(E.label_pairs(wide, "t", "p"), 10)
