"""Average precision and one-against-one AUC against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import auc, curves
from rowsmith.operators.evaluate import score_value

LABELS = ("a", "b", "c")


def made(seed=1, rows=120):
    """Scores with many ties."""
    rng = random.Random(seed)
    return [(rng.choice(LABELS), {c: rng.randint(0, 9) / 10 for c in LABELS}) for _ in range(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "y string, p map<string, double>")


def precision(rows, label):
    positives = sum(y == label for y, _ in rows)
    out, before = 0.0, 0
    for s in sorted({p[label] for _, p in rows}, reverse=True):
        over = [y == label for y, p in rows if p[label] >= s]
        out += (sum(over) - before) / positives * sum(over) / len(over)
        before = sum(over)
    return out


def pair_auc(rows, a, b):
    def one(of):
        hits, rest = [p[of] for y, p in rows if y == of], [p[of] for y, p in rows if y in (a, b) and y != of]
        return sum((x > z) + (x == z) / 2 for x in hits for z in rest) / len(hits) / len(rest)

    return (one(a) + one(b)) / 2


@pytest.mark.parametrize("per_range", [auc.SCORES_PER_RANGE, 20])
def test_against_plain_loops(spark, monkeypatch, per_range):
    monkeypatch.setattr(auc, "SCORES_PER_RANGE", per_range)
    rows = made()
    df = frame(spark, rows)
    got = {r["label"]: r["average_precision"] for r in curves.average_precision_per_class(df, "y", "p").collect()}
    assert got == pytest.approx({c: precision(rows, c) for c in LABELS})
    pairs = {(r["a"], r["b"]): (r["roc_auc"], r["support"]) for r in curves.ovo_auc_per_pair(df, "y", "p").collect()}
    want = {(a, b): pair_auc(rows, a, b) for a, b in (("a", "b"), ("a", "c"), ("b", "c"))}
    assert {k: v for k, (v, _) in pairs.items()} == pytest.approx(want)
    sizes = {k: sum(y in k for y, _ in rows) for k in want}
    assert {k: n for k, (_, n) in pairs.items()} == sizes
    scored = df.withColumn("pred", F.col("y"))
    assert score_value(scored, "y", "pred", "average_precision", "p") == pytest.approx(sum(got.values()) / 3)
    assert score_value(scored, "y", "pred", "roc_auc_ovo", "p") == pytest.approx(sum(want.values()) / 3)
    weighted = sum(want[k] * sizes[k] for k in want) / sum(sizes.values())
    assert score_value(scored, "y", "pred", "roc_auc_ovo_weighted", "p") == pytest.approx(weighted)


def test_undefined(spark):
    """A class without rows, a row without a score, and no rows at all."""
    rows = [(y, p) for y, p in made() if y != "c"]
    df = frame(spark, rows)
    got = {r["label"]: r["average_precision"] for r in curves.average_precision_per_class(df, "y", "p").collect()}
    assert got["c"] is None and got["a"] == pytest.approx(precision(rows, "a"))
    assert curves.average_precision(df, "y", "p") is None and curves.ovo_auc(df, "y", "p") is None
    lost = frame(spark, [*made(), ("a", {"a": None, "b": 0.5, "c": 0.1})])
    got = {r["label"]: r["average_precision"] for r in curves.average_precision_per_class(lost, "y", "p").collect()}
    assert got["a"] is None and got["b"] is not None
    none = frame(spark, [])
    assert curves.average_precision(none, "y", "p") is None and curves.ovo_auc(none, "y", "p") is None
    assert math.isnan(score_value(none.withColumn("pred", F.col("y")), "y", "pred", "average_precision", "p"))


def test_needs_probabilities(spark):
    with pytest.raises(ValueError, match="probabilities"):
        score_value(frame(spark, made()), "y", "y", "average_precision")
