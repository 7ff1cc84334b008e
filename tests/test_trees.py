"""Smaller trees out of fitted ones: nested candidates, and minimums of rows for a split."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from rowsmith.plans import trees
from rowsmith.plans.train import train
from rowsmith.plans.tune import cross_validate, expand_grid
from rowsmith.plans.tune import tune as tune_run
from rowsmith.presets import BIRD_SURVEY
from rowsmith.session import Scratch
from rowsmith.spec import ExperimentSpec, TuneSpec


@pytest.fixture(scope="module")
def noisy(spark):
    """Three classes that overlap, so that deep trees go on splitting."""
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 600)
    x = rng.normal(size=(600, 4)) + 0.8 * y[:, None]
    return spark.createDataFrame([(float(a), Vectors.dense(b)) for a, b in zip(y, x)], ["label", "features"]).coalesce(1).cache()


def nodes_of(model, spark):
    with Scratch(spark, "test") as scratch:
        return trees.trees_of(trees._saved(model, scratch)[1])


def said(model, rows):
    found = model.transform(rows).select("prediction", vector_to_array("probability").alias("p")).collect()
    return [(r["prediction"], tuple(round(v, 9) for v in r["p"])) for r in found]


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_a_prefix_of_a_deep_tree_is_the_shallow_tree(spark, noisy, depth):
    deep = DecisionTreeClassifier(maxDepth=9, minInstancesPerNode=2, seed=1).fit(noisy)
    shallow = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=2, seed=1).fit(noisy)
    tree, want = nodes_of(deep, spark)[0], nodes_of(shallow, spark)[0]
    got = trees.Tree.of([dict(zip(("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"), r)) for r in tree.kept(tree.leaves(depth))])
    assert got.left.tolist() == want.left.tolist() and got.right.tolist() == want.right.tolist()
    assert np.array_equal(got.stats, want.stats) and got.predicted.tolist() == want.predicted.tolist()


@pytest.mark.parametrize("kind, options", [(DecisionTreeClassifier, {"maxDepth": 8}), (RandomForestClassifier, {"maxDepth": 6, "numTrees": 4})])
@pytest.mark.parametrize("least", [2, 40, 10_000])
def test_minimum_of_rows_for_a_split(spark, noisy, kind, options, least):
    model = kind(seed=1, **options).fit(noisy)
    smaller = trees.with_least_split(model, least, spark)
    assert type(smaller) is type(model) and smaller.extractParamMap().keys() == model.extractParamMap().keys()
    for tree, whole in zip(nodes_of(smaller, spark), nodes_of(model, spark)):
        inner = tree.left >= 0
        assert (tree.count[inner] >= least).all() and len(tree.left) <= len(whole.left)
        # Every split that may stay does stay, but where both sides say the same.
        stays = whole.leaves(least=least)
        assert len(tree.left) == len(whole.kept(stays))
    if least > 1000:
        assert len(set(said(smaller, noisy))) == 1
    # The rewritten model can be saved and loaded like any other.
    with Scratch(spark, "test") as scratch:
        path = scratch.path("again")
        smaller.write().save(path)
        assert said(type(smaller).load(path), noisy) == said(smaller, noisy)


def test_leaf_by_a_plain_walk(noisy, spark):
    """Counts of nested candidates are those of walking each row down each tree by hand."""
    forest = RandomForestClassifier(maxDepth=6, numTrees=5, seed=2).fit(noisy)
    params = [{"n_estimators": 5, "max_depth": 6}, {"n_estimators": 2, "max_depth": 3}, {"n_estimators": 3, "min_samples_split": 50}, {"n_estimators": 5, "max_depth": None, "min_samples_split": 0.2}]
    got = trees.count_nested(forest, noisy, params, 600, "label")
    whole = nodes_of(forest, spark)
    rows = [(r["label"], r["features"].toArray()) for r in noisy.collect()]
    for p, pairs in zip(params, got):
        depth, least = p.get("max_depth") or 99, trees.least_to_split(p.get("min_samples_split"), 600)

        def ends(tree, i, at=0):
            """A node is a leaf by the bounds, or if both its children are leaves that say the same."""
            if tree.left[i] < 0 or tree.count[i] < least or at >= depth:
                return True
            a, b = tree.left[i], tree.right[i]
            return ends(tree, a, at + 1) and ends(tree, b, at + 1) and tree.predicted[a] == tree.predicted[b]

        want = {}
        for label, x in rows:
            votes = 0
            for tree in whole[: p["n_estimators"]]:
                i, at = 0, 0
                while not ends(tree, i, at):
                    split = tree.rows[i]["split"]
                    i, at = (tree.left[i] if x[split["featureIndex"]] <= split["leftCategoriesOrThreshold"][0] else tree.right[i]), at + 1
                votes = votes + tree.stats[i] / tree.stats[i].sum()
            key = (label, float(np.argmax(votes)))
            want[key] = want.get(key, 0) + 1
        assert {(t, q): n for t, q, n in pairs} == want
    # The first candidate is the forest itself.
    own = {}
    for r in forest.transform(noisy).select("label", "prediction").collect():
        own[r["label"], r["prediction"]] = own.get((r["label"], r["prediction"]), 0) + 1
    assert {(t, q): n for t, q, n in got[0]} == own


GRID = [{"max_depth": [1, 2, 4, None], "min_samples_leaf": [1, 5], "min_samples_split": [2, 30]}]


def test_nested_search_equals_separate_fits(spark, birds, monkeypatch):
    """Exactly the scores of a fit for every candidate, from one fit per fold and other parameters."""
    fits = []
    real = DecisionTreeClassifier.fit

    def counted(self, frame, *more):
        fits.append(self.getMaxDepth())
        return real(self, frame, *more)

    monkeypatch.setattr(DecisionTreeClassifier, "fit", counted)
    experiment = ExperimentSpec("DecisionTreeClassifier", {}, tune=TuneSpec(tuple(GRID), cv=2, scoring="f1_macro", parallelism=2))
    candidates = expand_grid(GRID)
    nested = cross_validate(birds, candidates, BIRD_SURVEY, experiment)
    assert len(fits) == 2 * 2 and len(candidates) == 16
    fits.clear()
    separate = cross_validate(birds, candidates, BIRD_SURVEY, replace(experiment, tune=replace(experiment.tune, nested=False)))
    assert len(fits) == 2 * 16
    assert [c["params"] for c in nested] == [c["params"] for c in separate] == candidates
    assert [c["scores"] for c in nested] == [c["scores"] for c in separate]


def test_families():
    default = {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 15, None], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]}
    candidates = expand_grid([default])
    found = trees.families(candidates)
    assert [rest for rest, _ in found] == [{"min_samples_leaf": n} for n in (1, 2, 4)]
    assert sorted(i for _, places in found for i in places) == list(range(108))
    assert trees.largest([candidates[i] for i in found[0][1]]) == {"max_depth": None, "n_estimators": 200}
    assert trees.largest([{"max_depth": 3}, {"max_depth": 7}]) == {"max_depth": 7}
    assert trees.largest([{"n_estimators": 7}, {}]) == {"max_depth": None, "n_estimators": 100}


def test_least_to_split():
    assert [trees.least_to_split(v, 200) for v in (None, 2, 5, 0.25, 0.001)] == [2, 2, 5, 50, 2]
    with pytest.raises(ValueError, match="below 2"):
        trees.least_to_split(1, 200)


def test_training_and_tuning_keep_the_minimum(spark, birds):
    """The default run's minimum reaches the trained model, and the refit of the best candidate."""
    stump = ExperimentSpec("RandomForestClassifier", {"n_estimators": 5, "max_depth": 5, "min_samples_split": 150})
    model = train(birds, BIRD_SURVEY, stump).model
    forest = next(s for s in model.stages if hasattr(s, "trees"))
    for tree in nodes_of(forest, spark):
        assert (tree.count[tree.left >= 0] >= 150).all()
    chosen = ExperimentSpec("DecisionTreeClassifier", {}, tune=TuneSpec(({"min_samples_split": [10_000, 10], "max_depth": [4]},), cv=2))
    done = tune_run(birds, BIRD_SURVEY, chosen)
    assert done.results["best_params"] == {"min_samples_split": 10, "max_depth": 4}
    assert done.results["test_metrics"]["accuracy"] > 0.9
