import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from rowsmith.plans import classifiers as K
from rowsmith.plans.experiments import compare_experiments, run_experiments
from rowsmith.plans.load import load_table
from rowsmith.plans.score import ensemble, predict, predict_proba, score
from rowsmith.plans.train import fit_pipeline, train
from rowsmith.plans.tune import cross_validate, expand_grid, tune
from rowsmith.presets import BIRD_SURVEY
from rowsmith.sources.registry import ModelRegistry
from rowsmith.sources.files import write_csv
from rowsmith.spec import CategoryField, ExperimentSpec, NumericField, TableSpec, TargetField, TuneSpec
from rowsmith.streaming.scoring import (
    log_predictions,
    prediction_log_stream,
    quarantine_stream,
    read_json_stream,
    score_stream,
)

FOREST = ExperimentSpec("RandomForestClassifier", {"n_estimators": 20, "max_depth": 5, "min_samples_leaf": 2})
LOGISTIC = ExperimentSpec("LogisticRegression", {"max_iter": 50})
TREE = ExperimentSpec("DecisionTreeClassifier", {"max_depth": 4})


def test_unknown_model_and_parameters(spark):
    with pytest.raises(ValueError, match="not supported"):
        K.make_classifier("Oracle", {}, 42, 10, 2)
    with pytest.raises(ValueError, match="without a counterpart.*depth"):
        K.make_classifier("RandomForestClassifier", {"depth": 3}, 42, 10, 2)
    with pytest.raises(ValueError, match="kernel"):
        K.make_classifier("SVC", {"kernel": "rbf"}, 42, 10, 2)
    with pytest.raises(ValueError, match="penalty"):
        K.make_classifier("LogisticRegression", {"penalty": "l7"}, 42, 10, 2)


def test_settings_that_would_be_lost_are_refused(spark):
    for name, params in (
        ("DecisionTreeClassifier", {"splitter": "random"}),
        ("LogisticRegression", {"multi_class": "ovr"}), ("LogisticRegression", {"dual": True}), ("SVC", {"kernel": "poly", "coef0": 1.0}),
    ):
        with pytest.raises(ValueError, match="no counterpart"):
            K.make_classifier(name, params, 42, 10, 2)
        K.make_classifier(name, {**params, "ignore_unmapped": True}, 42, 10, 2)
    with pytest.raises(ValueError, match="deepest"):
        K.make_classifier("DecisionTreeClassifier", {"max_depth": 60}, 42, 10, 2)
    with pytest.raises(ValueError, match="name the kernel"):
        K.make_classifier("SVC", {}, 42, 10, 2)


def test_penalty_follows_the_weights(spark):
    plain = K.make_classifier("LogisticRegression", {"C": 0.5}, 42, 100, 2)
    heavy = K.make_classifier("LogisticRegression", {"C": 0.5, "class_weight": {"a": 3.0}}, 42, 100, 2, 200.0)
    assert (plain.getRegParam(), heavy.getRegParam()) == (0.02, 0.01)


def test_rare_held_out_class_counts_as_wrong(spark):
    """A class that a fold never trains on lowers that fold's score, and weights may differ by candidate."""
    rows = [(i, float(i % 2), "ab"[i % 2]) for i in range(30)] + [(30, 0.5, "c")]
    df = spark.createDataFrame(rows, "k int, x double, y string")
    spec = TableSpec(key=("k",), numeric=(NumericField("x"),), target=TargetField("y"))
    spec_run = ExperimentSpec("DecisionTreeClassifier", {"max_depth": 2}, tune=TuneSpec(grid=({"class_weight": [None, "balanced"]},), cv=3))
    for candidate in cross_validate(df, expand_grid(spec_run.tune.grid), spec, spec_run):
        scores = sorted(candidate["scores"])
        assert scores[0] < 1.0 == scores[1] == scores[2] or scores[0] < 1.0


def test_parameter_mapping(spark):
    forest = K.make_classifier(
        "RandomForestClassifier",
        {"n_estimators": 7, "max_depth": None, "min_samples_split": 5, "min_samples_leaf": 2, "criterion": "log_loss", "n_jobs": -1, "ignore_unmapped": True},
        42, 100, 3,
    )
    got = [forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getImpurity(), forest.getSeed()]
    assert got == [7, 30, 2, "entropy", 42]
    assert forest.getFeatureSubsetStrategy() == "sqrt"
    assert K.make_classifier("RandomForestClassifier", {"random_state": 7}, 42, 100, 3).getSeed() == 7
    lasso = K.make_classifier("LogisticRegression", {"penalty": "l1", "C": 0.5, "solver": "liblinear"}, 42, 100, 3)
    assert (lasso.getRegParam(), lasso.getElasticNetParam(), lasso.getStandardization()) == (0.02, 1.0, False)
    assert K.make_classifier("LogisticRegression", {"penalty": None}, 42, 100, 3).getRegParam() == 0
    margin = K.make_classifier("SVC", {"kernel": "linear", "C": 10, "gamma": "scale", "cache_size": 200}, 42, 100, 3)
    assert isinstance(margin, OneVsRest) and isinstance(margin.getClassifier(), LinearSVC)
    assert margin.getClassifier().getRegParam() == pytest.approx(0.001)


def test_own_classifier(birds):
    K.register_classifier("Plain", lambda params, seed, rows, classes: LogisticRegression(maxIter=params.pop("n")))
    try:
        model = fit_pipeline(birds, BIRD_SURVEY, ExperimentSpec("Plain", {"n": 30}))
        assert predict(birds, model).filter("prediction = species").count() > 200
    finally:
        del K.CLASSIFIERS["Plain"]


def test_grid_expansion():
    grid = [{"n_estimators": [5, 10], "max_depth": [2, 3]}, {"classifier__min_samples_split": [2, 5]}]
    assert expand_grid(grid) == [
        {"n_estimators": 5, "max_depth": 2}, {"n_estimators": 5, "max_depth": 3},
        {"n_estimators": 10, "max_depth": 2}, {"n_estimators": 10, "max_depth": 3},
        {"min_samples_split": 2}, {"min_samples_split": 5},
    ]
    default = {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 15, None], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]}
    assert len(expand_grid([default])) == 108


@pytest.mark.parametrize(
    "experiment",
    [
        FOREST,
        ExperimentSpec("SVC", {"kernel": "poly", "degree": 2, "max_iter": 10}),
        ExperimentSpec("LogisticRegression", {"class_weight": "balanced", "penalty": "l1", "C": 10.0}),
        ExperimentSpec("DecisionTreeClassifier", {"class_weight": {"Gentoo": 2.0}, "max_depth": 4}),
    ],
    ids=lambda e: e.model + "".join(str(v) for v in e.params.values() if isinstance(v, str)),
)
def test_every_classifier_learns(spark, birds, tmp_path, experiment):
    registry = ModelRegistry(spark, str(tmp_path))
    done = train(birds, BIRD_SURVEY, experiment, registry)
    info = done.results["data_info"]
    assert (info["train_size"], info["test_size"]) == (192, 48)
    assert info["target_classes"] == ["Adelie", "Chinstrap", "Gentoo"]
    assert done.results["test_metrics"]["accuracy"] > 0.9
    assert done.model_id == experiment.model.lower()
    # The stored pipeline scores rows without a label, like the one in memory.
    loaded = registry.load_model(done.model_id)
    new = birds.drop("species")
    one = predict(new, done.model).select("row_id", "prediction", "confidence")
    assert one.exceptAll(predict(new, loaded).select(*one.columns)).isEmpty()
    assert registry.best_model_id() == done.model_id


def test_given_split_and_feature_lists(birds):
    parts = birds.withColumn("split", F.when(F.col("row_id") < 60, "test").otherwise("train"))
    experiment = ExperimentSpec.from_dict(
        {"seed": 1, "features": {"numeric_features": ["bill_length_mm", "flipper_length_mm"], "categorical_features": ["island"]},
         "model": {"name": "DecisionTreeClassifier", "params": {"max_depth": 3}}}
    )
    results = train(parts, BIRD_SURVEY, experiment).results
    assert results["data_info"]["test_size"] == 60
    assert results["data_info"]["features"] == ["bill_length_mm", "flipper_length_mm", "island"]


def test_tuning(spark, birds, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    grid = ({"max_depth": [1, 4]}, {"classifier__max_depth": [4]})
    experiment = ExperimentSpec("DecisionTreeClassifier", {}, tune=TuneSpec(grid, cv=3, scoring="f1_macro"))
    done = tune(birds, BIRD_SURVEY, experiment, registry)
    found = done.results["cv_results"]
    assert found["params"] == [{"max_depth": 1}, {"max_depth": 4}, {"max_depth": 4}]
    assert found["mean_test_scores"][1] == found["mean_test_scores"][2] > found["mean_test_scores"][0]
    assert done.results["best_params"] == {"max_depth": 4} and done.results["best_score"] > 0.8
    assert done.results["test_metrics"]["accuracy"] > 0.8
    assert done.model_id == "decisiontreeclassifier_tuned"
    with pytest.raises(ValueError, match="no tuning section"):
        tune(birds, BIRD_SURVEY, TREE)


def test_tuning_by_auc(birds):
    experiment = ExperimentSpec("DecisionTreeClassifier", {}, tune=TuneSpec(({"max_depth": [1, 3]},), cv=2, scoring="roc_auc_ovr"))
    scores = tune(birds, BIRD_SURVEY, experiment).results["cv_results"]["mean_test_scores"]
    assert scores[1] > scores[0] > 0.5


def test_columns_named_like_results(spark, birds):
    """Working columns do not collide with a table that uses the usual names itself."""
    spec = TableSpec(
        key=("row_id",),
        numeric=(NumericField("features"), NumericField("probability")),
        categorical=(CategoryField("rawPrediction"),),
        target=TargetField("label"),
    )
    names = {"bill_length_mm": "features", "flipper_length_mm": "probability", "island": "rawPrediction", "species": "label"}
    rows = birds.withColumnsRenamed(names).withColumn("prediction", F.lit("old"))
    results = train(rows, spec, TREE)
    assert results.results["test_metrics"]["accuracy"] > 0.9
    scored = predict(rows, results.model)
    assert scored.columns.count("prediction") == 1 and scored.filter("prediction = 'old'").isEmpty()


def test_load_table(spark, birds, tmp_path):
    write_csv(birds.withColumnRenamed("bill_length_mm", "Culmen Length (mm)"), str(tmp_path / "raw"))
    rows = load_table(spark, str(tmp_path / "raw"), BIRD_SURVEY)
    assert rows.count() == 240 and rows.filter("sex IS NULL").count() > 0
    parts = load_table(spark, str(tmp_path / "raw"), BIRD_SURVEY, split=True, test_size=0.25)
    assert parts.filter("split = 'test'").count() == 60


def test_scoring_modes(spark, birds):
    model = fit_pipeline(birds, BIRD_SURVEY, FOREST)
    new = birds.drop("species").na.fill({"sex": "MALE", "body_mass_g": 4000.0})
    scored = score(new, model, BIRD_SURVEY)
    row = scored.first()
    assert row["confidence"] == max(row["probabilities"].values())
    assert set(row["probabilities"]) == {"Adelie", "Chinstrap", "Gentoo"}
    assert sum(row["probabilities"].values()) == pytest.approx(1)
    assert scored.count() == 240
    bad = new.withColumn("island", F.when(F.col("row_id") == 7, "Atlantis").otherwise(F.col("island")))
    with pytest.raises(Exception, match="island"):
        score(bad, model, BIRD_SURVEY).collect()
    good, refused = score(bad, model, BIRD_SURVEY, mode="quarantine")
    assert (good.count(), [r["row_id"] for r in refused.collect()]) == (239, [7])
    assert score(bad, model, BIRD_SURVEY, mode="drop").count() == 239
    with pytest.raises(ValueError, match="unknown mode"):
        score(bad, model, BIRD_SURVEY, mode="x")


def test_probabilities(birds):
    table = predict_proba(birds, fit_pipeline(birds, BIRD_SURVEY, LOGISTIC), ["row_id"])
    assert table.columns == ["row_id", "Adelie", "Chinstrap", "Gentoo"]
    assert table.filter("abs(Adelie + Chinstrap + Gentoo - 1) > 1e-9").isEmpty()
    margin = fit_pipeline(birds, BIRD_SURVEY, ExperimentSpec("SVC", {"kernel": "linear", "max_iter": 5}))
    assert K.PROBABILITY not in margin.transform(birds).columns
    with pytest.raises(ValueError, match="no probabilities"):
        predict_proba(birds, margin, ["row_id"])
    assert predict(birds, margin).first()["confidence"] is None


def test_ensemble(birds):
    calibrated = ExperimentSpec("SVC", {"kernel": "linear", "max_iter": 5, "probability": True, "class_weight": "balanced"})
    models = [fit_pipeline(birds, BIRD_SURVEY, e) for e in (FOREST, LOGISTIC, calibrated)]
    voted = ensemble(birds, models, ["row_id", "species"])
    assert voted.filter("prediction = species").count() > 220
    tables = [{r["row_id"]: r for r in predict_proba(birds, m, ["row_id"]).collect()} for m in models]
    row = voted.filter("row_id = 5").first()
    for label in ("Adelie", "Chinstrap", "Gentoo"):
        assert row["probabilities"][label] == pytest.approx(sum(t[5][label] for t in tables) / 3)


def test_experiments(spark, birds, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    done = run_experiments(birds, BIRD_SURVEY, {"forest": FOREST, "tree": TREE}, registry)
    rows = compare_experiments(registry).collect()
    assert {r["model_id"] for r in rows} == set(done) and rows[0]["f1_score"] >= rows[1]["f1_score"]


def test_experiment_from_yaml(tmp_path):
    (tmp_path / "e.yaml").write_text(
        "seed: 7\nfeatures: {test_size: 0.25, stratify: false}\nextra: 1\n"
        "model:\n  name: SVC\n  params: {C: 2}\n  tune: {grid: [{C: [1, 2]}], cv: 3, n_jobs: -1}\n"
    )
    e = ExperimentSpec.from_yaml(str(tmp_path / "e.yaml"))
    assert (e.seed, e.test_size, e.stratify, e.model, e.params) == (7, 0.25, False, "SVC", {"C": 2})
    assert (e.tune.cv, e.tune.scoring, e.tune.grid) == (3, "accuracy", ({"C": [1, 2]},))
    assert ExperimentSpec.from_yaml(str(tmp_path / "none.yaml")) == ExperimentSpec()


def requests(birds, path):
    new = birds.drop("species").na.fill({"sex": "MALE", "body_mass_g": 4000.0})
    new = new.withColumn("bill_depth_mm", F.when(F.col("row_id") % 10 == 3, 500.0).otherwise(F.col("bill_depth_mm")))
    new.repartition(4).write.json(path)
    return new


def test_stream_equals_batch(spark, birds, tmp_path):
    new = requests(birds, str(tmp_path / "in"))
    model = fit_pipeline(birds, BIRD_SURVEY, ExperimentSpec("SVC", {"kernel": "linear", "max_iter": 5}))
    stream = read_json_stream(spark, str(tmp_path / "in"), new.schema, max_files=1)
    score_stream(stream, model, BIRD_SURVEY, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    columns = ["row_id", "prediction"]
    got = spark.read.parquet(str(tmp_path / "out/scored")).select(*columns)
    want, refused = score(new, model, BIRD_SURVEY, mode="quarantine")
    assert got.exceptAll(want.select(*columns)).isEmpty() and got.count() == want.count() == 216
    rejected = spark.read.parquet(str(tmp_path / "out/rejected"))
    assert rejected.count() == refused.count() == 24
    assert rejected.first()["violations"][0]["rule"] == "scoring_range"
    assert rejected.select("batch_id").distinct().count() > 1
    # Starting again on the same checkpoint adds nothing.
    score_stream(stream, model, BIRD_SURVEY, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/scored")).count() == 216


def test_prediction_log(spark, birds, tmp_path):
    new = requests(birds, str(tmp_path / "in"))
    model = fit_pipeline(birds, BIRD_SURVEY, TREE)
    stream = read_json_stream(spark, str(tmp_path / "in"), new.schema)
    prediction_log_stream(stream, model, BIRD_SURVEY, str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    lines = spark.read.json(str(tmp_path / "log"))
    assert lines.count() == 216 and {"timestamp", "input", "prediction", "confidence"} <= set(lines.columns)
    batch = score(new, model, BIRD_SURVEY, mode="drop")
    for _ in range(2):
        log_predictions(batch, str(tmp_path / "batch_log"))
    assert spark.read.json(str(tmp_path / "batch_log")).count() == 432


def test_quarantine_stream(spark, birds, tmp_path):
    dirty = birds.withColumn("island", F.when(F.col("row_id") < 5, "Nowhere").otherwise(F.col("island")))
    dirty.write.json(str(tmp_path / "in"))
    stream = read_json_stream(spark, str(tmp_path / "in"), dirty.schema)
    quarantine_stream(stream, BIRD_SURVEY, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    counts = {r["verdict"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("verdict").count().collect()}
    assert counts == {"valid": 235, "rejected": 5}


def test_pairwise_margins(spark, tmp_path):
    """No line parts the middle class from the other two, but every pair is parted."""
    rows = spark.createDataFrame([(float(10 * (i % 3) + i % 2), float(i % 7), float(i % 3)) for i in range(300)], "x double, z double, rs_label double")
    rows = VectorAssembler(inputCols=["x", "z"], outputCol=K.FEATURES).transform(rows).coalesce(1)
    params = {"kernel": "linear", "max_iter": 10, "multi_class": "ovo"}
    model = K.make_classifier("SVC", params, 1, 300, 3).fit(rows)
    scored = model.transform(rows)
    assert scored.filter(f"{K.PREDICTION} != rs_label").isEmpty()
    assert set(scored.columns) == {*rows.columns, "rawPrediction", K.PREDICTION}
    # Each machine is what its pair alone gives.
    pair = rows.filter("rs_label IN (0, 2)").withColumn("upper", F.expr("CAST(rs_label = 2 AS DOUBLE)"))
    alone = LinearSVC(featuresCol=K.FEATURES, labelCol="upper", regParam=1 / 200, maxIter=10, tol=1e-3, standardization=False).fit(pair)
    assert model.stages[1].coefficients.toArray() == pytest.approx(alone.coefficients.toArray())
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(rows)
    assert again.filter(f"{K.PREDICTION} != rs_label").isEmpty()
    # A class without rows gets no votes; one class alone is always predicted.
    some = K.make_classifier("SVC", params, 1, 200, 3).fit(rows.filter("rs_label != 0")).transform(rows)
    assert {r[0] for r in some.select(K.PREDICTION).distinct().collect()} == {1.0, 2.0}
    one = K.make_classifier("SVC", params, 1, 100, 3).fit(rows.filter("rs_label = 2")).transform(rows)
    assert {r[0] for r in one.select(K.PREDICTION).distinct().collect()} == {2.0}
    with pytest.raises(ValueError, match="multi_class"):
        K.make_classifier("SVC", {"kernel": "linear", "multi_class": "x"}, 1, 10, 3)


def test_pairwise_margins_in_a_pipeline(birds):
    spec = ExperimentSpec("SVC", {"kernel": "linear", "max_iter": 5, "multi_class": "ovo", "probability": True, "class_weight": "balanced"})
    model = fit_pipeline(birds, BIRD_SURVEY, spec)
    assert predict(birds, model).filter("prediction = species").count() > 200
    assert predict_proba(birds, model, ["row_id"]).columns == ["row_id", "Adelie", "Chinstrap", "Gentoo"]
