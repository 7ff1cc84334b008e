import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer

from rowsmith.operators import ranking as R
from rowsmith.sources.files import read_documents, write_document
from rowsmith.sources.metrics import MetricsStore, flatten_metrics, metric_documents, read_metric_documents
from rowsmith.sources.registry import EVENT_SCHEMA, ModelNotFound, ModelRegistry

START = datetime(2025, 1, 1)


def tiny_model(word="x"):
    """A pipeline that needs no training."""
    predict = SQLTransformer(statement=f"SELECT *, 1.0D AS prediction, '{word}' AS word FROM __THIS__")
    return PipelineModel([predict, IndexToString(inputCol="prediction", outputCol="predicted_label", labels=["a", "b"])])


@pytest.fixture
def registry(spark, tmp_path):
    return ModelRegistry(spark, str(tmp_path / "models"))


def scores(f1, accuracy=0.5):
    return {"accuracy": accuracy, "precision": 0.5, "recall": 0.5, "f1_score": f1}


def test_empty_registry(registry):
    assert registry.list_models() == []
    assert registry.summary().count() == 0
    assert registry.latest_model_id() is None and registry.best_model_id() is None
    assert registry.load_latest_model() is None and registry.load_best_model() is None
    row = registry.serving_choice().first()
    assert (row["model_loaded"], row["status"], row["model_id"]) == (False, "unhealthy", None)
    assert registry.load_for_serving() == (None, None)


def test_life_of_models(spark, registry):
    for name in ("model1", "model2", "model3"):
        registry.save_model(tiny_model(name), name, {"note": name, "params": {"depth": 3}})
    assert registry.list_models() == ["model1", "model2", "model3"]
    assert registry.latest_model_id() == "model3"
    info = registry.info("model1").first()
    assert info["classes"] == ["a", "b"] and info["file_size"] > 0
    assert info["pipeline_steps"] == ["SQLTransformer", "IndexToString"]
    assert info["metadata"] == {"note": "model1", "params": '{"depth": 3}'}
    row = spark.range(1)
    assert registry.load_model("model2").transform(row).first()["word"] == "model2"

    with pytest.raises(ValueError, match="already exists"):
        registry.save_model(tiny_model(), "model1", overwrite=False)
    registry.save_model(tiny_model("new"), "model1")
    assert registry.load_model("model1").transform(row).first()["word"] == "new"
    assert registry.latest_model_id() == "model1"

    registry.metrics.save(scores(0.83, 0.92), "model1")
    registry.metrics.save({"test_metrics": scores(0.90, 0.85), "train_metrics": scores(0.99)}, "model2")
    assert registry.best_model_id() == "model2"
    assert registry.best_model_id("accuracy") == "model1"
    assert registry.best_model_id("no_such_metric") is None
    assert registry.load_for_serving()[0] == "model2"
    assert registry.info("model2").first()["f1_score"] == 0.90

    registry.delete_model("model2")
    assert registry.list_models() == ["model1", "model3"]
    assert registry.best_model_id() == "model1"
    with pytest.raises(ModelNotFound, match="available"):
        registry.load_model("model2")
    with pytest.raises(ModelNotFound):
        registry.delete_model("model2")
    summary = registry.summary().collect()
    assert [r["model_id"] for r in summary] == ["model1", "model3"]
    assert summary[0]["pipeline_steps"] == "SQLTransformer, IndexToString"


def test_serving_falls_back_to_newest(registry):
    registry.save_model(tiny_model(), "old")
    registry.save_model(tiny_model(), "new")
    registry.metrics.save(scores(0.99), "gone")
    row = registry.serving_choice().first()
    assert (row["model_id"], row["score"], row["model_loaded"]) == ("new", None, True)


def test_cleanup_keeps_the_newest(registry):
    for i in range(5):
        registry.save_model(tiny_model(), f"model_{i}")
    registry.cleanup(keep_latest=3)
    assert registry.list_models() == ["model_2", "model_3", "model_4"]
    registry.cleanup(keep_latest=3)
    assert registry.list_models() == ["model_2", "model_3", "model_4"]


def test_export_and_import(spark, registry, tmp_path):
    registry.save_model(tiny_model("w"), "m", {"note": "kept"})
    registry.metrics.save(scores(0.8), "m")
    registry.export_model("m", str(tmp_path / "out"))
    exported = spark.read.json(str(tmp_path / "out/metrics")).first()
    assert exported["metrics"]["test_metrics"]["f1_score"] == 0.8
    other = ModelRegistry(spark, str(tmp_path / "other"))
    other.import_model(str(tmp_path / "out/model"), "renamed", str(tmp_path / "out/metadata"))
    assert other.list_models() == ["renamed"]
    assert other.info("renamed").first()["metadata"] == {"note": "kept"}
    assert other.load_model("renamed").transform(spark.range(1)).first()["word"] == "w"
    with pytest.raises(ValueError, match="already exists"):
        other.import_model(str(tmp_path / "out/model"), "renamed")
    with pytest.raises(ValueError, match="no readable model"):
        other.import_model(str(tmp_path / "out/nothing"), "x")


def test_latest_event_wins(spark):
    def event(model, i, kind, minutes):
        return (model, kind, START + timedelta(minutes=minutes), None, "T", 1, None, None, None, f"e{i}")

    rows = [event("a", 1, "save", 0), event("a", 2, "delete", 5), event("b", 3, "save", 1), event("b", 4, "save", 9),
            event("c", 5, "delete", 1), event("c", 6, "save", 1)]
    current = R.current_models(spark.createDataFrame(rows, EVENT_SCHEMA))
    assert {(r["model_id"], r["event_id"]) for r in current.collect()} == {("b", "e4"), ("c", "e6")}
    assert R.known(current, spark.createDataFrame([("b",), ("x",)], "model_id string")).collect()[0][0] == "b"


def test_metrics_store(spark, tmp_path):
    store = MetricsStore(spark, str(tmp_path / "metrics"))
    assert store.rows().count() == 0 and store.best_model_id() is None
    store.save(scores(0.1), "m", timestamp=START + timedelta(days=1))
    store.save(scores(0.7), "m", timestamp=START)
    store.save(scores(0.4), "m", "tuned", timestamp=START - timedelta(days=1))
    values = {r["metric"]: r["value"] for r in store.load("m").collect()}
    assert values["f1_score"] == 0.1
    assert {r["value"] for r in store.load("m", "tuned").filter("metric = 'f1_score'").collect()} == {0.4}
    with pytest.raises(LookupError, match="no metrics"):
        store.load("m", "other")
    with pytest.raises(ValueError, match="no metrics"):
        store.save({}, "m")
    assert {tuple(r) for r in store.entries().collect()} == {("m", ""), ("m", "tuned")}
    assert store.compare().first()["f1_score"] == 0.1
    assert len(metric_documents(store.rows()).collect()) == 3


def test_comparison_order(spark, tmp_path):
    store = MetricsStore(spark, str(tmp_path / "metrics"))
    for name, f1 in (("Model_A", 0.82), ("Model_B", 0.88), ("Model_C", None)):
        store.save({k: v for k, v in scores(f1).items() if v is not None}, name)
    assert [r["model_id"] for r in store.compare().collect()] == ["Model_B", "Model_A", "Model_C"]
    assert store.best_model_id() == "Model_B"


def test_best_of_list():
    assert R.best_of_list([("a", 0.8), ("b", 0.88), ("c", 0.88)]) == {"best_model_name": "b", "best_model_index": 1, "best_score": 0.88}
    assert R.best_of_list([("a", None), ("b", None)])["best_model_name"] == "a"


def test_flatten():
    doc = {**scores(0.5), "per_class": {"x": {"precision": 1.0}}, "support": {"x": 3}, "roc_auc": None,
           "classification_report": {"macro avg": {"recall": 0.5}}}
    assert set(flatten_metrics(doc)) >= {
        ("test", "overall", None, "f1_score", 0.5), ("test", "class", "x", "precision", 1.0),
        ("test", "class", "x", "support", 3.0), ("test", "macro", None, "recall", 0.5),
    }


def test_documents(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "a1.json").write_text('{"model_id": "a", "timestamp": "2025-01-01T00:00:00", "metrics": {"f1_score": 0.2}}\n')
    (folder / "a2.json").write_text('{"model_id": "a", "timestamp": "2025-01-02T00:00:00", "metrics": {"model_name": "N", "test_metrics": {"f1_score": 0.3}}}\n')
    (folder / "bad.json").write_text('{"model_id": "z", "metr\n')
    rows = read_metric_documents(spark, str(folder)).collect()
    assert [(r["model_id"], r["f1_score"], r["model_name"]) for r in rows] == [("a", 0.3, "N")]
    assert read_documents(spark, str(folder), "model_id string").filter("_corrupt_record IS NOT NULL").cache().count() == 1


def test_result_document(spark, tmp_path):
    write_document(spark, {"name": "é", "n": [1, 2]}, str(tmp_path / "r"))
    row = spark.read.json(str(tmp_path / "r")).first()
    assert (row["name"], row["n"]) == ("é", [1, 2])


def test_metrics_end_with_their_model(spark, registry):
    registry.save_model(tiny_model(), "m")
    registry.metrics.save(scores(0.99), "m")
    registry.delete_model("m", delete_metrics=False)
    assert registry.metrics.rows().count() > 0
    registry.save_model(tiny_model(), "m")
    registry.save_model(tiny_model(), "n")
    registry.metrics.save(scores(0.5), "n")
    assert registry.serving_choice().first()["model_id"] == "n" == registry.best_model_id()
    assert [r["model_id"] for r in registry.compare().collect()] == ["n"]
    assert registry.info("m").first()["f1_score"] is None
    registry.metrics.save(scores(0.7), "m")
    assert registry.best_model_id() == "m"
    registry.delete_model("m")
    with pytest.raises(LookupError):
        registry.metrics.load("m")
    assert registry.metrics.load("n").count() > 0


def test_one_of_several_writers_of_a_new_id_succeeds(spark, registry):
    def save(word):
        try:
            registry.save_model(tiny_model(word), "m/1", overwrite=False)
            return word
        except ValueError as e:
            assert "already exists" in str(e)

    def saved_by_one():
        with ThreadPoolExecutor(4) as pool:
            winners = [w for w in pool.map(save, "abcd") if w]
        assert len(winners) == 1
        assert registry.load_model("m/1").transform(spark.range(1)).first()["word"] == winners[0]

    saved_by_one()
    registry.delete_model("m/1")
    saved_by_one()
    assert registry.events().filter("event = 'save'").count() == 2


def test_a_failed_save_frees_the_id(registry, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(registry, "_append", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            registry.save_model(tiny_model(), "m", overwrite=False)
    registry.save_model(tiny_model(), "m", overwrite=False)
    assert registry.list_models() == ["m"]


def test_vacuum(spark, registry):
    """Replaced, deleted and never registered artifacts go once they are old enough; current ones stay."""
    old = registry.save_model(tiny_model("old"), "m")
    new = registry.save_model(tiny_model("new"), "m")
    lost = registry.save_model(tiny_model(), "n")
    registry.delete_model("n")
    orphan = f"{registry.path}/artifacts/x/unfinished"
    tiny_model().write().save(orphan)
    assert registry.vacuum(timedelta(hours=1)) == 0
    assert all(map(os.path.isdir, (old, new, lost, orphan)))
    assert registry.vacuum(timedelta(seconds=-5)) == 3
    assert [os.path.isdir(p) for p in (old, new, lost, orphan)] == [False, True, False, False]
    assert registry.load_model("m").transform(spark.range(1)).first()["word"] == "new"
    assert registry.vacuum(timedelta(0)) == 0
    assert ModelRegistry(spark, f"{registry.path}/none").vacuum() == 0


def test_metric_entries_are_cleaned_up(spark, registry):
    for i in range(5):
        registry.metrics.save(scores(i / 10), "m", timestamp=START + timedelta(hours=i))
    registry.metrics.save(scores(0.9), "m", suffix="tuned", timestamp=START)
    registry.metrics.cleanup(keep_latest=2)
    left = registry.metrics.rows().filter("metric = 'f1_score'").collect()
    assert sorted(r["value"] for r in left) == [0.3, 0.4, 0.9]
    registry.metrics.cleanup(keep_latest=2)
    assert registry.metrics.rows().filter("metric = 'f1_score'").count() == 3


def test_compaction_keeps_models_and_metrics(registry):
    for name in ("a", "b", "c"):
        registry.save_model(tiny_model(name), name, {"features": ["x", "y"]})
        registry.metrics.save(scores(0.5 + len(name) / 10), name)
    registry.delete_model("b")
    registry.compact(timedelta(0))
    assert registry.list_models() == ["a", "c"]
    registry.save_model(tiny_model("d"), "d")
    registry.metrics.save(scores(0.9), "d")
    assert registry.list_models() == ["a", "c", "d"] and registry.best_model_id() == "d"
    with pytest.raises(ValueError, match="already exists"):
        registry.save_model(tiny_model(), "a", overwrite=False)
    registry.delete_model("d")
    registry.compact(timedelta(0))
    registry.compact(timedelta(0))
    assert registry.list_models() == ["a", "c"]
    assert sorted(r["model_id"] for r in registry.compare().collect()) == ["a", "c"]
    row = registry.serving_choice().first()
    assert row["features"] == ["x", "y"]
