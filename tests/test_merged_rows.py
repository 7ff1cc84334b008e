from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.plans import classifiers as C
from rowsmith.streaming.scoring import log_predictions


def repeated(spark, copies, classes=3):
    """Rows of well-separated classes, each distinct row ``copies`` times."""
    rows = [(float(c), Vectors.dense([10.0 * c + i, float(i % 3)])) for c in range(classes) for i in range(4)]
    schema = T.StructType([T.StructField(C.LABEL, T.DoubleType()), T.StructField(C.FEATURES, VectorUDT())])
    return spark.createDataFrame(rows * copies, schema)


def fitted_on(estimator, frame, name, params, monkeypatch):
    """The model, and the rows and weights that the classifier was fitted on."""
    seen = []
    fit = type(estimator).fit
    with monkeypatch.context() as m:
        m.setattr(type(estimator), "fit", lambda self, df: (seen.append((df.count(), df.columns, df.agg(F.sum(C.WEIGHT)).first()[0] if C.WEIGHT in df.columns else None)), fit(self, df))[1])
        model = C.fit_classifier_stage(estimator, frame, name, params, frame.count())
    return model, seen[0]


def test_pairwise_machines_read_each_distinct_row_once(spark, monkeypatch):
    params = {"kernel": "linear", "multi_class": "ovo", "max_iter": 20}
    frame = repeated(spark, 30)
    model, (n, _, weight) = fitted_on(C.make_classifier("SVC", params, 1, frame.count(), 3), frame, "SVC", params, monkeypatch)
    assert (n, weight) == (12, 360.0)
    assert model.transform(frame).where(F.col(C.PREDICTION) != F.col(C.LABEL)).isEmpty()


def test_rows_that_do_not_repeat_stay(spark, monkeypatch):
    params = {"kernel": "linear", "multi_class": "ovo", "max_iter": 5}
    frame = repeated(spark, 1)
    _, (n, columns, _) = fitted_on(C.make_classifier("SVC", params, 1, 12, 3), frame, "SVC", params, monkeypatch)
    assert n == 12 and C.WEIGHT not in columns


def test_a_tree_reads_each_distinct_row_once(spark, monkeypatch):
    """A tree that counts rows in its leaves or splits still reads them all."""
    frame = repeated(spark, 30)
    for params, n in (({"max_depth": 2}, 12), ({"max_depth": 2, "min_samples_leaf": 5}, 360), ({"max_depth": 2, "min_samples_split": 50}, 360)):
        name = "DecisionTreeClassifier"
        model, (read, _, _) = fitted_on(C.make_classifier(name, params, 1, 360, 3), frame, name, params, monkeypatch)
        assert read == n
        assert model.transform(frame).where(F.col(C.PREDICTION) != F.col(C.LABEL)).isEmpty()


def test_prediction_log_is_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(i, "small", 1.0) for i in range(50)], "id bigint, prediction string, confidence double")
    log_predictions(rows, str(tmp_path / "log"))
    files = [p.name for p in (tmp_path / "log").glob("part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert spark.read.json(str(tmp_path / "log")).select("input.id").distinct().count() == 50
