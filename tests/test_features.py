import statistics
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowsmith.operators import statistics as stats
from rowsmith.operators.features import PreprocessEstimator, Preprocessor, preprocess
from rowsmith.presets import BIRD_SURVEY
from rowsmith.spec import CategoryField, NumericField, TableSpec

SCHEMA = (
    "row_id int, bill_length_mm double, bill_depth_mm double, flipper_length_mm double, body_mass_g double, "
    "year int, island string, sex string"
)
ROWS = [
    (1, 39.1, 18.7, 181.0, 3750.0, 2007, "Torgersen", "MALE"),
    (2, 39.5, 17.4, 186.0, 3800.0, 2007, "Torgersen", "FEMALE"),
    (3, None, 18.0, 195.0, 3250.0, 2007, None, "FEMALE"),
    (4, 36.7, 19.3, 193.0, 3450.0, 2007, "Torgersen", "FEMALE"),
    (5, 40.3, 20.6, 190.0, 3650.0, 2007, "Biscoe", "MALE"),
]
NAMES = [
    "bill_length_mm", "bill_depth_mm", "flipper_length_mm", "body_mass_g", "year",
    "island_Biscoe", "island_Missing", "island_Torgersen", "sex_FEMALE", "sex_MALE",
]


@pytest.fixture
def five(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_by_hand(five):
    fitted = Preprocessor(BIRD_SURVEY).fit(five)
    assert fitted.feature_names() == NAMES
    assert fitted.numeric[0].fill == pytest.approx(38.9)
    out = fitted.transform(five, ["row_id"]).orderBy("row_id").collect()
    assert [r["year"] for r in out] == [0.0] * 5
    assert [[r[n] for n in NAMES[5:]] for r in out] == [
        [0, 0, 1, 0, 1], [0, 0, 1, 1, 0], [0, 1, 0, 1, 0], [0, 0, 1, 1, 0], [1, 0, 0, 0, 1],
    ]
    for name in NAMES[:4]:
        values = [r[name] for r in out]
        assert statistics.fmean(values) == pytest.approx(0, abs=1e-9)
        assert statistics.pstdev(values) == pytest.approx(1)


def test_drop_first(five):
    fitted = Preprocessor(BIRD_SURVEY, drop_first=True).fit(five)
    assert fitted.feature_names() == NAMES[:5] + ["island_Missing", "island_Torgersen", "sex_MALE"]


def test_unknown_category(spark, five):
    new = spark.createDataFrame([(9, 39.0, 18.0, 190.0, 3600.0, 2007, "Dream", None)], SCHEMA)
    row = Preprocessor(BIRD_SURVEY).fit(five).transform(new).first()
    assert [row[n] for n in NAMES[5:]] == [0.0] * 5
    with pytest.raises(PySparkException, match="unknown category in island"):
        Preprocessor(BIRD_SURVEY, handle_unknown="error").fit(five).transform(new).collect()


def test_strategies(five):
    median = Preprocessor(BIRD_SURVEY, numeric_strategy="median").fit(five)
    assert median.numeric[0].fill == pytest.approx((39.1 + 39.5) / 2)
    frequent = Preprocessor(BIRD_SURVEY, numeric_strategy="most_frequent", categorical_strategy="most_frequent").fit(five)
    assert frequent.numeric[0].fill == 36.7
    assert [s.fill for s in frequent.categorical] == ["Torgersen", "FEMALE"]
    constant = Preprocessor(BIRD_SURVEY, numeric_strategy="constant", numeric_fill=1.5).fit(five)
    assert constant.numeric[0].fill == 1.5
    filled = [1.5 if r[1] is None else r[1] for r in ROWS]
    assert constant.numeric[0].mean == pytest.approx(statistics.fmean(filled))
    assert constant.numeric[0].std == pytest.approx(statistics.pstdev(filled))
    for bad in ({"numeric_strategy": "x"}, {"categorical_strategy": "mean"}, {"handle_unknown": "?"}):
        with pytest.raises(ValueError, match="unknown"):
            Preprocessor(BIRD_SURVEY, **bad)


def test_column_without_values_is_left_out(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    spec = TableSpec(key=(), numeric=(NumericField("a"), NumericField("b")))
    assert Preprocessor(spec).fit(df).feature_names() == ["b"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "a double")
    spec = TableSpec(key=(), numeric=(NumericField("a"),))
    out = [r["a"] for r in Preprocessor(spec).fit(df).transform(df).collect()]
    assert sorted(out) == pytest.approx([-(1.5**0.5), 0.0, 1.5**0.5])


def test_fitted_on_train_only(spark, five):
    train, test = five.filter("row_id <= 3"), five.filter("row_id > 3")
    train_x, test_x, fitted = preprocess(train, test, BIRD_SURVEY, keep=["row_id"])
    assert fitted.numeric[0].mean == pytest.approx(39.3)
    assert train_x.columns == test_x.columns
    last = test_x.filter("row_id = 5").first()
    assert last["bill_length_mm"] == pytest.approx((40.3 - 39.3) / fitted.numeric[0].std)
    assert preprocess(train, None, BIRD_SURVEY)[1] is None


@pytest.mark.parametrize("sparse", [False, True])
def test_vectors_agree_with_columns(spark, five, tmp_path, sparse):
    """Dense and sparse encodings give the same names and numbers, also after saving and loading."""
    spec = replace(BIRD_SURVEY, categorical=tuple(replace(f, sparse=sparse) for f in BIRD_SURVEY.categorical))
    fitted = Preprocessor(spec).fit(five)
    assert fitted.feature_names() == NAMES
    texts = {r["text"] for r in fitted.info(spark).filter("statistic = 'category'").collect()}
    assert texts == {r["text"] for r in Preprocessor(BIRD_SURVEY).fit(five).info(spark).filter("statistic = 'category'").collect()}
    PipelineModel(fitted.stages()).write().save(str(tmp_path / "p"))
    model = PipelineModel.load(str(tmp_path / "p"))
    vectors = model.transform(five)
    assert vectors.columns == [*five.columns, "features"]
    cells = vectors.orderBy("row_id").select(vector_to_array("features").alias("v")).collect()
    table = Preprocessor(BIRD_SURVEY).fit(five).transform(five, ["row_id"]).orderBy("row_id").collect()
    assert [list(r["v"]) for r in cells] == [pytest.approx([r[n] for n in NAMES]) for r in table]


def test_wide_column_options(spark):
    df = spark.createDataFrame([(i, f"v{i:03d}") for i in range(40)] + [(40, None)], "k int, c string")
    spec = TableSpec(key=("k",), categorical=(CategoryField("c", sparse=True),))
    with pytest.raises(ValueError, match="declare it sparse"):
        Preprocessor(TableSpec(key=("k",), categorical=(CategoryField("c"),)), max_dense=10).fit(df)
    with pytest.raises(ValueError, match="every task"):
        Preprocessor(spec, max_sparse=10).fit(df)
    new = spark.createDataFrame([(1, "v003"), (2, "other"), (3, "Missing")], "k int, c string")

    def ones(**options):
        stages = Preprocessor(spec, **options).fit(df).stages()
        rows = PipelineModel(stages).transform(new).orderBy("k").select(vector_to_array("features").alias("v"))
        return [(len(r["v"]), [i for i, x in enumerate(r["v"]) if x]) for r in rows.collect()]

    assert ones() == [(41, [4]), (41, []), (41, [0])]
    assert ones(drop_first=True) == [(40, [3]), (40, []), (40, [])]
    with pytest.raises(Exception, match="Unseen label"):
        ones(handle_unknown="error")


def test_awkward_names_and_values(spark):
    df = spark.createDataFrame([(1, "it's", 1.0), (2, "a.b\\c", 2.0)], "k int, `odd name` string, `x.y` double")
    spec = TableSpec(key=("k",), numeric=(NumericField("x.y"),), categorical=(CategoryField("odd name"),))
    fitted = Preprocessor(spec).fit(df)
    assert fitted.feature_names() == ["x.y", "odd name_a.b\\c", "odd name_it's"]
    assert [tuple(r) for r in fitted.transform(df, ["k"]).orderBy("k").collect()] == [(1, -1, 0, 1), (2, 1, 1, 0)]
    vectors = PipelineModel(fitted.stages()).transform(df).orderBy("k").select("features").collect()
    assert [list(r["features"].toArray()) for r in vectors] == [[-1, 0, 1], [1, 1, 0]]


def test_as_pipeline_stage(five):
    model = Pipeline(stages=[PreprocessEstimator(Preprocessor(BIRD_SURVEY))]).fit(five)
    assert len(model.transform(five).first()["features"]) == 10


def test_info(spark, five):
    rows = Preprocessor(BIRD_SURVEY).fit(five).info(spark).collect()
    means = {r["feature"]: r["value"] for r in rows if r["statistic"] == "fill" and r["value"] is not None}
    assert means["bill_length_mm"] == pytest.approx(38.9)
    assert [r["text"] for r in rows if r["feature"] == "island" and r["statistic"] == "category"] == [
        "Biscoe", "Missing", "Torgersen",
    ]


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0], [float(i * 7919 % 1009) for i in range(3000)], [5.0] * 900 + [1.0] * 50 + [9.0] * 49,
        [0.0] * 500 + [1.0] * 500, [-1.0] * 499 + [0.5, 0.7] + [2.0] * 499, [1e-9 * i for i in range(2001)] + [1e9],
    ],
)
def test_median_is_exact(spark, monkeypatch, values):
    monkeypatch.setattr(stats, "RANK_DIRECTLY", 5)
    monkeypatch.setattr(stats, "GUIDE_ROWS", 250)
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "a double, b double").repartition(4)
    assert stats.medians(df, ["a", "b"]) == {"a": statistics.median(values), "b": -statistics.median(values)}


def test_median_survives_a_wrong_sketch(spark, monkeypatch):
    monkeypatch.setattr(stats, "RANK_DIRECTLY", 5)
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", 3)
    monkeypatch.setattr(stats, "GUIDE_ROWS", 10)
    values = [float(i * 31 % 997) for i in range(997)]
    df = spark.createDataFrame([(v,) for v in values], "a double").repartition(4)
    assert stats.medians(df, ["a"]) == {"a": statistics.median(values)}


def test_median_of_nothing(spark):
    assert stats.medians(spark.createDataFrame([], "a double"), ["a"]) == {"a": None}
    assert stats.medians(spark.createDataFrame([], "a double"), []) == {}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6).map(lambda x: round(x, 3))), min_size=2, max_size=30), st.floats(-5, 5))
@example([None, 0.0], 2.947624387456567e-190)
@example([None, 0.0], 0.0)
def test_filled_moments(spark, values, fill):
    from rowsmith.operators.features import is_constant, scale_after_fill

    df = spark.createDataFrame([(v,) for v in values], "a double")
    found = stats.moments(df, ["a"])["a"]
    if not found.filled:
        return
    mean, std = scale_after_fill(found, fill)
    full = [fill if v is None else v for v in values]
    if min(full) == max(full):
        assert (mean, std) == (full[0], 1.0)
    elif is_constant(statistics.pvariance(full), statistics.fmean(full), len(full)):
        assert std == 1.0
    else:
        assert mean == pytest.approx(statistics.fmean(full), abs=1e-6)
        assert std == pytest.approx(statistics.pstdev(full), rel=1e-6, abs=1e-6)


def test_modes(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("b", 1.0), ("a", 1.0), (None, None), (None, None), (None, None)], "c string, n double")
    assert stats.modes(df, ["c"], "string") == {"c": "a"}
    assert stats.modes(df, ["n"], "double") == {"n": 1.0}
    empty = df.withColumn("e", F.lit(None).cast("string"))
    assert stats.modes(empty, ["e"], "string") == {"e": None}
