"""Training, tuning, persistence and scoring over the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowsmith.plans import experiments as X
from rowsmith.plans.score import ensemble, predict, predict_proba, score
from rowsmith.plans.train import fit_pipeline, train
from rowsmith.plans.tune import cross_validate, expand_grid, tune
from rowsmith.queries.base import derive, query, r6
from rowsmith.session import materialise, scratch_path
from rowsmith.sources.files import write_document
from rowsmith.sources.registry import ModelRegistry
from rowsmith.spec import CategoryField, ExperimentSpec, NumericField, TableSpec, TargetField, TuneSpec

# Whole documents described by letter shares; the language is the label to learn.
TEXT_SHAPE = """
SELECT doc_id, source, lang AS language, CAST(n_chars AS DOUBLE) AS n_chars,
  (n - length(replace(low, 'th', ''))) / n AS share_th,
  (n - length(translate(low, 'éèêç', ''))) / n AS share_accents,
  (n - length(translate(low, 'äöüß', ''))) / n AS share_umlauts,
  (n - length(translate(low, 'ñáíóú', ''))) / n AS share_tildes,
  (n - length(replace(low, 'w', ''))) / n AS share_w,
  (n - length(replace(low, 'e', ''))) / n AS share_e,
  (n - length(replace(low, ' ', ''))) / n AS share_blank
FROM (SELECT *, lower(text) AS low, CAST(greatest(length(text), 1) AS DOUBLE) AS n FROM {documents})
"""
SHARES = ("share_th", "share_accents", "share_umlauts", "share_tildes", "share_w", "share_e", "share_blank")
TEXT_SPEC = TableSpec(
    key=("doc_id",),
    numeric=(
        NumericField("n_chars", low=0, score_low=1, score_high=10_000_000),
        *[NumericField(s, low=0, high=1, score_low=0, score_high=1) for s in SHARES],
    ),
    categorical=(CategoryField("source"),),
    target=TargetField("language"),
)

# Line items labelled by a rule on their quantity. A tree of depth two finds the rule exactly, so
# the predictions of the whole chain have an expected value that SQL can state.
SIZE_RULE = "CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 30 THEN 'medium' ELSE 'large' END"
SIZED = f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, {SIZE_RULE} AS size_class
FROM {{lineitem}}
"""
SIZED_SPEC = TableSpec(
    key=("l_orderkey", "l_linenumber"),
    numeric=(
        NumericField("l_quantity", low=0, score_low=1, score_high=45),
        NumericField("l_discount", low=0, score_low=0, score_high=1),
        NumericField("l_tax", low=0, score_low=0, score_high=1),
    ),
    categorical=(CategoryField("l_returnflag", ("A", "N", "R")), CategoryField("l_linestatus", ("F", "O"))),
    target=TargetField("size_class", ("small", "medium", "large")),
)
SPLIT_RULE = "CASE WHEN year(l_shipdate) >= 2000 THEN 'test' ELSE 'train' END"
RULE_TREE = ExperimentSpec("DecisionTreeClassifier", {"max_depth": 2})

EMBEDDING_SPEC = TableSpec(
    key=("vec_id",), numeric=tuple(NumericField(f"e{i}") for i in range(64)), target=TargetField("label_name")
)


def text_table(spark, sf):
    """The letter shares, computed once per query and written out: fitting reads them often."""
    return materialise(derive(spark, sf, TEXT_SHAPE, "documents"), "shapes")


def sized_table(spark, sf):
    return derive(spark, sf, SIZED, "lineitem")


def split_table(spark, sf):
    """The labelled line items, with shipments from 2000 on held out as test rows."""
    sql = SIZED.replace(" AS size_class", " AS size_class, " + SPLIT_RULE + " AS split")
    return derive(spark, sf, sql, "lineitem")


def embedding_table(spark, sf):
    cells = ", ".join(f"embedding[{i}] AS e{i}" for i in range(64))
    return derive(spark, sf, f"SELECT vec_id, 'c' || label AS label_name, {cells} FROM {{embeddings}}", "embeddings")


def _overall(spark, results: dict):
    """Headline numbers of a training result, one row per part."""
    rows = [
        (split, m["total_samples"], m["num_classes"], m["accuracy"], m["f1_score"])
        for split, m in (("train", results["train_metrics"]), ("test", results["test_metrics"]))
    ]
    return spark.createDataFrame(rows, "split string, n bigint, classes int, accuracy double, f1_score double")


FOREST = ExperimentSpec(
    "RandomForestClassifier", {"n_estimators": 20, "max_depth": 6, "min_samples_split": 5, "min_samples_leaf": 2}
)
LOGISTIC = ExperimentSpec("LogisticRegression", {"max_iter": 50, "C": 1.0})
CALIBRATED = ExperimentSpec("SVC", {"kernel": "linear", "max_iter": 10, "probability": True})
MARGIN = ExperimentSpec("SVC", {"kernel": "linear", "C": 1.0, "max_iter": 20})


@query("train_random_forest")
def train_random_forest(spark, sf):
    return _overall(spark, train(text_table(spark, sf), TEXT_SPEC, FOREST).results)


@query("train_logistic")
def train_logistic(spark, sf):
    return _overall(spark, train(embedding_table(spark, sf), EMBEDDING_SPEC, LOGISTIC).results)


@query(
    "train_decision_tree",
    f"""SELECT {SPLIT_RULE} AS split, count(*) AS n, 3 AS classes, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1_score
        FROM lineitem GROUP BY 1""",
)
def train_decision_tree(spark, sf):
    return _overall(spark, train(split_table(spark, sf), SIZED_SPEC, RULE_TREE).results)


@query("train_linear_svc")
def train_linear_svc(spark, sf):
    return _overall(spark, train(text_table(spark, sf), TEXT_SPEC, MARGIN).results)


GRID = ({"max_depth": [2, 5], "criterion": ["gini", "entropy"]}, {"classifier__min_samples_leaf": [1, 20]})


@query("tune_grid")
def tune_grid(spark, sf):
    experiment = ExperimentSpec(
        "DecisionTreeClassifier", {"max_depth": 4}, tune=TuneSpec(GRID, cv=3, scoring="f1_macro", parallelism=4)
    )
    found = tune(text_table(spark, sf), TEXT_SPEC, experiment).results["cv_results"]
    rows = [
        (i, str(sorted(p.items())), m, s)
        for i, (p, m, s) in enumerate(zip(found["params"], found["mean_test_scores"], found["std_test_scores"]))
    ]
    return spark.createDataFrame(rows, "candidate int, params string, mean_score double, std_score double")


EXPECTED = f"SELECT l_orderkey, l_linenumber, {SIZE_RULE} AS prediction, 1.0::DOUBLE AS confidence FROM lineitem"


def _scored(rows):
    return rows.select("l_orderkey", "l_linenumber", "prediction", r6("confidence").alias("confidence"))


@query("model_save_load", EXPECTED)
def model_save_load(spark, sf):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    rows = sized_table(spark, sf)
    done = train(rows, SIZED_SPEC, RULE_TREE, registry)
    return _scored(predict(rows, registry.load_model(done.model_id)))


@query("model_export_import", EXPECTED)
def model_export_import(spark, sf):
    root = scratch_path(spark, "export")
    rows = sized_table(spark, sf)
    first, second = ModelRegistry(spark, f"{root}/a"), ModelRegistry(spark, f"{root}/b")
    first.save_model(fit_pipeline(rows, SIZED_SPEC, RULE_TREE), "sizes")
    first.export_model("sizes", f"{root}/out")
    second.import_model(f"{root}/out/model", "imported", f"{root}/out/metadata")
    return _scored(predict(rows, second.load_latest_model()))


@query(
    "sink_results_json",
    f"""SELECT 'DecisionTreeClassifier' AS model_name, count(*) FILTER ({SPLIT_RULE} = 'train') AS train_size,
        count(*) FILTER ({SPLIT_RULE} = 'test') AS test_size, 1.0::DOUBLE AS accuracy FROM lineitem""",
)
def sink_results_json(spark, sf):
    path = scratch_path(spark, "results")
    write_document(spark, train(split_table(spark, sf), SIZED_SPEC, RULE_TREE).results, path)
    schema = "model_name string, data_info struct<train_size:bigint,test_size:bigint>, test_metrics struct<accuracy:double>"
    return spark.read.schema(schema).json(path).select(
        "model_name", "data_info.train_size", "data_info.test_size", F.col("test_metrics.accuracy").alias("accuracy")
    )


@query("score_batch", EXPECTED + " WHERE l_quantity BETWEEN 1 AND 45")
def score_batch(spark, sf):
    rows = sized_table(spark, sf)
    accepted, _ = score(rows, fit_pipeline(rows, SIZED_SPEC, RULE_TREE), SIZED_SPEC, mode="quarantine")
    return _scored(accepted)


@query(
    "score_proba",
    f"""WITH ruled AS (SELECT l_orderkey, l_linenumber, {SIZE_RULE} AS size_class FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN size_class = 'large' THEN 1.0 ELSE 0.0 END::DOUBLE AS large,
      CASE WHEN size_class = 'medium' THEN 1.0 ELSE 0.0 END::DOUBLE AS medium,
      CASE WHEN size_class = 'small' THEN 1.0 ELSE 0.0 END::DOUBLE AS small FROM ruled""",
)
def score_proba(spark, sf):
    rows = sized_table(spark, sf)
    return predict_proba(rows, fit_pipeline(rows, SIZED_SPEC, RULE_TREE), ["l_orderkey", "l_linenumber"])


# Every candidate of a grid of rules, rated over the whole table in one aggregate.
RULE_GRID = ({"above": [10, 25, 40], "flag": ["A", "N", "R"]}, {"classifier__above": [30], "flag": ["R"], "below": [45]})


@query(
    "grid_expand",
    """WITH grid AS (
      SELECT a AS above, f AS flag, 1000 AS below, (row_number() OVER (ORDER BY a, f) - 1)::INTEGER AS candidate
      FROM unnest([10, 25, 40]) x(a), unnest(['A', 'N', 'R']) y(f)
      UNION ALL SELECT 30, 'R', 45, 9)
    SELECT candidate, above, flag, below, round(avg(CASE WHEN (l_quantity > above AND l_quantity < below)
      = (l_returnflag = flag) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy
    FROM grid, lineitem GROUP BY ALL""",
)
def grid_expand(spark, sf):
    candidates = [{"below": 1000, **c} for c in expand_grid(RULE_GRID)]
    quantity, flag = F.col("l_quantity"), F.col("l_returnflag")
    rated = sized_table(spark, sf).agg(
        *[
            F.avg((((quantity > c["above"]) & (quantity < c["below"])) == (flag == c["flag"])).cast("double")).alias(f"a{i}")
            for i, c in enumerate(candidates)
        ]
    )
    entries = [
        F.struct(
            F.lit(i).alias("candidate"),
            F.lit(c["above"]).alias("above"),
            F.lit(c["flag"]).alias("flag"),
            F.lit(c["below"]).alias("below"),
            r6(f"a{i}").alias("accuracy"),
        )
        for i, c in enumerate(candidates)
    ]
    return rated.select(F.inline(F.array(*entries)))


@query("score_ensemble")
def score_ensemble(spark, sf):
    rows = text_table(spark, sf)
    models = [fit_pipeline(rows, TEXT_SPEC, e) for e in (FOREST, LOGISTIC, CALIBRATED)]
    return ensemble(rows, models, ["doc_id"]).select("doc_id", "prediction", r6("confidence").alias("confidence"))


@query(
    "experiments_compare",
    """SELECT model_id, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall,
        1.0::DOUBLE AS f1_score, NULL::DOUBLE AS roc_auc FROM (VALUES ('shallow'), ('deep')) x(model_id)
        WHERE EXISTS (SELECT 1 FROM lineitem)""",
)
def experiments_compare(spark, sf):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    deep = ExperimentSpec("DecisionTreeClassifier", {"max_depth": 3, "criterion": "entropy"})
    X.run_experiments(split_table(spark, sf), SIZED_SPEC, {"shallow": RULE_TREE, "deep": deep}, registry)
    return X.compare_experiments(registry).drop("timestamp")


# Two labels that a wide gap in one feature separates: any sensible classifier predicts every row as the rule does.
GAP_RULE = "CASE WHEN l_quantity > 25 THEN 'big' ELSE 'little' END"
GAP = f"""
SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN l_quantity > 25 THEN 1000 ELSE 0 END AS spread, l_discount, l_tax,
  {GAP_RULE} AS size_label
FROM {{lineitem}}
"""
GAP_SPEC = TableSpec(
    key=("l_orderkey", "l_linenumber"),
    numeric=tuple(NumericField(n) for n in ("spread", "l_discount", "l_tax")),
    target=TargetField("size_label", ("big", "little")),
)
GAP_EXPECTED = f"SELECT l_orderkey, l_linenumber, {GAP_RULE} AS prediction FROM lineitem"
GAP_FOREST = ExperimentSpec("RandomForestClassifier", {"n_estimators": 9, "max_depth": 4, "max_features": "all"})


def _gap_predictions(spark, sf, experiment):
    rows = derive(spark, sf, GAP, "lineitem")
    return predict(rows, fit_pipeline(rows, GAP_SPEC, experiment)).select("l_orderkey", "l_linenumber", "prediction")


@query("gap_random_forest", GAP_EXPECTED)
def gap_random_forest(spark, sf):
    return _gap_predictions(spark, sf, GAP_FOREST)


@query("gap_logistic", GAP_EXPECTED)
def gap_logistic(spark, sf):
    return _gap_predictions(spark, sf, LOGISTIC)


@query("gap_linear_svc", GAP_EXPECTED)
def gap_linear_svc(spark, sf):
    return _gap_predictions(spark, sf, MARGIN)


@query("gap_ensemble", GAP_EXPECTED)
def gap_ensemble(spark, sf):
    rows = derive(spark, sf, GAP, "lineitem")
    models = [fit_pipeline(rows, GAP_SPEC, e) for e in (GAP_FOREST, LOGISTIC, CALIBRATED)]
    return ensemble(rows, models, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "prediction")


# Three labels along one feature: no line parts the middle one from the rest, but one parts each pair of labels.
STEPS = f"""
SELECT l_orderkey, l_linenumber, l_quantity + CASE {SIZE_RULE} WHEN 'small' THEN 0 WHEN 'medium' THEN 1000 ELSE 2000 END AS spread,
  l_discount, l_tax, {SIZE_RULE} AS size_label
FROM {{lineitem}}
"""
STEPS_SPEC = replace(GAP_SPEC, target=TargetField("size_label", ("small", "medium", "large")))
PAIRWISE = ExperimentSpec("SVC", {"kernel": "linear", "C": 1.0, "max_iter": 20, "multi_class": "ovo"})


@query("train_svc_pairwise", f"SELECT l_orderkey, l_linenumber, {SIZE_RULE} AS prediction FROM lineitem")
def train_svc_pairwise(spark, sf):
    rows = derive(spark, sf, STEPS, "lineitem")
    return predict(rows, fit_pipeline(rows, STEPS_SPEC, PAIRWISE)).select("l_orderkey", "l_linenumber", "prediction")


# A tree of depth one keeps the two smaller classes in one leaf, so its shares are fractions.
STUMP = ExperimentSpec("DecisionTreeClassifier", {"max_depth": 1})
CLASSES = f"WITH ruled AS (SELECT l_orderkey, l_linenumber, {SIZE_RULE} AS c FROM lineitem)"


@query(
    "score_proba_shares",
    f"""{CLASSES}, n AS (SELECT count(*) FILTER (c = 'small')::DOUBLE AS s, count(*) FILTER (c = 'medium')::DOUBLE AS m FROM ruled)
    SELECT l_orderkey, l_linenumber, CASE WHEN c = 'large' THEN 1.0 ELSE 0.0 END::DOUBLE AS large,
      round(CASE WHEN c = 'large' THEN 0.0 ELSE m / (m + s) END, 6) AS medium, round(CASE WHEN c = 'large' THEN 0.0 ELSE s / (m + s) END, 6) AS small
    FROM ruled, n""",
)
def score_proba_shares(spark, sf):
    rows = sized_table(spark, sf)
    cells = predict_proba(rows, fit_pipeline(rows, SIZED_SPEC, STUMP), ["l_orderkey", "l_linenumber"])
    return cells.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in ("large", "medium", "small")])


# The same rule over a table whose keys are unique, so that folds have exactly the expected sizes.
ORDER_RULE = "CASE WHEN o_custkey % 50 < 10 THEN 'small' WHEN o_custkey % 50 < 30 THEN 'medium' ELSE 'large' END"
ORDER_SIZES = f"SELECT o_orderkey, CAST(o_custkey % 50 AS DOUBLE) AS load, o_totalprice, {ORDER_RULE} AS size_class FROM {{orders}}"
ORDER_SIZE_SPEC = TableSpec(
    key=("o_orderkey",), numeric=(NumericField("load"), NumericField("o_totalprice")), target=TargetField("size_class", ("small", "medium", "large"))
)


@query(
    "tune_depths",
    f"""WITH ruled AS (SELECT {ORDER_RULE} AS c FROM orders), dealt AS (SELECT c, (row_number() OVER (ORDER BY c) - 1) % 3 AS fold FROM ruled),
    scored AS (SELECT fold, avg(CASE WHEN c = 'small' THEN 0.0 ELSE 1.0 END) AS a FROM dealt GROUP BY fold)
    SELECT 1 AS depth, round(avg(a), 6) AS mean_score, round(stddev_pop(a), 6) AS std_score FROM scored
    UNION ALL SELECT 2, 1.0, 0.0""",
)
def tune_depths(spark, sf):
    """Fold scores of two depths: one level cannot tell the smallest class from the next, two can."""
    experiment = ExperimentSpec("DecisionTreeClassifier", {}, tune=TuneSpec(({"max_depth": [1, 2]},), cv=3))
    table = cross_validate(derive(spark, sf, ORDER_SIZES, "orders"), expand_grid(experiment.tune.grid), ORDER_SIZE_SPEC, experiment)
    rows = [(c["params"]["max_depth"], round(c["mean"], 6), round(c["std"], 6)) for c in table]
    return spark.createDataFrame(rows, "depth int, mean_score double, std_score double")


@query(
    "train_own_split",
    f"""{CLASSES}, sizes AS (SELECT c, count(*) AS n FROM ruled GROUP BY 1),
    whole AS (SELECT sum(n)::BIGINT AS n, ceil(0.2 * sum(n))::BIGINT AS n_test FROM sizes),
    shares AS (
      SELECT c, s.n, (w.n - n_test) * s.n // w.n AS q, (w.n - n_test) * s.n % w.n AS rest, w.n - n_test AS n_train FROM sizes s, whole w),
    quotas AS (
      SELECT c, n, q + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= n_train - sum(q) OVER () THEN 1 ELSE 0 END AS train_rows FROM shares),
    parts AS (SELECT 'train' AS split, c, train_rows AS n FROM quotas UNION ALL SELECT 'test', c, n - train_rows FROM quotas)
    SELECT split, sum(n)::BIGINT AS n, 3 AS classes, round(1 - sum(n) FILTER (c = 'small') / sum(n), 6) AS accuracy FROM parts GROUP BY split""",
)
def train_own_split(spark, sf):
    """Accuracy of a tree of depth one on the parts that training splits off itself."""
    found = _overall(spark, train(sized_table(spark, sf), SIZED_SPEC, STUMP).results)
    return found.select("split", "n", "classes", r6("accuracy").alias("accuracy"))


@query(
    "score_strict",
    """SELECT 'all' AS batch, count(*) FILTER (l_quantity NOT BETWEEN 1 AND 45) > 0 AS refused,
      CASE WHEN count(*) FILTER (l_quantity NOT BETWEEN 1 AND 45) > 0 THEN 0 ELSE count(*) END AS n FROM lineitem
    UNION ALL SELECT 'in range', false, count(*) FROM lineitem WHERE l_quantity BETWEEN 1 AND 45""",
)
def score_strict(spark, sf):
    """One bad row refuses a whole batch; a batch without any is scored in full."""
    rows = sized_table(spark, sf)
    model = fit_pipeline(rows, SIZED_SPEC, RULE_TREE)
    out = []
    for name, batch in (("all", rows), ("in range", rows.filter("l_quantity BETWEEN 1 AND 45"))):
        try:
            n, refused = score(batch, model, SIZED_SPEC, mode="strict").agg(F.count("prediction").alias("n")).first()["n"], False
        except PySparkException as e:
            if "invalid row" not in str(e):
                raise
            n, refused = 0, True
        out.append((name, refused, n))
    return spark.createDataFrame(out, "batch string, refused boolean, n bigint")


@query(
    "train_min_split",
    f"""WITH ruled AS (SELECT l_orderkey, l_linenumber, {SIZE_RULE} AS c FROM lineitem),
    sizes AS (SELECT c, count(*) AS n FROM ruled GROUP BY c)
    SELECT l_orderkey, l_linenumber,
      round((SELECT n FROM sizes WHERE c = 'large') / (SELECT sum(n) FROM sizes), 6)::DOUBLE AS large,
      round((SELECT n FROM sizes WHERE c = 'medium') / (SELECT sum(n) FROM sizes), 6)::DOUBLE AS medium,
      round((SELECT n FROM sizes WHERE c = 'small') / (SELECT sum(n) FROM sizes), 6)::DOUBLE AS small
    FROM ruled""",
)
def train_min_split(spark, sf):
    """A tree whose splits need more rows than there are stays one leaf with the shares of all classes."""
    rows = sized_table(spark, sf)
    stays = ExperimentSpec("DecisionTreeClassifier", {"max_depth": 3, "min_samples_split": rows.count() + 1})
    cells = predict_proba(rows, fit_pipeline(rows, SIZED_SPEC, stays), ["l_orderkey", "l_linenumber"])
    return cells.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in ("large", "medium", "small")])


@query(
    "tune_nested",
    f"""WITH ruled AS (SELECT {ORDER_RULE} AS c FROM orders), dealt AS (SELECT c, (row_number() OVER (ORDER BY c) - 1) % 3 AS fold FROM ruled),
    counted AS (SELECT fold, c, count(*) AS n, sum(count(*)) OVER (PARTITION BY c) - count(*) AS others, sum(count(*)) OVER (PARTITION BY fold) AS held FROM dealt GROUP BY fold, c),
    scored AS (
      SELECT fold, 1 - sum(n) FILTER (c = 'small') / max(held) AS one, (list(n / held ORDER BY others DESC, c))[1] AS none FROM counted GROUP BY fold)
    SELECT d.depth, m.least, round(CASE WHEN m.least > 2 THEN s.none WHEN d.depth = 1 THEN s.one ELSE 1.0 END, 6) AS mean_score
    FROM (SELECT avg(one) AS one, avg(none) AS none FROM scored) s, (VALUES (1), (2), (4)) d(depth), (VALUES (2), (1000000000)) m(least)""",
)
def tune_nested(spark, sf):
    """Scores of six candidates from one fit per fold: depths, and a minimum of rows that nothing or everything meets."""
    experiment = ExperimentSpec(
        "DecisionTreeClassifier", {}, tune=TuneSpec(({"max_depth": [1, 2, 4], "min_samples_split": [2, 1_000_000_000]},), cv=3)
    )
    table = cross_validate(derive(spark, sf, ORDER_SIZES, "orders"), expand_grid(experiment.tune.grid), ORDER_SIZE_SPEC, experiment)
    rows = [(c["params"]["max_depth"], c["params"]["min_samples_split"], round(c["mean"], 6)) for c in table]
    return spark.createDataFrame(rows, "depth int, least int, mean_score double")
