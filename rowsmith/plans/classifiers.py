"""Classifiers by name, with the parameter names of the tabular classification world."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.plans.trees import TREES, least_to_split, with_least_split
from rowsmith.session import Scratch

# Working columns carry a prefix, so a table may have columns called label or prediction.
FEATURES, LABEL, WEIGHT = "rs_features", "rs_label", "rs_weight"
PREDICTION, PROBABILITY, MARGINS = "rs_prediction", "rs_probability", "rs_margins"
COLUMNS = {
    "featuresCol": FEATURES,
    "labelCol": LABEL,
    "predictionCol": PREDICTION,
    "probabilityCol": PROBABILITY,
    "rawPredictionCol": MARGINS,
}

# Equal rows are merged for fitting if at most one row in so many is left.
MERGED = 4

# Spark refuses deeper trees; "no limit" means this depth.
MAX_TREE_DEPTH = 30

# Accepted without effect: they steer single-machine execution and change no model.
IGNORED = {
    "RandomForestClassifier": {"n_jobs", "verbose", "oob_score", "warm_start"},
    "DecisionTreeClassifier": set(),
    "LogisticRegression": {"n_jobs", "verbose", "solver", "random_state", "warm_start"},
    "SVC": {"cache_size", "shrinking", "verbose", "random_state", "decision_function_shape"},
}
# They would change the model and have no counterpart: refused, unless ``ignore_unmapped`` is among the parameters.
UNMAPPED = {
    "DecisionTreeClassifier": {"splitter"},
    "LogisticRegression": {"multi_class", "dual"},
    "SVC": {"gamma", "coef0"},
}
# Values of unmapped parameters that ask for what happens anyway.
HARMLESS = {"splitter": (None, "best"), "multi_class": (None, "auto", "multinomial"), "dual": (None, False)}

Factory = Callable[[dict[str, Any], int, int, int], Estimator]


def _tree_options(params: dict[str, Any], seed: int) -> dict[str, Any]:
    """Options shared by a single tree and a forest; consumes what it understands."""
    depth = params.pop("max_depth", None)
    if depth is not None and int(depth) > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth={depth} is beyond the deepest tree possible, {MAX_TREE_DEPTH}; None asks for that one")
    params.pop("min_samples_split", None)  # see fit_classifier_stage
    impurity = params.pop("criterion", "gini")
    state = params.pop("random_state", None)
    return {
        "maxDepth": MAX_TREE_DEPTH if depth is None else int(depth),
        "minInstancesPerNode": int(params.pop("min_samples_leaf", 1)),
        "minInfoGain": float(params.pop("min_impurity_decrease", 0.0)),
        "impurity": "entropy" if impurity == "log_loss" else impurity,
        "maxBins": int(params.pop("max_bins", 128)),
        "seed": seed if state is None else int(state),
    }


def takes_merged_rows(name: str, params: dict[str, Any], rows: int) -> bool:
    """Whether equal rows can stand as one with their number as its weight: losses add up, but leaves and draws count rows."""
    if name == "DecisionTreeClassifier":
        return int(params.get("min_samples_leaf", 1)) <= 1 and least_to_split(params.get("min_samples_split"), rows) <= 2
    return name == "SVC"


def merged_rows(frame: DataFrame, rows: int, scratch: Scratch) -> DataFrame | None:
    """The distinct labels and features with their weights, if at most one of ``MERGED`` rows is left; else None."""
    distinct = frame.agg(F.approx_count_distinct(F.xxhash64(LABEL, FEATURES)).alias("n")).first()["n"]
    if distinct * MERGED > rows:
        return None
    weight = F.col(WEIGHT) if WEIGHT in frame.columns else F.lit(1.0)
    return scratch.write(frame.groupBy(LABEL, FEATURES).agg(F.sum(weight).alias(WEIGHT)), "merged")


def fit_classifier_stage(estimator: Estimator, frame: DataFrame, name: str, params: dict[str, Any], rows: int):
    """The fitted classifier. A minimum of rows for a split is applied to the fitted trees.

    Where rows repeat, iterations read each distinct row once.
    """
    with Scratch(frame.sparkSession, "fit") as scratch:
        merged = merged_rows(frame, rows, scratch) if takes_merged_rows(name, params, rows) else None
        if merged is not None:
            _weighted(estimator)
        model = estimator.fit(frame if merged is None else merged)
    if name not in TREES:
        return model
    return with_least_split(model, least_to_split(params.get("min_samples_split"), rows), frame.sparkSession)


def _random_forest(params: dict[str, Any], seed: int, rows: int, classes: int) -> Estimator:
    choice = params.pop("max_features", "sqrt")
    options = {
        "numTrees": int(params.pop("n_estimators", 100)),
        "featureSubsetStrategy": "all" if choice is None else str(choice),
        "bootstrap": bool(params.pop("bootstrap", True)),
        # More memory for node statistics means fewer passes over the rows.
        "maxMemoryInMB": 1024,
    }
    share = params.pop("max_samples", None)
    if share is not None:
        options["subsamplingRate"] = float(share) if isinstance(share, float) else share / rows
    return RandomForestClassifier(**options, **_tree_options(params, seed))


def _decision_tree(params: dict[str, Any], seed: int, rows: int, classes: int) -> Estimator:
    return DecisionTreeClassifier(**_tree_options(params, seed))


def _logistic(params: dict[str, Any], seed: int, rows: int, classes: int) -> Estimator:
    penalty = params.pop("penalty", "l2")
    strength = float(params.pop("C", 1.0))
    mix = {"l1": 1.0, "l2": 0.0, None: 0.0, "none": 0.0}
    mix["elasticnet"] = float(params.pop("l1_ratio", None) or 0.0)
    if penalty not in mix:
        raise ValueError(f"unknown penalty {penalty!r}")
    return LogisticRegression(
        # The loss here is a mean over rows, so the penalty is scaled by their number.
        regParam=0.0 if penalty in (None, "none") else 1.0 / (strength * rows),
        elasticNetParam=mix[penalty],
        maxIter=int(params.pop("max_iter", 100)),
        tol=float(params.pop("tol", 1e-4)),
        fitIntercept=bool(params.pop("fit_intercept", True)),
        standardization=False,
    )


def _support_vectors(params: dict[str, Any], seed: int, rows: int, classes: int) -> Estimator:
    """Linear margins; a polynomial kernel expands the features.

    ``multi_class`` chooses between ``ovr`` (one class against the rest) and ``ovo`` (a machine for each pair of
    classes; the class with most votes wins). With ``probability`` a logistic fit on the margins gives probabilities beside them.
    """
    kernel = params.pop("kernel", None)
    if kernel is None:
        raise ValueError("name the kernel, 'linear' or 'poly'; there is no default")
    if kernel not in ("linear", "poly"):
        raise ValueError(f"kernel {kernel!r} needs all pairs of rows; use 'linear' or 'poly'")
    limit = int(params.pop("max_iter", -1))
    degree = int(params.pop("degree", 3))
    scheme = params.pop("multi_class", None) or "ovr"
    if scheme not in ("ovr", "ovo"):
        raise ValueError(f"unknown multi_class {scheme!r}; use 'ovr' or 'ovo'")
    source = FEATURES if kernel == "linear" else "rs_poly"
    cost = float(params.pop("C", 1.0))
    margin = LinearSVC(
        regParam=1.0 / (cost * rows),
        maxIter=100 if limit < 0 else limit,
        tol=float(params.pop("tol", 1e-3)),
        standardization=False,
    )
    # A stored one-against-the-rest model forgets this name unless it is the default.
    margins = "rawPrediction"
    machine = OneVsRest(
        classifier=_wire(margin, featuresCol=source, rawPredictionCol=margins),
        # The classes share one cached input and are fitted side by side.
        parallelism=max(1, min(classes, 8)),
    )
    stages: list = [_wire(machine, featuresCol=source, rawPredictionCol=margins)]
    if scheme == "ovo":
        stages = [OneVsOne(margin, cost, classes, source, margins)]
    if kernel == "poly":
        stages.insert(0, PolynomialExpansion(degree=degree, inputCol=FEATURES, outputCol=source))
    if params.pop("probability", False):
        calibrate = LogisticRegression()
        stages.append(
            _wire(calibrate, featuresCol=margins, predictionCol="rs_calibrated", rawPredictionCol="rs_calibrated_margins")
        )
    return stages[0] if len(stages) == 1 else Pipeline(stages=stages)


class OneVsOne(Estimator):
    """A machine for every pair of classes, fitted on the rows of the two alone.

    Each machine votes for one class of its pair. The class with most votes wins, the first one on a tie. The fitted
    stages are native: machines, a vector of all their margins in ``margins``, and the count of votes.
    """

    def __init__(self, machine: LinearSVC, cost: float, classes: int, features: str, margins: str):
        super().__init__()
        self.machine, self.cost, self.classes = machine, cost, classes
        self.features, self.margins, self.weight = features, margins, None

    def setWeightCol(self, name: str) -> OneVsOne:
        self.weight = name
        return self

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        size = F.lit(1.0) if self.weight is None else F.col(self.weight)
        # One row per class.
        sizes = {int(r["c"]): r["n"] for r in dataset.groupBy(F.col(LABEL).alias("c")).agg(F.sum(size).alias("n")).collect()}
        # A label that no training row has gets no votes.
        pairs = [(low, high) for low in range(self.classes) for high in range(low + 1, self.classes) if low in sizes and high in sizes]

        def fit(pair: tuple[int, int]) -> LinearSVCModel:
            low, high = pair
            name = f"rs_pair_{low}_{high}"
            # The penalty is relative to the mean loss over the pair's own rows.
            one = self.machine.copy({self.machine.regParam: 1.0 / (self.cost * (sizes[low] + sizes[high]))})
            one.setFeaturesCol(self.features).setLabelCol("rs_upper").setPredictionCol(name).setRawPredictionCol(f"{name}_margin")
            if self.weight is not None:
                one.setWeightCol(self.weight)
            rows = dataset.filter(F.col(LABEL).isin(low, high))
            return one.fit(rows.withColumn("rs_upper", (F.col(LABEL) == high).cast("double")))

        # The pairs share the input and are fitted side by side, each on its own rows.
        with ThreadPool(max(1, min(len(pairs), 8))) as pool:
            stages: list = pool.map(inheritable_thread_target(dataset.sparkSession)(fit), pairs)
        votes = {c: ["0"] for c in range(max(1, self.classes))}
        for low, high in pairs:
            votes[low].append(f"CAST(1 - rs_pair_{low}_{high} AS INT)")
            votes[high].append(f"CAST(rs_pair_{low}_{high} AS INT)")
        machines = [m.getPredictionCol() for m in stages]
        if machines:
            stages.append(VectorAssembler(inputCols=[f"{m}_margin" for m in machines], outputCol=self.margins))
        else:  # one class only: it is always predicted
            votes[min(sizes, default=0)] = ["1"]
        counted = ", ".join(" + ".join(votes[c]) for c in sorted(votes))
        helpers = ", ".join(["rs_votes", *machines, *[f"{m}_margin" for m in machines]])
        winner = "CAST(array_position(rs_votes, array_max(rs_votes)) - 1 AS DOUBLE)"
        tally = f"SELECT * EXCEPT ({helpers}), {winner} AS {PREDICTION} FROM (SELECT *, array({counted}) AS rs_votes FROM __THIS__)"
        return PipelineModel([*stages, SQLTransformer(statement=tally)])


def _wire(stage: Estimator, **other: str) -> Estimator:
    """Connect a classifier to the working columns, with ``other`` ones where given."""
    for name, column in {**COLUMNS, **other}.items():
        if stage.hasParam(name):
            stage.set(stage.getParam(name), column)
    return stage


CLASSIFIERS: dict[str, Factory] = {
    "RandomForestClassifier": _random_forest,
    "LogisticRegression": _logistic,
    "DecisionTreeClassifier": _decision_tree,
    "SVC": _support_vectors,
}


def register_classifier(name: str, factory: Factory) -> None:
    """Add a classifier. The factory gets parameters, seed, training rows and class count, takes
    what it understands out of the parameters and returns an unfitted estimator."""
    CLASSIFIERS[name] = factory


def make_classifier(
    name: str, params: dict[str, Any], seed: int, rows: int, classes: int, weight: float | None = None
) -> Estimator:
    """An unfitted classifier. Unknown names and unmapped parameters raise.

    ``weight`` is the sum of all row weights, where rows are weighted.
    """
    if name not in CLASSIFIERS:
        raise ValueError(f"model {name!r} is not supported; available: {sorted(CLASSIFIERS)}")
    left = {k: v for k, v in params.items() if k not in IGNORED.get(name, ()) and k != "ignore_unmapped"}
    # A linear margin has no use for what shapes a kernel.
    harmless = HARMLESS | ({"gamma": (left["gamma"],)} if "gamma" in left and left.get("kernel") == "linear" else {})
    unmapped = sorted(k for k in UNMAPPED.get(name, ()) if k in left and left[k] not in harmless.get(k, ()))
    if unmapped and not params.get("ignore_unmapped"):
        raise ValueError(f"{name} has no counterpart for {unmapped}; pass ignore_unmapped=True to train without")
    for k in UNMAPPED.get(name, ()):
        left.pop(k, None)
    weighting = left.pop("class_weight", None)
    # A penalty is relative to a mean loss over weights; everything else counts rows.
    penalised = name in ("LogisticRegression", "SVC") and weight is not None
    estimator = CLASSIFIERS[name](left, seed, weight if penalised else rows, classes)
    if left:
        raise ValueError(f"parameters without a counterpart for {name}: {sorted(left)}")
    if not isinstance(estimator, (Pipeline, OneVsRest, OneVsOne)):
        _wire(estimator)
    if weighting is not None:
        _weighted(estimator)
    return estimator


def _weighted(estimator: Estimator) -> None:
    for stage in estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]:
        if hasattr(stage, "setWeightCol"):
            stage.setWeightCol(WEIGHT)


def class_weights(weighting: Any, counts: dict[str, int]) -> dict[str, float]:
    """Weight per label: ``balanced`` is inverse to its share, a dictionary is taken as it is."""
    if weighting == "balanced":
        total = sum(counts.values())
        return {c: total / (len(counts) * n) for c, n in counts.items()}
    return {c: float(weighting.get(c, 1.0)) for c in counts}
