"""Impute, standardise and one-hot encode, fitted on training rows only.

Fitting takes one aggregate over all number columns and one over all text columns. The fitted
state is a handful of numbers and vocabularies, which become literals in a single projection,
so transforming is map-only. Columns that the table specification declares sparse go through Spark's
indexer and sparse one-hot encoder instead of one dense column per category; names and cells are the
same. A dense column that is too wide raises, it never changes its form by itself.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field, replace

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions.expressions import nan_to_null
from rowsmith.operators.clean import quote
from rowsmith.operators.statistics import medians, modes, moments, value_counts
from rowsmith.spec import TableSpec

# Categories of a dense column, and of a sparse one, whose vocabulary each task gets.
MAX_DENSE_CATEGORIES = 256
MAX_SPARSE_CATEGORIES = 1_000_000
# Counted values of all columns that are collected at once; beyond it they are looked at column by column.
VOCABULARY_BOUND = 10_000


@dataclass(frozen=True)
class NumberState:
    name: str
    fill: float
    mean: float
    std: float


@dataclass(frozen=True)
class CategoryState:
    """A ``sparse`` column is encoded by Spark ML stages."""

    name: str
    fill: str | None
    categories: list[str]
    sparse: bool = False


def sql_number(value: float) -> str:
    return f"({value!r}D)"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class FittedPreprocessor:
    numeric: list[NumberState]
    categorical: list[CategoryState]
    drop_first: bool
    handle_unknown: str
    numeric_strategy: str
    categorical_strategy: str
    wide_stages: list[Transformer] = field(default_factory=list)
    wide_outputs: list[str] = field(default_factory=list)
    wide_helpers: list[str] = field(default_factory=list)

    def _kept(self, state: CategoryState) -> list[str]:
        return state.categories[1 if self.drop_first else 0 :]

    def _category_names(self, sparse: bool) -> list[str]:
        return [f"{s.name}_{c}" for s in self.categorical if s.sparse == sparse for c in self._kept(s)]

    def _dense_names(self) -> list[str]:
        return [s.name for s in self.numeric] + self._category_names(False)

    def feature_names(self) -> list[str]:
        """Number columns, then ``column_category`` for each kept category, sparse columns last.

        This is the order of the cells of the assembled vector.
        """
        return self._dense_names() + self._category_names(True)

    def _sql(self) -> list[str]:
        """One SQL expression per dense output feature."""
        out = []
        for s in self.numeric:
            cell = f"CAST({quote(s.name)} AS DOUBLE)"
            filled = f"coalesce(nanvl({cell}, CAST(NULL AS DOUBLE)), {sql_number(s.fill)})"
            out.append(f"({filled} - {sql_number(s.mean)}) / {sql_number(s.std)}")
        for s in self.categorical:
            if s.sparse:
                continue
            cell = f"CAST({quote(s.name)} AS STRING)"
            if s.fill is not None:
                cell = f"coalesce({cell}, {sql_text(s.fill)})"
            guard = ""
            if self.handle_unknown == "error":
                known = ", ".join(sql_text(c) for c in s.categories)
                message = f"concat('unknown category in {s.name}: ', coalesce({cell}, 'NULL'))"
                guard = f"WHEN NOT coalesce({cell} IN ({known}), false) THEN CAST(raise_error({message}) AS DOUBLE) "
            for c in self._kept(s):
                out.append(f"CASE {guard}WHEN {cell} = {sql_text(c)} THEN 1.0D ELSE 0.0D END")
        return out

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """``keep`` columns, then one DOUBLE column per feature (a sparse column as the vector ``column_onehot``)."""
        for stage in self.wide_stages:
            df = stage.transform(df)
        dense = [F.expr(e).alias(n) for e, n in zip(self._sql(), self._dense_names())]
        return df.select(*[F.col(quote(k)) for k in keep or []], *dense, *self.wide_outputs)

    def impute(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Only the missing cells filled, original scale and text kept."""
        numbers = [
            F.coalesce(nan_to_null(F.col(quote(s.name)).cast("double")), F.lit(s.fill)).alias(s.name)
            for s in self.numeric
        ]
        texts = [F.coalesce(F.col(quote(s.name)), F.lit(s.fill)).alias(s.name) for s in self.categorical]
        return df.select(*[F.col(quote(k)) for k in keep or []], *numbers, *texts)

    def stages(self, output: str = "features") -> list[Transformer]:
        """Native, persistable Spark ML stages that end in a vector column."""
        names = [f"rs_x{i}" for i in range(len(self._sql()))]
        items = ", ".join(f"{e} AS {n}" for e, n in zip(self._sql(), names))
        stages: list[Transformer] = list(self.wide_stages)
        if items:
            stages.append(SQLTransformer(statement=f"SELECT *, {items} FROM __THIS__"))
        stages.append(VectorAssembler(inputCols=names + self.wide_outputs, outputCol=output))
        helpers = ", ".join(names + [quote(c) for c in self.wide_helpers + self.wide_outputs])
        stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({helpers}) FROM __THIS__"))
        return stages

    def info(self, spark: SparkSession) -> DataFrame:
        """Tidy table ``(feature, statistic, value, text)`` of everything that was fitted."""
        rows = []
        for s in self.numeric:
            rows += [(s.name, "fill", s.fill, None), (s.name, "mean", s.mean, None), (s.name, "scale", s.std, None)]
        for s in self.categorical:
            rows.append((s.name, "fill", None, s.fill))
            rows += [(s.name, "category", float(i), c) for i, c in enumerate(s.categories)]
        rows += [(name, "output", float(i), None) for i, name in enumerate(self.feature_names())]
        return spark.createDataFrame(rows, "feature string, statistic string, value double, text string")


class Preprocessor:
    """Options of the preprocessing step. ``fit`` returns a ``FittedPreprocessor``."""

    def __init__(
        self,
        spec: TableSpec,
        numeric_strategy: str = "mean",
        numeric_fill: float = 0.0,
        categorical_strategy: str = "constant",
        categorical_fill: str = "Missing",
        handle_unknown: str = "ignore",
        drop_first: bool = False,
        max_dense: int = MAX_DENSE_CATEGORIES,
        max_sparse: int = MAX_SPARSE_CATEGORIES,
    ):
        if numeric_strategy not in ("mean", "median", "most_frequent", "constant"):
            raise ValueError(f"unknown numeric strategy {numeric_strategy!r}")
        if categorical_strategy not in ("most_frequent", "constant"):
            raise ValueError(f"unknown categorical strategy {categorical_strategy!r}")
        if handle_unknown not in ("ignore", "error"):
            raise ValueError(f"unknown handling {handle_unknown!r}")
        self.spec = spec
        self.numeric_strategy = numeric_strategy
        self.numeric_fill = numeric_fill
        self.categorical_strategy = categorical_strategy
        self.categorical_fill = categorical_fill
        self.handle_unknown = handle_unknown
        self.drop_first = drop_first
        self.max_dense = max_dense
        self.max_sparse = max_sparse

    def fit(self, train: DataFrame) -> FittedPreprocessor:
        numeric = self._fit_numbers(train)
        categorical = self._fit_categories(train)
        wide_stages, wide_outputs, wide_helpers, vocabularies = self._fit_wide(train, categorical)
        categorical = [replace(s, categories=vocabularies.get(s.name, s.categories)) for s in categorical]
        return FittedPreprocessor(
            numeric,
            categorical,
            self.drop_first,
            self.handle_unknown,
            self.numeric_strategy,
            self.categorical_strategy,
            wide_stages,
            wide_outputs,
            wide_helpers,
        )

    def _fit_numbers(self, train: DataFrame) -> list[NumberState]:
        names = [n for n in self.spec.numeric_names if n in train.columns]
        measured = moments(train, names)
        if self.numeric_strategy == "constant":
            fills = dict.fromkeys(names, self.numeric_fill)
        else:
            # A column without a single value has nothing to learn from and is left out.
            names = [n for n in names if measured[n].filled]
            if self.numeric_strategy == "mean":
                fills = {n: measured[n].mean for n in names}
            elif self.numeric_strategy == "median":
                fills = medians(train, names, measured)
            else:
                fills = modes(train, names, "double")
        return [NumberState(n, fills[n], *scale_after_fill(measured[n], fills[n])) for n in names]

    def _fit_categories(self, train: DataFrame) -> list[CategoryState]:
        names = [n for n in self.spec.categorical_names if n in train.columns]
        if not names:
            return []
        sparse = {f.name for f in self.spec.categorical if f.sparse}
        counted = value_counts(train, names, "string")
        rows = counted.limit(VOCABULARY_BOUND + 1).collect()
        if len(rows) <= VOCABULARY_BOUND:
            seen = {n: {r["value"]: r["n"] for r in rows if r["feature"] == n} for n in names}
            sizes = {n: len(seen[n]) for n in names}
            most = {
                n: min((v for v in seen[n] if v is not None), key=lambda v, n=n: (-seen[n][v], v), default=None)
                for n in names
            }
        else:
            sizes = {r["feature"]: r["n"] for r in counted.groupBy("feature").agg(F.count("*").alias("n")).collect()}
            self._check_width(sizes, sparse)
            narrow = counted.filter(~F.col("feature").isin(*sparse)) if sparse else counted
            seen = {n: {} for n in names}
            for r in narrow.collect():
                seen[r["feature"]][r["value"]] = r["n"]
            most = modes(train, names, "string")
        self._check_width(sizes, sparse)
        states = []
        for n in names:
            fill = self.categorical_fill if self.categorical_strategy == "constant" else most[n]
            if n in sparse:
                states.append(CategoryState(n, fill, [], True))
                continue
            values = {fill if v is None else v for v in seen[n]} - {None}
            states.append(CategoryState(n, fill, sorted(values)))
        return states

    def _check_width(self, sizes: dict[str, int], sparse: set[str]) -> None:
        for name, n in sizes.items():
            if name not in sparse and n > self.max_dense:
                raise ValueError(f"{name!r} has {n} values, more than {self.max_dense} columns; declare it sparse or raise max_dense")
            if name in sparse and n > self.max_sparse:
                raise ValueError(f"{name!r} has {n} values, more than the {self.max_sparse} that every task may be sent")

    def _fit_wide(
        self, train: DataFrame, states: list[CategoryState]
    ) -> tuple[list[Transformer], list[str], list[str], dict[str, list[str]]]:
        """Indexer and sparse encoder for sparse columns; unknown values encode as all zeros.

        The last part of the result is the vocabulary of each.
        """
        wide = [(i, s) for i, s in enumerate(states) if s.sparse]
        if not wide:
            return [], [], [], {}
        items = ", ".join(
            f"coalesce(CAST({quote(s.name)} AS STRING), {sql_text(s.fill)}) AS rs_w{i}" for i, s in wide
        )
        fill = SQLTransformer(statement=f"SELECT *, {items} FROM __THIS__")
        unknown = "error" if self.handle_unknown == "error" else "keep"
        index = StringIndexer(
            inputCols=[f"rs_w{i}" for i, _ in wide],
            outputCols=[f"rs_i{i}" for i, _ in wide],
            stringOrderType="alphabetAsc",
            handleInvalid=unknown,
        ).fit(fill.transform(train))
        encoded = [f"rs_e{i}" if self.drop_first else f"{s.name}_onehot" for i, s in wide]
        indexed = index.transform(fill.transform(train))
        encode = OneHotEncoder(
            inputCols=[f"rs_i{i}" for i, _ in wide],
            outputCols=encoded,
            # "keep" gives unknown values an index of their own, which is the one dropped.
            dropLast=unknown == "keep",
        ).fit(indexed)
        stages: list[Transformer] = [fill, index, encode]
        outputs = [f"{s.name}_onehot" for _, s in wide]
        if self.drop_first:
            for name, out, labels in zip(encoded, outputs, index.labelsArray):
                stages.append(VectorSlicer(inputCol=name, outputCol=out, indices=list(range(1, len(labels)))))
        helpers = [f"rs_{p}{i}" for i, _ in wide for p in ("wie" if self.drop_first else "wi")]
        return stages, outputs, helpers, {s.name: list(labels) for (_, s), labels in zip(wide, index.labelsArray)}


def scale_after_fill(m, fill: float) -> tuple[float, float]:
    """Mean and population deviation of the column once its missing cells hold ``fill``.

    They follow from the moments of the filled cells, so no second scan is needed. A constant
    column is divided by 1, and so is one whose spread rounding cannot tell from 0.
    """
    n, k = m.filled, m.missing
    if n + k == 0 or n == 0:
        return (fill, 1.0)
    if k == 0:
        mean, low, high = m.mean, m.low, m.high
        variance = m.variance
    else:
        mean = m.mean + (fill - m.mean) * (k / (n + k))
        variance = (n * (m.variance + (m.mean - mean) ** 2) + k * (fill - mean) ** 2) / (n + k)
        low, high = min(m.low, fill), max(m.high, fill)
    if low == high:
        return low, 1.0
    return mean, 1.0 if is_constant(variance, mean, n + k) else math.sqrt(variance)


def is_constant(variance: float, mean: float, rows: int) -> bool:
    """Whether a variance is within what rounding the sums of ``rows`` cells can leave of 0."""
    unit = sys.float_info.epsilon
    return variance <= rows * unit * variance + (rows * mean * unit) ** 2


class PreprocessEstimator(Estimator):
    """The preprocessor as a Spark ML stage; the fitted model holds native stages only."""

    def __init__(self, preprocessor: Preprocessor, output: str = "features"):
        super().__init__()
        self.preprocessor = preprocessor
        self.output = output

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return PipelineModel(self.preprocessor.fit(dataset).stages(self.output))


def preprocess(
    train: DataFrame, test: DataFrame | None, spec: TableSpec, keep: list[str] | None = None, **options
) -> tuple[DataFrame, DataFrame | None, FittedPreprocessor]:
    """Fit on the training rows and transform both sides with that state."""
    fitted = Preprocessor(spec, **options).fit(train)
    return (
        fitted.transform(train, keep),
        None if test is None else fitted.transform(test, keep),
        fitted,
    )
