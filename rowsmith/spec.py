"""Declarative descriptions of a table and of an experiment."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class NumericField:
    """A number column; ``low``/``high`` bound stored rows, ``score_*`` bound scoring input."""

    name: str
    dtype: str = "double"
    low: float | None = None
    high: float | None = None
    score_low: float | None = None
    score_high: float | None = None


@dataclass(frozen=True)
class CategoryField:
    """A text column, optionally with a closed vocabulary and tokens that mean "missing".

    ``sparse`` encodes it as one sparse vector, for vocabularies that are too wide for a column each.
    """

    name: str
    allowed: tuple[str, ...] | None = None
    null_tokens: tuple[str, ...] = ()
    blank_is_null: bool = False
    sparse: bool = False


@dataclass(frozen=True)
class TargetField:
    """The label. With ``by_substring`` the first listed label contained in the text wins."""

    name: str
    allowed: tuple[str, ...] | None = None
    by_substring: bool = False


@dataclass(frozen=True)
class DateYear:
    """Fill a missing year column from a date text column.

    The first format that fits decides. A text that fits none gives a null year; with
    ``flag_unparsable`` it also breaks the rule ``date`` of the year column.
    """

    source: str
    target: str
    formats: tuple[str, ...] = ("M/d/yy", "M/d/yyyy", "yyyy-MM-dd", "yyyy/M/d")
    flag_unparsable: bool = False


@dataclass(frozen=True)
class TableSpec:
    """Everything the operators need to know about one table.

    ``key`` names the columns that identify a row; ``key_type`` casts them, which matters for
    text files.
    """

    key: tuple[str, ...]
    numeric: tuple[NumericField, ...] = ()
    categorical: tuple[CategoryField, ...] = ()
    target: TargetField | None = None
    rename: dict[str, str] = field(default_factory=dict)
    date_year: DateYear | None = None
    key_type: str | None = None

    @property
    def numeric_names(self) -> list[str]:
        return [f.name for f in self.numeric]

    @property
    def categorical_names(self) -> list[str]:
        return [f.name for f in self.categorical]

    @property
    def features(self) -> list[str]:
        return self.numeric_names + self.categorical_names

    @property
    def columns(self) -> list[str]:
        """Features in canonical order, then the target."""
        return self.features + ([self.target.name] if self.target else [])

    def with_features(self, numeric: list[str], categorical: list[str]) -> TableSpec:
        """The same table restricted to chosen feature columns."""
        unknown = set(numeric) - set(self.numeric_names) | set(categorical) - set(self.categorical_names)
        if unknown:
            raise ValueError(f"not in the table specification: {sorted(unknown)}")
        return replace(
            self,
            numeric=tuple(f for f in self.numeric if f.name in numeric),
            categorical=tuple(f for f in self.categorical if f.name in categorical),
        )

    @classmethod
    def from_dict(cls, doc: dict[str, Any]) -> TableSpec:
        """Build a specification from plain data, e.g. a parsed YAML document."""

        def build(kind, item):
            item = {"name": item} if isinstance(item, str) else dict(item)
            for name in ("allowed", "null_tokens", "formats"):
                if item.get(name) is not None:
                    item[name] = tuple(item[name])
            return kind(**item)

        return cls(
            key=tuple(doc["key"]),
            numeric=tuple(build(NumericField, i) for i in doc.get("numeric", ())),
            categorical=tuple(build(CategoryField, i) for i in doc.get("categorical", ())),
            target=build(TargetField, doc["target"]) if doc.get("target") else None,
            rename=dict(doc.get("rename", {})),
            date_year=build(DateYear, doc["date_year"]) if doc.get("date_year") else None,
            key_type=doc.get("key_type"),
        )


@dataclass(frozen=True)
class TuneSpec:
    """Grid search: a list of parameter dictionaries, fold count, score, threads."""

    grid: tuple[dict[str, list[Any]], ...]
    cv: int = 5
    scoring: str = "accuracy"
    parallelism: int = 2
    # One fit serves all depths, forest sizes and split minimums of trees.
    nested: bool = True


@dataclass(frozen=True)
class ExperimentSpec:
    """One run: which model, with which parameters, on which split."""

    model: str = "RandomForestClassifier"
    params: dict[str, Any] = field(default_factory=dict)
    seed: int = 42
    test_size: float = 0.2
    stratify: bool = True
    preprocess: dict[str, Any] = field(default_factory=dict)
    numeric: tuple[str, ...] | None = None
    categorical: tuple[str, ...] | None = None
    tune: TuneSpec | None = None

    def restrict(self, spec: TableSpec) -> TableSpec:
        """Apply the feature lists of this experiment, if it names any."""
        if self.numeric is None and self.categorical is None:
            return spec
        return spec.with_features(
            spec.numeric_names if self.numeric is None else list(self.numeric),
            spec.categorical_names if self.categorical is None else list(self.categorical),
        )

    @classmethod
    def from_dict(cls, doc: dict[str, Any] | None) -> ExperimentSpec:
        """Read the sections ``seed``, ``features`` and ``model``; unknown keys are ignored."""
        doc = doc or {}
        features, model = doc.get("features") or {}, doc.get("model") or {}
        tune = model.get("tune")
        numeric, categorical = features.get("numeric_features"), features.get("categorical_features")
        return cls(
            model=model.get("name", cls.model),
            params=dict(model.get("params") or {}),
            seed=doc.get("seed", cls.seed),
            test_size=features.get("test_size", cls.test_size),
            stratify=features.get("stratify", cls.stratify),
            preprocess=dict(doc.get("preprocess") or {}),
            numeric=None if numeric is None else tuple(numeric),
            categorical=None if categorical is None else tuple(categorical),
            tune=None
            if tune is None
            else TuneSpec(
                grid=tuple(tune.get("grid") or ()),
                cv=tune.get("cv", TuneSpec.cv),
                scoring=tune.get("scoring", TuneSpec.scoring),
                parallelism=max(1, tune.get("parallelism", TuneSpec.parallelism)),
                nested=tune.get("nested", TuneSpec.nested),
            ),
        )

    @classmethod
    def from_yaml(cls, path: str) -> ExperimentSpec:
        """Read a YAML file; a missing file gives the defaults."""
        import yaml

        try:
            with open(path, encoding="utf-8") as handle:
                return cls.from_dict(yaml.safe_load(handle))
        except FileNotFoundError:
            return cls()
