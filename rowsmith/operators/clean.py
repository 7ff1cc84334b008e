"""Rename, canonicalise and check rows against a ``TableSpec``.

Everything is one projection over the input: no shuffle, no second scan. Bad rows either
stop the job (``strict``) or keep a list of what is wrong with them (``flag``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.expressions import (
    first_contained,
    nan_to_null,
    tokens_to_null,
    year_from_text,
)
from rowsmith.spec import CategoryField, NumericField, TableSpec, TargetField

VIOLATION = T.ArrayType(
    T.StructType(
        [
            T.StructField("field", T.StringType()),
            T.StructField("rule", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    )
)


# The date text of rows whose date fits no format, where the specification asks for it.
BAD_DATE = "rs_bad_date"


@dataclass(frozen=True)
class _Checked:
    """A canonical value and, per rule name, the condition under which the rule is broken."""

    name: str
    raw: Column
    value: Column
    broken: dict[str, Column]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rename_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply the header mapping; headers outside the mapping keep their names."""
    return df.withColumnsRenamed({old: new for old, new in spec.rename.items() if old in df.columns})


def derive_year(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the year column from the date text, only where the table has no year itself."""
    rule = spec.date_year
    if rule is None or rule.source not in df.columns or rule.target in df.columns:
        return df
    text = F.col(quote(rule.source)).cast("string")
    df = df.withColumn(rule.target, year_from_text(text, rule.formats))
    if rule.flag_unparsable:
        df = df.withColumn(BAD_DATE, F.when(text.rlike(r"\S") & F.col(quote(rule.target)).isNull(), text))
    return df


def project_available(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, features and target in canonical order; columns the table lacks are left out."""
    wanted = list(spec.key) + spec.columns
    return df.select(*[F.col(quote(c)) for c in wanted if c in df.columns])


def features_and_target(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that have a target, with key, features and target only."""
    return project_available(df, spec).filter(F.col(quote(spec.target.name)).isNotNull())


def _outside(number: Column, low: float | None, high: float | None) -> Column | None:
    """Beyond the given bounds, which are themselves allowed; None if there are no bounds."""
    if low is not None and high is not None:
        return ~number.between(F.lit(low), F.lit(high))
    if low is not None:
        return number < F.lit(low)
    return None if high is None else number > F.lit(high)


def _check_number(f: NumericField, stored: T.DataType) -> _Checked:
    raw = F.col(quote(f.name))
    broken = {}
    number = raw
    if isinstance(stored, (T.DoubleType, T.FloatType)):
        number = nan_to_null(raw.cast("double"))
    elif not isinstance(stored, T.NumericType):
        number = nan_to_null(raw.try_cast("double"))
        broken["type"] = raw.isNotNull() & raw.try_cast("double").isNull()
    value = number if f.dtype == "double" and number is not raw else number.try_cast(f.dtype)
    if f.dtype in ("int", "bigint") and not isinstance(stored, T.IntegralType):
        fraction = number != F.floor(number)
        broken["type"] = broken["type"] | fraction if "type" in broken else fraction
    if f.dtype in ("int", "bigint"):
        # A number that the column's type cannot hold is wrong, not missing.
        beyond = number.isNotNull() & value.isNull()
        broken["type"] = F.coalesce(broken["type"], F.lit(False)) | beyond if "type" in broken else beyond
    outside = _outside(number, f.low, f.high)
    if outside is not None:
        broken["range"] = outside
    return _Checked(f.name, raw, value, broken)


def _check_category(f: CategoryField) -> _Checked:
    raw = F.col(quote(f.name)).cast("string")
    value = tokens_to_null(raw, f.null_tokens, f.blank_is_null)
    broken = {} if f.allowed is None else {"vocabulary": ~value.isin(*f.allowed)}
    return _Checked(f.name, raw, value, broken)


def _check_target(f: TargetField) -> _Checked:
    raw = F.col(quote(f.name)).cast("string")
    value = first_contained(raw, f.allowed) if f.by_substring and f.allowed else raw
    broken = {} if f.allowed is None else {"vocabulary": ~value.isin(*f.allowed)}
    return _Checked(f.name, raw, value, broken)


def _checks(df: DataFrame, spec: TableSpec) -> list[_Checked]:
    found = [_check_number(f, df.schema[f.name].dataType) for f in spec.numeric if f.name in df.columns]
    found += [_check_category(f) for f in spec.categorical if f.name in df.columns]
    if spec.target and spec.target.name in df.columns:
        found.append(_check_target(spec.target))
    return found


def violation_array(checks: list[_Checked]) -> Column:
    """Array of ``(field, rule, value)``, one entry per broken rule."""
    none = F.array().cast(VIOLATION)
    entries = [
        F.when(
            condition,
            F.array(
                F.struct(
                    F.lit(c.name).alias("field"),
                    F.lit(rule).alias("rule"),
                    c.raw.cast("string").alias("value"),
                )
            ),
        ).otherwise(none)
        for c in checks
        for rule, condition in c.broken.items()
    ]
    return F.concat(none, *entries)


def _once(c: Column) -> Column:
    """Evaluate ``c`` once per row: a later filter on it is not pushed below a generator, where
    it would be inlined and every expression it is made of computed several times more."""
    return F.explode(F.array(c))


def canonicalise(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, typed canonical columns and the ``violations`` of every row."""
    dated = derive_year(rename_columns(df, spec), spec)
    table = project_available(dated, spec)
    if BAD_DATE in dated.columns:
        table = dated.select(*[F.col(quote(c)) for c in table.columns], BAD_DATE)
    keys = [F.col(quote(k)) for k in spec.key if k in table.columns]
    if spec.key_type:
        keys = [k.cast(spec.key_type).alias(name) for k, name in zip(keys, spec.key)]
    checks = _checks(table, spec)
    if BAD_DATE in table.columns:
        for i, c in enumerate(checks):
            if c.name == spec.date_year.target:
                checks[i] = _Checked(c.name, F.coalesce(F.col(BAD_DATE), c.raw.cast("string")), c.value, {"date": F.col(BAD_DATE).isNotNull(), **c.broken})
    return table.select(
        *keys,
        *[c.value.alias(c.name) for c in checks],
        _once(violation_array(checks)).alias("violations"),
    )


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size("violations") == 0).drop("violations")


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size("violations") > 0)


def fail_on_violation(flagged: DataFrame) -> DataFrame:
    """Stop the job at the first bad row; the check rides along in the same scan."""
    message = F.concat(F.lit("invalid row: "), F.to_json("violations"))
    stop = F.raise_error(message).cast("boolean")
    return flagged.filter(F.when(F.size("violations") > 0, stop).otherwise(F.lit(True))).drop("violations")


def clean(df: DataFrame, spec: TableSpec, mode: str = "strict") -> DataFrame:
    """``strict`` fails on bad rows, ``drop`` keeps good ones, ``flag`` keeps all with reasons."""
    finish = {"strict": fail_on_violation, "drop": valid_rows, "flag": lambda rows: rows}
    if mode not in finish:
        raise ValueError(f"unknown mode {mode!r}; use one of {sorted(finish)}")
    return finish[mode](canonicalise(df, spec))


def quarantine(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their reasons."""
    flagged = canonicalise(df, spec)
    return valid_rows(flagged), rejected_rows(flagged)


def write_by_verdict(flagged: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write good and bad rows in one pass, below ``verdict=valid`` and ``verdict=rejected``."""
    verdict = F.when(F.size("violations") == 0, "valid").otherwise("rejected")
    flagged.withColumn("verdict", verdict).write.mode(mode).partitionBy("verdict").parquet(path)


def check_scoring_input(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Flag scoring rows: every feature present, in vocabulary and within its scoring range.

    The input keeps its other columns; a missing feature column counts as null everywhere.
    """
    absent = {f.name: F.lit(None).cast("double") for f in spec.numeric if f.name not in df.columns}
    absent |= {f.name: F.lit(None).cast("string") for f in spec.categorical if f.name not in df.columns}
    table = df.withColumns(absent) if absent else df
    checks = []
    for f in spec.numeric:
        c = _check_number(f, table.schema[f.name].dataType)
        broken = {"required": c.raw.isNull() | F.isnan(c.raw.try_cast("double")), **c.broken}
        outside = _outside(c.value, f.score_low, f.score_high)
        if outside is not None:
            broken["scoring_range"] = outside
        checks.append(_Checked(f.name, c.raw, c.value, broken))
    for f in spec.categorical:
        raw = F.col(quote(f.name)).cast("string")
        broken = {"required": raw.isNull()}
        if f.allowed is not None:
            broken["vocabulary"] = ~raw.isin(*f.allowed)
        checks.append(_Checked(f.name, raw, raw, broken))
    others = [F.col(quote(n)) for n in table.columns if n not in spec.features]
    return table.select(
        *others,
        *[c.value.alias(c.name) for c in checks],
        _once(violation_array(checks)).alias("violations"),
    )


def spec_catalogue(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per declared column: role, type, bounds, vocabulary, and how many rows fill it."""
    described = [
        (f.name, "numeric", f.dtype, f.low, f.high, None) for f in spec.numeric
    ] + [
        (f.name, "categorical", "string", None, None, "|".join(f.allowed) if f.allowed else None)
        for f in spec.categorical
    ]
    if spec.target:
        allowed = "|".join(spec.target.allowed) if spec.target.allowed else None
        described.append((spec.target.name, "target", "string", None, None, allowed))
    counts = df.agg(
        *[
            (F.count(quote(name)) if name in df.columns else F.lit(0).cast("bigint")).alias(f"c{i}")
            for i, (name, *_) in enumerate(described)
        ]
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("feature"),
            F.lit(role).alias("role"),
            F.lit(dtype).alias("dtype"),
            F.lit(None if low is None else float(low)).cast("double").alias("low"),
            F.lit(None if high is None else float(high)).cast("double").alias("high"),
            F.lit(allowed).cast("string").alias("allowed"),
            F.col(f"c{i}").alias("filled_rows"),
        )
        for i, (name, role, dtype, low, high, allowed) in enumerate(described)
    ]
    return counts.select(F.inline(F.array(*entries)))
