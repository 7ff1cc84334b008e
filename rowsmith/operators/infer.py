"""Draft a ``TableSpec`` from a raw text table.

All columns are judged by one aggregate over one scan. Every part of it merges: counts of values
that look like a type, the range of numbers, and a sketch of the most frequent values, which is exact as long as
a column has few of them. So one row per column comes back, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.operators.clean import quote
from rowsmith.spec import CategoryField, DateYear, NumericField, TableSpec, TargetField

INTEGER = r"^[+-]?[0-9]{1,18}$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
# Texts that usually stand for a missing category.
NULL_LIKE = (".", "?", "-", "--", "n/k", "unknown")
# Values that the sketch of a column follows; up to three quarters of them are counted exactly.
TRACKED = 4096


def infer_columns(
    raw: DataFrame, formats: tuple[str, ...] = DateYear.formats, share: float = 0.95, max_vocabulary: int = 50
) -> DataFrame:
    """``column, type, n, n_integer, n_number, n_date, date_format, low, high, vocabulary`` of every column.

    The types are ``integer`` (32 bits), ``long``, ``double``, ``date``, ``category``, ``text`` and
    ``empty``, tried in this order. A column has a type if at least ``share`` of its values that are not
    null have the form, so a few stray tokens don't decide; it is a category if it has at most
    ``max_vocabulary`` different values, which ``vocabulary`` then lists sorted. ``low`` and ``high`` are the range of
    its numbers. An empty table has empty columns only.
    """
    if not raw.columns:
        raise ValueError("the table has no columns")
    if not 0 < max_vocabulary < TRACKED // 2:
        raise ValueError(f"max_vocabulary must lie between 1 and {TRACKED // 2 - 1}")

    def counted(when: Column) -> Column:
        return F.count(F.when(when, F.lit(1)))

    parts = []
    for i, name in enumerate(raw.columns):
        text = F.col(f"c{i}")
        number = F.when(text.rlike(NUMBER), text.cast("double"))
        dates = [counted(F.try_to_timestamp(text, F.lit(f)).isNotNull()) for f in formats]
        parts += [
            F.count(text).alias(f"n{i}"),
            counted(text.rlike(INTEGER)).alias(f"i{i}"),
            counted(number.isNotNull()).alias(f"d{i}"),
            F.array(*dates).alias(f"t{i}"),
            F.min(number).alias(f"l{i}"),
            F.max(number).alias(f"h{i}"),
            F.expr(f"approx_top_k(c{i}, {max_vocabulary + 1}, {TRACKED}) FILTER (WHERE c{i} IS NOT NULL)").alias(f"v{i}"),
        ]
    texts = raw.select(*[F.col(quote(c)).cast("string").alias(f"c{i}") for i, c in enumerate(raw.columns)])
    once = texts.agg(*parts)
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"i{i}").alias("n_integer"), F.col(f"d{i}").alias("n_number"),
            F.array_max(f"t{i}").alias("n_date"), F.array_position(f"t{i}", F.array_max(f"t{i}")).cast("int").alias("nth"),
            F.col(f"l{i}").alias("low"), F.col(f"h{i}").alias("high"), F.col(f"v{i}").alias("top"),
        )
        for i, name in enumerate(raw.columns)
    ])
    each = once.select(F.inline(rows))
    enough = F.ceil(F.col("n") * share)
    # Few values are all of them if their counts add up to the number of values.
    seen = F.aggregate("top", F.lit(0).cast("bigint"), lambda total, v: total + v["count"])
    closed = (F.size("top") <= max_vocabulary) & (seen == F.col("n"))
    whole = F.col("n_integer") >= enough
    kind = (
        F.when(F.col("n") == 0, "empty")
        .when(whole & (F.col("low") >= -(2**31)) & (F.col("high") < 2**31), "integer")
        .when(whole, "long")
        .when(F.col("n_number") >= enough, "double")
        .when(F.col("n_date") >= enough, "date")
        .when(closed, "category")
        .otherwise("text")
    )
    each = each.withColumn("type", kind)
    names = F.array(*[F.lit(f) for f in formats])
    return each.select(
        "column", "type", "n", "n_integer", "n_number", "n_date",
        F.when(F.col("type") == "date", F.element_at(names, F.col("nth"))).alias("date_format"),
        "low", "high",
        F.when(F.col("type") == "category", F.array_sort(F.transform("top", lambda v: v["item"]))).alias("vocabulary"),
    )


def draft_spec(
    raw: DataFrame, key: tuple[str, ...], target: str | None = None, share: float = 0.95, max_vocabulary: int = 50, null_tokens: tuple[str, ...] = NULL_LIKE
) -> TableSpec:
    """A specification to start from: types, vocabularies and missing tokens as found in the table.

    The first date column becomes the source of a year. Text columns and empty ones are left out. The
    ``target`` has to have few values. One row per column reaches the driver.
    """
    absent = [c for c in (*key, *([target] if target else [])) if c not in raw.columns]
    if absent:
        raise ValueError(f"not in the table: {absent}")
    numeric, categorical, date, label, key_types = [], [], None, None, set()
    for r in infer_columns(raw, share=share, max_vocabulary=max_vocabulary).collect():
        name, kind = r["column"], r["type"]
        if name in key:
            key_types.add("bigint" if kind in ("integer", "long") and r["n_integer"] == r["n"] else "string")
        elif name == target:
            if r["vocabulary"] is None:
                raise ValueError(f"the target {name!r} is no category but {kind}")
            label = TargetField(name, tuple(r["vocabulary"]))
        elif kind in ("integer", "long", "double"):
            numeric.append(NumericField(name, {"integer": "int", "long": "bigint"}.get(kind, kind)))
        elif kind == "date" and date is None:
            date = DateYear(name, f"{name}_year", (r["date_format"],))
            numeric.append(NumericField(date.target, "int"))
        elif kind == "category":
            blank = any(not v.strip() for v in r["vocabulary"])
            missing = tuple(v for v in r["vocabulary"] if v in null_tokens)
            allowed = tuple(v for v in r["vocabulary"] if v.strip() and v not in missing)
            categorical.append(CategoryField(name, allowed, missing, blank))
    return TableSpec(
        key=tuple(key), numeric=tuple(numeric), categorical=tuple(categorical), target=label, date_year=date,
        key_type=key_types.pop() if len(key_types) == 1 else None,
    )
