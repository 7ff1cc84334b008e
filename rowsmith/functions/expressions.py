"""Small column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a CSV reader treats as missing.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: two-digit years from here on belong to the 1900s (the POSIX %y rule).
CENTURY_PIVOT = 69


def nan_to_null(c: Column) -> Column:
    """SQL aggregates skip NULL but not NaN, so NaN becomes NULL."""
    return F.when(~F.isnan(c), c)


def tokens_to_null(c: Column, tokens: tuple[str, ...] = (), blank: bool = False) -> Column:
    """NULL for the listed tokens and, if asked, for white-space-only text."""
    keep = F.lit(True)
    if tokens:
        keep = keep & ~c.isin(*tokens)
    if blank:
        keep = keep & c.rlike(r"\S")
    return F.when(keep, c)


def first_contained(c: Column, labels: tuple[str, ...]) -> Column:
    """The first label that occurs inside the text, else the text itself."""
    return F.coalesce(*[F.when(c.contains(label), F.lit(label)) for label in labels], c)


def year_from_text(c: Column, formats: tuple[str, ...]) -> Column:
    """Year of a date text in any of the formats, NULL where none fits."""

    def one(fmt: str) -> Column:
        year = F.year(F.try_to_timestamp(c, F.lit(fmt)))
        if "yyyy" in fmt or "yy" not in fmt:
            return year
        first = 1900 + CENTURY_PIVOT
        return (year - first) % 100 + first

    return F.coalesce(*[one(fmt) for fmt in formats])


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0/0 counted as 0."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def key_hash(seed: int, key: list[str] | tuple[str, ...]) -> Column:
    """A seeded, engine-independent pseudo-random order of rows by their key."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
