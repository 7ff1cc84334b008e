"""Exact column statistics that never gather a column in one task."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.functions.expressions import nan_to_null
from rowsmith.operators.clean import quote

# A bracket this small is ranked directly; a larger one is narrowed by another pass.
RANK_DIRECTLY = 200_000
# Each pass cuts a bracket into this many quantile steps and keeps the few around the middle.
STEPS = 500
SKETCH_ACCURACY = 10_000
# Rows that guide a pass. A sample keeps the sketches of all tasks together small, however many
# tasks there are; it only decides where to count next, never what the result is.
GUIDE_ROWS = 1_000_000


@dataclass(frozen=True)
class Moments:
    """Counts and moments of the filled cells of one column."""

    filled: int
    missing: int
    mean: float | None
    variance: float | None
    low: float | None
    high: float | None


def number(name: str):
    return nan_to_null(F.col(quote(name)).cast("double"))


def moments(df: DataFrame, columns: list[str]) -> dict[str, Moments]:
    """Population moments of all columns in a single aggregate."""
    if not columns:
        return {}
    aggs = [F.count("*").alias("rows")]
    for i, name in enumerate(columns):
        c = number(name)
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.avg(c).alias(f"a{i}"),
            F.var_pop(c).alias(f"v{i}"),
            F.min(c).alias(f"l{i}"),
            F.max(c).alias(f"h{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        name: Moments(
            row[f"n{i}"], row["rows"] - row[f"n{i}"], row[f"a{i}"], row[f"v{i}"], row[f"l{i}"], row[f"h{i}"]
        )
        for i, name in enumerate(columns)
    }


@dataclass
class _Bracket:
    """Values known to contain the middle of a column, and how many rows lie below and inside."""

    total: int
    low: float
    high: float
    below: int
    inside: int
    steps: list[float] | None = None
    spread: int = 1

    @property
    def middle(self) -> tuple[int, int]:
        """The two middle ranks, counted from 1; equal for an odd number of rows."""
        return (self.total + 1) // 2, self.total // 2 + 1

    def probe(self) -> tuple[float, float]:
        """A narrower bracket aimed at the middle ranks; without a sketch, the same one."""
        if not self.steps:
            return self.low, self.high
        first, last = self.middle
        start = (first - self.below) * STEPS // self.inside - self.spread
        stop = -(-(last - self.below) * STEPS // self.inside) + self.spread
        return (
            self.steps[start] if start > 0 else self.low,
            self.steps[stop] if stop < STEPS else self.high,
        )

    @property
    def open(self) -> bool:
        """Too many rows to rank directly, and the next pass can still learn something."""
        untried = self.steps is None or self.probe() != (self.low, self.high)
        return self.inside > RANK_DIRECTLY and self.low < self.high and untried

    def counted(self, below: int, inside: int, steps: list[float] | None) -> _Bracket:
        """After counting the probed bracket: take it if it holds the middle, else widen it."""
        first, last = self.middle
        if below < first and last <= below + inside:
            return _Bracket(self.total, *self.probe(), below, inside, steps or [])
        return replace(self, spread=self.spread * 4)


def medians(
    df: DataFrame, columns: list[str], measured: dict[str, Moments] | None = None
) -> dict[str, float | None]:
    """Exact medians of several columns at once, in a few narrow passes.

    Every pass counts the rows below and inside a bracket around the middle of each column, and
    sketches the quantiles inside it to aim the next, much narrower bracket. Once few rows are
    left they are counted by value and ranked. Brackets are only accepted after their rows were
    counted, so a poor sketch costs another pass, never exactness.
    """
    if not columns:
        return {}
    measured = measured or moments(df, columns)
    c = {name: number(name) for name in columns}
    brackets = {
        name: _Bracket(m.filled, m.low, m.high, 0, m.filled) for name, m in measured.items() if name in c and m.filled
    }
    shares = [i / STEPS for i in range(STEPS + 1)]
    while wide := [name for name, b in brackets.items() if b.open]:
        aggs = []
        # Values not drawn into the guide are null there, and the sketch ignores nulls.
        drawn = df.select(*[c[name].alias(name) for name in wide], F.rand(0).alias("rs_draw"))
        for i, name in enumerate(wide):
            lo, hi = brackets[name].probe()
            value = F.col(quote(name))
            within = value.between(lo, hi)
            guide = within & (F.col("rs_draw") < GUIDE_ROWS / brackets[name].inside)
            aggs += [
                F.count_if(value < lo).alias(f"b{i}"),
                F.count_if(within).alias(f"i{i}"),
                F.percentile_approx(F.when(guide, value), shares, SKETCH_ACCURACY).alias(f"q{i}"),
            ]
        row = drawn.agg(*aggs).first()
        for i, name in enumerate(wide):
            brackets[name] = brackets[name].counted(row[f"b{i}"], row[f"i{i}"], row[f"q{i}"])
    found: dict[str, float | None] = dict.fromkeys(columns)
    found.update(_ranked_middles(df, c, brackets))
    return found


def _ranked_middles(df: DataFrame, c: dict, brackets: dict[str, _Bracket]) -> dict[str, float]:
    """Count the distinct values inside the brackets and pick the middle ranks."""
    if not brackets:
        return {}
    names = list(brackets)
    cells = F.array(
        *[
            F.when(
                c[name].between(brackets[name].low, brackets[name].high),
                F.struct(F.lit(i).alias("i"), c[name].alias("v")),
            )
            for i, name in enumerate(names)
        ]
    )
    running = W.partitionBy("i").orderBy("v")
    values = (
        df.select(F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("x"))
        .groupBy("x.i", "x.v")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
    )
    start, wanted = F.col("upto") - F.col("n"), F.lit(False)
    for i, name in enumerate(names):
        for rank in brackets[name].middle:
            r = rank - brackets[name].below
            wanted = wanted | ((F.col("i") == i) & (start < r) & (F.col("upto") >= r))
    picked = values.filter(wanted).groupBy("i").agg(((F.min("v") + F.max("v")) / 2).alias("m"))
    return {names[r["i"]]: r["m"] for r in picked.collect()}


def value_counts(df: DataFrame, columns: list[str], dtype: str) -> DataFrame:
    """Rows ``(feature, value, n)`` for all columns in one shuffle, combined on the map side."""
    cell = number if dtype == "double" else lambda name: F.col(quote(name)).cast(dtype)
    cells = F.array(*[F.struct(F.lit(name).alias("feature"), cell(name).alias("value")) for name in columns])
    return df.select(F.inline(cells)).groupBy("feature", "value").agg(F.count("*").alias("n"))


def modes(df: DataFrame, columns: list[str], dtype: str) -> dict:
    """Most frequent value per column, the smallest one on ties; null cells do not count."""
    if not columns:
        return {}
    counted = value_counts(df, columns, dtype).filter(F.col("value").isNotNull())
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    found = dict.fromkeys(columns)
    found.update({r["feature"]: r["m"] for r in counted.groupBy("feature").agg(best.alias("m")).collect()})
    return found
