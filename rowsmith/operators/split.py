"""Reproducible random splits, folds and samples.

Rows are put in a pseudo-random order by a hash of their key. A split is then a set of hash
thresholds per stratum, found exactly in two narrow passes, and applied as a comparison: the
table itself is never sorted or shuffled and no stratum is ever held by one task. Rows that
share a key share a hash and therefore always land on the same side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.functions.expressions import key_hash
from rowsmith.operators.clean import quote
from rowsmith.session import Scratch, pin_small

# Hash digits looked at in turn: 16**3 = 4,096 buckets per stratum, then as many within the bucket
# that holds a cut, then the whole hash.
LEVELS = (3, 6, 32)
# Strata, and rows of a balanced sample, beyond which the operators refuse.
MAX_STRATA, MAX_SAMPLE = 100_000, 1_000_000


class HashOrder:
    """Rows of a table in the pseudo-random order of their key hash, within strata.

    Creating it counts rows per stratum and hash bucket. That small table answers how many rows
    each stratum has and which bucket holds its k-th row.
    """

    def __init__(self, df: DataFrame, stratum: Column, h: Column):
        self.spark = df.sparkSession
        self.scratch = Scratch(self.spark, "split")
        # What lies upstream is read once here; every level looks at this narrow table.
        self.rows = self.scratch.write(df.select(stratum.alias("stratum"), h.alias("h")), "hashes")
        self.sizes = self._sizes(self.rows, 0, LEVELS[0]).persist()
        self._counts: list[tuple[str, int]] | None = None

    @staticmethod
    def _sizes(rows: DataFrame, known: int, digits: int) -> DataFrame:
        """Rows per bucket of ``digits`` digits, together with the ``known`` digits before."""
        keys = ["stratum", F.substring("h", 1, known).alias("prefix"), F.substring("h", 1, digits).alias("bucket")]
        return rows.groupBy(*keys).agg(F.count("*").alias("n"))

    def __enter__(self) -> HashOrder:
        return self

    def __exit__(self, *_) -> None:
        self.sizes.unpersist()
        self.scratch.__exit__()

    def counts(self) -> list[tuple[str, int]]:
        """Rows per stratum, in stratum order."""
        if self._counts is None:
            self._counts = small_counts(self.sizes.groupBy("stratum").agg(F.sum("n").alias("n")))
        return self._counts

    def cuts(self, targets: list[tuple[str, int, int]]) -> DataFrame:
        """For each ``(stratum, cut, k)`` the k-th smallest hash of the stratum, as ``threshold``.

        Each level finds the bucket that holds a cut and how far into it the cut lies; the next
        level looks only at the rows of those buckets.
        """
        levels = LEVELS
        wanted = self.spark.createDataFrame(targets, "stratum string, cut int, k bigint")
        wanted = F.broadcast(wanted.withColumn("prefix", F.lit("")))
        sizes, inside = self.sizes, None
        for i, digits in enumerate(levels):
            if i:
                sizes = self._sizes(inside, levels[i - 1], digits)
            running = W.partitionBy("stratum", "prefix").orderBy("bucket")
            start = F.col("upto") - F.col("n")
            wanted = pin_small(
                sizes.withColumn("upto", F.sum("n").over(running))
                .join(wanted, ["stratum", "prefix"])
                .filter((start < F.col("k")) & (F.col("k") <= F.col("upto")))
                .select("stratum", "cut", F.col("bucket").alias("prefix"), (F.col("k") - start).alias("k"))
            )
            # A semi join ignores repeated cuts, and keeping ``wanted`` undisturbed keeps its hint.
            keyed = (self.rows if inside is None else inside).withColumn("prefix", F.substring("h", 1, digits))
            inside = keyed.join(wanted, ["stratum", "prefix"], "left_semi").select("stratum", "h")
        return wanted.select("stratum", "cut", F.col("prefix").alias("threshold"))

    def thresholds(self, targets: list[tuple[str, int, int]]) -> DataFrame:
        """One broadcast row per stratum with its sorted thresholds.

        A cut at row 0 lies before every hash, so its threshold is the empty text. There are
        strata times cuts of them, and the number of strata was checked by ``counts``.
        """
        found: dict[str, list[str]] = {}
        for name, _, k in targets:
            found.setdefault(name, []).extend([""] * (k == 0))
        for row in self.cuts(targets).collect():
            found[row["stratum"]].append(row["threshold"])
        rows = [(name, sorted(cuts)) for name, cuts in found.items()]
        return F.broadcast(self.spark.createDataFrame(rows, "stratum_ string, thresholds array<string>"))


def small_counts(counted: DataFrame) -> list[tuple[str, int]]:
    """Sorted ``(label, n)`` pairs; a label set is small by nature, and that is checked."""
    rows = counted.limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} classes: the column is not a class label")
    return sorted((r[0], r[1]) for r in rows)


def class_counts(df: DataFrame, label: Column) -> list[tuple[str, int]]:
    """Rows per class, in label order."""
    return small_counts(df.groupBy(label.alias("label")).agg(F.count("*").alias("n")))


def proportional_quotas(counts: list[int], draws: int) -> list[int]:
    """Largest-remainder shares of ``draws``; equal remainders go to the earlier class."""
    total = sum(counts)
    shares = [divmod(draws * n, total) for n in counts]
    order = sorted(range(len(counts)), key=lambda i: (-shares[i][1], i))
    extra = set(order[: draws - sum(q for q, _ in shares)])
    return [q + (i in extra) for i, (q, _) in enumerate(shares)]


def holdout_sizes(n: int, test_size: float) -> tuple[int, int]:
    """Rows for training and for testing; the test side is rounded up."""
    n_test = math.ceil(test_size * n)
    if not 0 < test_size < 1 or n - n_test < 1:
        raise ValueError(f"test_size={test_size} leaves no training rows out of {n}")
    return n - n_test, n_test


def _with_thresholds(df: DataFrame, stratum: Column, h: Column, found: DataFrame) -> DataFrame:
    """Attach ``h_`` and ``thresholds`` to the rows, which stay where they are."""
    keyed = df.withColumns({"stratum_": stratum, "h_": h})
    return keyed.join(found, "stratum_", "left").drop("stratum_")


def train_test_split(
    df: DataFrame,
    key: list[str] | tuple[str, ...],
    target: str,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Rows with a target plus a ``split`` column of ``train`` and ``test``.

    Stratification is dropped when the smallest class has a single row.
    """
    label = F.col(quote(target)).cast("string")
    rows = df.filter(label.isNotNull())
    h = key_hash(seed, key)
    stratum = label if stratify else F.lit("all")
    with HashOrder(rows, stratum, h) as order:
        counted = order.counts()
        n_train, n_test = holdout_sizes(sum(n for _, n in counted), test_size)
        if stratify and min(n for _, n in counted) < 2:
            return train_test_split(df, key, target, test_size, seed, stratify=False)
        if min(n_train, n_test) < len(counted):
            raise ValueError(f"{n_train} training and {n_test} test rows cannot cover {len(counted)} classes")
        train = proportional_quotas([n for _, n in counted], n_train)
        found = order.thresholds([(name, 0, n - q) for (name, n), q in zip(counted, train)])
    return (
        _with_thresholds(rows, stratum, h, found)
        .withColumn("split", F.when(F.col("h_") <= F.col("thresholds")[0], "test").otherwise("train"))
        .drop("h_", "thresholds")
    )


def fold_quotas(counts: list[int], folds: int) -> list[list[int]]:
    """Rows of each class in each fold when the class-sorted rows are dealt out in turn.

    Both the folds of a class and the folds as a whole then differ by at most one row.
    """
    quotas, start = [], 0
    for n in counts:
        end = start + n
        quotas.append([(end - f + folds - 1) // folds - (start - f + folds - 1) // folds for f in range(folds)])
        start = end
    return quotas


def stratified_folds(
    df: DataFrame, key: list[str] | tuple[str, ...], target: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Rows with a target plus an integer ``fold`` of 0..folds-1, balanced within each class."""
    label = F.col(quote(target)).cast("string")
    rows = df.filter(label.isNotNull())
    h = key_hash(seed, key)
    with HashOrder(rows, label, h) as order:
        counted = order.counts()
        if max((n for _, n in counted), default=0) < folds:
            raise ValueError(f"{folds} folds need a class with at least that many rows")
        wanted = []
        for (name, _), quotas in zip(counted, fold_quotas([n for _, n in counted], folds)):
            wanted += [(name, cut, sum(quotas[: cut + 1])) for cut in range(folds - 1)]
        found = order.thresholds(wanted)
    passed = F.size(F.filter("thresholds", lambda t: t < F.col("h_")))
    return _with_thresholds(rows, label, h, found).withColumn("fold", passed).drop("h_", "thresholds")


def balanced_sample(
    df: DataFrame, key: list[str] | tuple[str, ...], target: str, n: int = 10, seed: int = 42
) -> DataFrame:
    """About ``n`` rows spread evenly over the classes, topped up from the rest.

    Every class gives ``max(1, n // classes)`` rows if it has them. The result is ordered by
    ``sample_rank`` and is all rows when the table has fewer than ``n``. The sample is ranked as a whole,
    so ``n`` is limited to ``MAX_SAMPLE``.
    """
    if n > MAX_SAMPLE:
        raise ValueError(f"a balanced sample of {n} rows is more than {MAX_SAMPLE}; split the table instead")
    label = F.col(quote(target)).cast("string")
    rows = df.filter(label.isNotNull())
    h = key_hash(seed, key)
    with HashOrder(rows, label, h) as order:
        counted = order.counts()
        if not counted:
            return rows.withColumn("sample_rank", F.lit(None).cast("int"))
        share = max(1, n // len(counted))
        quotas = [(name, 0, min(size, share)) for name, size in counted]
        found = order.thresholds(quotas)
    marked = _with_thresholds(rows, label, h, found).withColumn("drawn", F.col("h_") <= F.col("thresholds")[0])
    drawn = marked.filter("drawn")
    missing = max(0, n - sum(q for *_, q in quotas))
    rest = marked.filter("not drawn").orderBy("h_").limit(missing)
    order = W.orderBy(F.desc("drawn"), label, "h_")
    return (
        drawn.unionByName(rest)
        .orderBy(F.desc("drawn"), label, "h_")
        .limit(n)
        .withColumn("sample_rank", F.row_number().over(order))
        .drop("h_", "thresholds", "drawn")
    )
