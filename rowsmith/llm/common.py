"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.session import Scratch

# Rows of an id list that may be broadcast: 2 million longs are 16 MB.
BROADCAST_ROWS = 2_000_000
# Slices in which frequent keys are looked for, and counters of each.
SLICES, COUNTERS = 64, 1024
# Rows of a batch that a task's function gets at a time.
ROWS_AT_ONCE = 1000


def whole_text(column: str = "text") -> Column:
    """The text of a row; a null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name like ``base`` that ``columns`` does not have."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def heavy_hitters(df: DataFrame, key: str, share: float = 0.001) -> list[tuple[str, int]]:
    """The values of the string column ``key`` that at least ``share`` of the rows hold, with exact counts.

    A Misra-Gries type sketch per hash slice proposes candidates, a second pass counts them. Rows
    are combined on the map side, slices are merged apart from each other, and at most
    ``1 / share`` values come back to the driver. A value far above ``share`` is always found; one
    near it may be missed when its slice is crowded, so callers must be right without it too.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    counts = rows.groupBy(F.pmod(F.xxhash64("k"), F.lit(SLICES)).alias("slice")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(k, 100, {COUNTERS})").alias("top")
    )
    found = counts.collect()  # SLICES rows of at most 100 values
    total = sum(r["n"] for r in found)
    candidates = [t["item"] for r in found for t in r["top"] if t["count"] >= max(2, share * total)]
    if not candidates:
        return []
    proposed = spark.createDataFrame([(c,) for c in candidates], "k string")
    exact = rows.join(F.broadcast(proposed), "k").groupBy("k").agg(F.count("*").alias("n"))
    return [(r["k"], r["n"]) for r in exact.where(F.col("n") >= max(2, share * total)).collect()]


def drop_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_anti") -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not (or, with ``left_semi``, is) in the one-column table ``ids``.

    ``ids`` has to be a written table: it is counted, and sent to every task only below BROADCAST_ROWS.
    """
    ids = ids.toDF(key)
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return docs.join(ids, key, how)


def give_back() -> None:
    """Return this process's free memory to the system: Python workers live on from task to task, and several share an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, make, schema: str) -> DataFrame:
    """``mapInArrow`` with a function made once per task; ``make()`` returns rows-to-rows on record batches.

    It gets ``ROWS_AT_ONCE`` rows at a time, so the Python objects of a whole batch are never there together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield work(batch.slice(at, ROWS_AT_ONCE))
        give_back()

    return df.mapInArrow(run, schema)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component``: the smallest id that each linked node reaches.

    ``links`` has two id columns. Each round points every node at its smallest neighbour, follows
    that pointer once more, and replaces nodes by what they point at, so the graph shrinks by at
    least half and stars vanish at once. Every step is a join or an aggregate; no component is
    ever gathered in one place. Every round is written, so a lost executor repeats one round.
    """
    a, b = links.columns
    links = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    links = scratch.write(links, "links")
    roots = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parent = scratch.write(
            both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("up")),
            "parents",
        )
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parent = scratch.write(parent.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up")), "pointers")
        if roots is None:
            roots = parent.select("node", F.col("up").alias("component"))
        else:
            step = parent.select(F.col("node").alias("component"), "up")
            roots = roots.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        roots = scratch.write(roots, "roots")
        pa_, pb_ = (parent.select(F.col("node").alias(c), F.col("up").alias("p" + c)) for c in "ab")
        moved = links.join(pa_, "a").join(pb_, "b").where("pa != pb")
        links = scratch.write(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots
