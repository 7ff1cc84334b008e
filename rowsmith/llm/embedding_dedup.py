"""Near-duplicate embeddings by an inverted multi-index.

Vectors are cut into halves, and each half has its own codebook, fitted on a bounded sample. The pairs
of codes form a product grid, and every vector lies in one cell of it. A vector asks its nearest
cells in the order of the multi-sequence traversal, which merges the two sorted lists of
half-distances by their sum, until that sum exceeds the nearest by a margin. The margin is set on
the sample so that the cell of a neighbour at the threshold is reached with the target recall.
All candidates of a visited cell are verified by their cosine in double precision.

Vectors are only compared within a label. Equal vectors are one class, whose members are counted and
never compared. Of a cell's members and askers, blocks of bounded size meet in one task; a pair
is counted in one block only, and a block passes on counts and a spanning star of its links instead of
pairs. So a third of all rows in one cell or one class fills no single task.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component links with
nothing, nor does one without a label. Vectors of different lengths are not compared. A row that
repeats an id counts as a row of its own in ``n_links``. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import components, map_batches
from rowsmith.session import Scratch

COSINE, RECALL, SAMPLE, BLOCK, SEED = 0.93, 0.999, 8192, 1024, 5
# Cells of the grid hold about this many classes of a label at least.
PER_CELL = 256

CLASSED = "vec_id bigint, part string, digest string, unit array<double>"


def classed(vectors: DataFrame) -> DataFrame:
    """Every row with the part of the table that it is compared within, a digest of its vector, and the unit vector.

    Rows that link with nothing have a null ``part``.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            part, digest, unit = [], [], []
            for label, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                v = np.array(values if values is not None and None not in values else [], dtype=np.float64)
                if label is None or not len(v) or not np.isfinite(v).all() or not v.any():
                    part.append(None), digest.append(None), unit.append(None)
                    continue
                v = v + 0.0  # one zero
                scaled = v / np.abs(v).max()
                part.append(f"{label}/{len(v)}")
                digest.append(xxhash.xxh3_128_hexdigest(v.tobytes()))
                unit.append(scaled / np.sqrt(scaled @ scaled))
            columns = [batch.column(0), pa.array(part, pa.string()), pa.array(digest, pa.string()), pa.array(unit, pa.list_(pa.float64()))]
            return pa.record_batch(columns, names=["vec_id", "part", "digest", "unit"])

        return work

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return map_batches(rows, make, CLASSED)


def codebook(points: np.ndarray, size: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres of ``points`` by k-means."""
    centres = points[rng.choice(len(points), size=min(size, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(axis=1)
        for c in range(len(centres)):
            own = points[nearest == c]
            if len(own):
                centres[c] = own.mean(axis=0)
    return centres


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :], 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, margin: float) -> list[int]:
    """Cells in ascending order of the sum of their half-distances, up to ``margin`` beyond the nearest."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, width = first[a], second[b], len(second)
    limit = x[0] + y[0] + margin
    heap, cells = [(x[0] + y[0], 0, 0)], []
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > limit:
            break
        cells.append(int(a[i]) * width + int(b[j]))
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return cells


class Index:
    """The two codebooks and the margin of the traversal."""

    def __init__(self, left: np.ndarray, right: np.ndarray, margin: float):
        self.left, self.right, self.margin = left, right, margin

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dims = self.left.shape[1]
        wide = np.zeros((len(units), dims + self.right.shape[1]))
        wide[:, : units.shape[1]] = units
        return _distances(wide[:, :dims], self.left), _distances(wide[:, dims:], self.right)

    def visits(self, units: np.ndarray) -> list[list[int]]:
        """The cells that each vector asks; its own is the first."""
        return [multi_sequence(a, b, self.margin) for a, b in zip(*self.halves(units))]


def fit_index(sample: np.ndarray, grid: int, cosine: float = COSINE, recall: float = RECALL) -> Index:
    """Codebooks of ``grid`` centres each, and the margin that reaches a neighbour at the threshold with ``recall``.

    Neighbours are made at exactly ``cosine`` from sampled vectors, in random directions: the farthest
    that a link can be.
    """
    rng = np.random.default_rng(SEED)
    dims = sample.shape[1]
    half = max(1, dims // 2)
    left, right = codebook(sample[:, :half], grid, rng), codebook(sample[:, half:], grid, rng) if dims > half else np.zeros((1, 0))
    index = Index(left, right, 0.0)
    some = sample[rng.integers(0, len(sample), 4096)]
    way = rng.normal(size=some.shape)
    way -= (way * some).sum(axis=1, keepdims=True) * some
    size = np.linalg.norm(way, axis=1, keepdims=True)
    near = cosine * some + np.sqrt(1 - cosine**2) * np.where(size > 1e-9, way / np.maximum(size, 1e-9), 0)
    a, b = index.halves(some)
    c, d = index.halves(near)
    beyond = a[np.arange(len(a)), c.argmin(axis=1)] + b[np.arange(len(b)), d.argmin(axis=1)] - a.min(axis=1) - b.min(axis=1)
    index.margin = float(np.quantile(beyond, recall)) + 1e-9
    return index


ENTRIES = "part string, cell int, node bigint, weight bigint, home int, visits array<int>, unit array<double>"


def entries(classes: DataFrame, index: Index) -> DataFrame:
    """Every class with its own cell and the cells that it asks."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            units = batch.column(3).to_pylist()
            dims = max(map(len, units))
            wide = np.zeros((len(units), dims))
            for i, u in enumerate(units):
                wide[i, : len(u)] = u
            visits = index.visits(wide)
            columns = [*batch.columns, pa.array([v[0] for v in visits], pa.int32()), pa.array([sorted(v) for v in visits], pa.list_(pa.int32()))]
            return pa.record_batch(columns, names=["part", "node", "weight", "unit", "home", "visits"])

        return work

    rows = classes.select("part", "node", "weight", "unit")
    return map_batches(rows, make, "part string, node bigint, weight bigint, unit array<double>, home int, visits array<int>")


def _block_links(members: pd.DataFrame, askers: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between the members of a cell and those that ask it: a count and a smaller neighbour per vector.

    A pair of which each asks the other's cell would be met twice; it counts where the asker has
    the larger home, or within one cell the larger id.
    """
    m_node, q_node = members["node"].to_numpy(), askers["node"].to_numpy()
    if not len(m_node) or not len(q_node):
        return pd.DataFrame({"node": [], "links": [], "other": []})
    m_unit, q_unit = np.stack(members["unit"].to_numpy()), np.stack(askers["unit"].to_numpy())
    row, col = np.nonzero(q_unit @ m_unit.T >= cosine - 1e-12)
    exact = np.einsum("ij,ij->i", q_unit[row], m_unit[col]) >= cosine
    row, col = row[exact], col[exact]
    q_home, m_home = askers["home"].to_numpy()[row], members["home"].to_numpy()[col]
    asked_back = np.array([h in v for h, v in zip(q_home, (members["visit_set"].to_numpy()[col]))], dtype=bool)
    here = (q_home > m_home) | ((q_home == m_home) & (q_node[row] > m_node[col])) | ((q_home < m_home) & ~asked_back)
    row, col = row[here], col[here]
    if not len(row):
        return pd.DataFrame({"node": [], "links": [], "other": []})
    a, b = q_node[row], m_node[col]
    ends = np.concatenate([a, b])
    weight = np.concatenate([members["weight"].to_numpy()[col], askers["weight"].to_numpy()[row]])
    nodes, place = np.unique(ends, return_inverse=True)
    links = np.bincount(place, weights=weight).astype(np.int64)
    # The smallest node that each reaches within the block: a star instead of all pairs.
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return pd.DataFrame({"node": nodes, "links": links, "other": nodes[root]})


def linked(rows: DataFrame, scratch: Scratch, cosine: float, block: int) -> DataFrame:
    """``node, links, other`` for every class that has a link, several rows per class."""
    spark = rows.sparkSession
    members = rows.select("part", F.col("home").alias("cell"), "node", "weight", "home", "visits", "unit")
    askers = rows.select("part", F.explode("visits").alias("cell"), "node", "weight", "home", "unit")
    # How many blocks each cell needs, on either side.
    n_m = members.groupBy("part", "cell").agg(F.count("*").alias("n_m"))
    n_q = askers.groupBy("part", "cell").agg(F.count("*").alias("n_q"))
    sizes = n_m.join(n_q, ["part", "cell"]).select(
        "part", "cell", F.ceil(F.col("n_m") / block).cast("int").alias("m_blocks"), F.ceil(F.col("n_q") / block).cast("int").alias("q_blocks")
    )
    sizes = scratch.write(sizes, "cells")
    keys = ["part", "cell", "m_block", "q_block"]

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    members = members.join(sizes, ["part", "cell"]).withColumn("m_block", F.pmod(F.xxhash64("node"), F.col("m_blocks")).cast("int")).withColumn("q_block", every("q_blocks"))
    askers = askers.join(sizes, ["part", "cell"]).withColumn("q_block", F.pmod(F.xxhash64("node"), F.col("q_blocks")).cast("int")).withColumn("m_block", every("m_blocks"))

    own = ("q_node", "q_weight", "q_home", "q_unit")

    def meet(m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        m = m.assign(visit_set=[frozenset(v) for v in m["visits"]])
        return _block_links(m, q.rename(columns=lambda c: c.removeprefix("q_") if c in own else c), cosine)

    askers = askers.select(*(F.col(c).alias("q_" + c) for c in (*keys, "node", "weight", "home", "unit")))
    met = members.groupBy(*keys).cogroup(askers.groupBy(*("q_" + k for k in keys)))
    return scratch.write(met.applyInPandas(meet, "node bigint, links bigint, other bigint"), "links")


def annotate(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, sample: int = SAMPLE, per_cell: int = PER_CELL, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    with Scratch(spark, "embed") as scratch:
        rows = scratch.write(classed(vectors), "vectors")
        known = rows.where("part IS NOT NULL AND vec_id IS NOT NULL")
        classes = known.groupBy("part", "digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("unit").alias("unit"))
        classes = scratch.write(classes, "classes")
        # A bounded sample in hash order fits the codebooks; every class is indexed.
        chosen = [r["unit"] for r in classes.orderBy(F.xxhash64("digest"), "digest").limit(sample).select("unit").collect()]
        found = None
        if chosen:
            dims = max(map(len, chosen))
            units = np.zeros((len(chosen), dims))
            for i, u in enumerate(chosen):
                units[i, : len(u)] = u
            parts = max(1, classes.select("part").distinct().count())
            grid = int(np.clip(np.ceil(np.sqrt(classes.count() / parts / per_cell)), 2, 256))
            longest = classes.agg(F.max(F.size("unit")).alias("n")).first()["n"]
            if longest > dims:
                units = np.pad(units, ((0, 0), (0, longest - dims)))
            index = fit_index(units, grid, cosine, recall)
            found = linked(scratch.write(entries(classes, index), "entries"), scratch, cosine, block)
        if found is None:
            found = spark.createDataFrame([], "node bigint, links bigint, other bigint")
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        roots = components(found.select("node", "other"), scratch)
        per_class = classes.join(counts, "node", "left").join(roots, "node", "left").select(
            "part", "digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
        )
        out = rows.join(scratch.write(per_class, "result"), ["part", "digest"], "left").select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
        )
        out = out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
        return scratch.write(out, "rows", keep=True)
