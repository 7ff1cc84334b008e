"""Smaller trees out of fitted ones.

A tree that may be less deep, or whose nodes need more rows to be split, is a larger fitted tree with some
nodes turned into leaves: splits are chosen from the top, so what lies above is the same. This gives
two things that the tree learner itself does not have: a minimum of rows for a split, and one
fit that serves every depth, minimum and forest size of a grid. A node table is as large as its model, which
the driver holds in any case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.session import Scratch

TREES = ("RandomForestClassifier", "DecisionTreeClassifier")
# Parameters whose candidates are parts of one larger model.
NESTED = ("max_depth", "n_estimators", "min_samples_split")
NO_SPLIT = (-1, [], -1)


def least_to_split(value: int | float | None, rows: int) -> int:
    """Rows that a node needs to be split; a share counts of all training rows."""
    if value is None:
        return 2
    if isinstance(value, float) and value <= 1:
        return max(2, math.ceil(value * rows))
    if value < 2:
        raise ValueError(f"min_samples_split={value} is below 2")
    return int(value)


@dataclass
class Tree:
    """Nodes in preorder, children as places of nodes, -1 at leaves."""

    rows: list[Any]
    left: np.ndarray
    right: np.ndarray
    count: np.ndarray
    stats: np.ndarray
    predicted: np.ndarray
    depth: np.ndarray

    @staticmethod
    def of(rows: list[Any]) -> Tree:
        rows = sorted(rows, key=lambda r: r["id"])
        left, right = (np.array([r[c] for r in rows]) for c in ("leftChild", "rightChild"))
        depth = np.zeros(len(rows), dtype=int)
        for i in np.flatnonzero(left >= 0):
            depth[left[i]] = depth[right[i]] = depth[i] + 1
        stats = np.array([r["impurityStats"] for r in rows], dtype=float)
        return Tree(rows, left, right, np.array([r["rawCount"] for r in rows]), stats, np.array([r["prediction"] for r in rows]), depth)

    def leaves(self, max_depth: int | None = None, least: int = 2) -> np.ndarray:
        """Which nodes are leaves, or below one, if depth and splits are bounded.

        Two leaves of the same label are one leaf, as in every fitted tree.
        """
        leaf = (self.left < 0) | (self.count < least)
        if max_depth is not None:
            leaf |= self.depth >= max_depth
        for i in range(len(leaf) - 1, -1, -1):  # children come after their parents
            if not leaf[i]:
                a, b = self.left[i], self.right[i]
                leaf[i] = leaf[a] and leaf[b] and self.predicted[a] == self.predicted[b]
        return leaf

    def ends(self, leaf: np.ndarray) -> np.ndarray:
        """For every leaf of the whole tree, in preorder, the node at which a row of it ends."""
        end = np.arange(len(leaf))
        for i in np.flatnonzero(self.left >= 0):
            if leaf[i]:
                end[self.left[i]] = end[self.right[i]] = end[i]
                leaf = leaf.copy()
                leaf[self.left[i]] = leaf[self.right[i]] = True
        return end[self.left < 0]

    def kept(self, leaf: np.ndarray) -> list[tuple]:
        """The rows of the smaller tree, numbered in preorder."""
        out: list = []
        stack = [(0, None)]
        while stack:
            i, parent = stack.pop()
            number = len(out)
            if parent is not None:
                out[parent[0]][parent[1]] = number
            r = self.rows[i]
            head = [number, r["prediction"], r["impurity"], r["impurityStats"], r["rawCount"]]
            if leaf[i]:
                out.append([*head, -1.0, -1, -1, NO_SPLIT])
            else:
                out.append([*head, r["gain"], None, None, r["split"]])
                stack += [(int(self.right[i]), (number, 7)), (int(self.left[i]), (number, 6))]
        return [tuple(r) for r in out]


def _saved(model, scratch: Scratch) -> tuple[str, DataFrame]:
    """The folder of the saved model and its node table with the columns ``treeID, nodeData``."""
    path = scratch.path("model")
    model.write().overwrite().save(path)
    nodes = scratch.spark.read.parquet(f"{path}/data")
    if "nodeData" not in nodes.columns:
        nodes = nodes.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    return path, nodes


def trees_of(nodes: DataFrame) -> list[Tree]:
    found: dict[int, list] = {}
    for r in nodes.collect():
        found.setdefault(r["treeID"], []).append(r["nodeData"])
    return [Tree.of(found[i]) for i in sorted(found)]


def with_least_split(model, least: int, spark: SparkSession):
    """The fitted tree or forest without splits of nodes that have fewer than ``least`` training rows."""
    if least <= 2:
        return model
    with Scratch(spark, "trees") as scratch:
        path, nodes = _saved(model, scratch)
        rows = [(i, row) for i, tree in enumerate(trees_of(nodes)) for row in tree.kept(tree.leaves(least=least))]
        changed = spark.createDataFrame(rows, nodes.schema)
        smaller = scratch.path("smaller")
        forest = isinstance(model, RandomForestClassificationModel)
        (changed if forest else changed.select("nodeData.*")).write.parquet(f"{smaller}/data")
        spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{smaller}/metadata")
        if forest:
            spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{smaller}/treesMetadata")
        kind = RandomForestClassificationModel if forest else DecisionTreeClassificationModel
        return kind.load(smaller)


def families(candidates: list[dict[str, Any]]) -> list[tuple[dict[str, Any], list[int]]]:
    """Candidates that differ in nested parameters only, each group with the other parameters and its places."""
    groups: list[tuple[dict[str, Any], list[int]]] = []
    for i, params in enumerate(candidates):
        rest = {k: v for k, v in params.items() if k not in NESTED}
        for other, places in groups:
            if other == rest:
                places.append(i)
                break
        else:
            groups.append((rest, [i]))
    return groups


def largest(params: list[dict[str, Any]], default_trees: int = 100) -> dict[str, Any]:
    """The nested parameters of a model that holds all of ``params``."""
    depths = [p.get("max_depth") for p in params]
    out: dict[str, Any] = {"max_depth": None if None in depths else max(depths)}
    if any("n_estimators" in p for p in params):
        out["n_estimators"] = max(p.get("n_estimators", default_trees) for p in params)
    return out


def count_nested(model, rows: DataFrame, params: list[dict[str, Any]], size: int, label: str, leaf: str = "rs_leaf") -> list[list[tuple[float, float, int]]]:
    """``(label, predicted, n)`` counts of every candidate, in one pass over ``rows``.

    ``model`` holds all candidates; ``size`` is the number of its training rows. A row goes down the large trees
    once, to one leaf in each; what a smaller tree says there was looked up beforehand.
    """
    forest = isinstance(model, RandomForestClassificationModel)
    with Scratch(rows.sparkSession, "nested") as scratch:
        trees = trees_of(_saved(model, scratch)[1])
    tables = []
    for p in params:
        n = p.get("n_estimators", 100) if forest else 1
        depth, least = p.get("max_depth"), least_to_split(p.get("min_samples_split"), size)
        parts = []
        for tree in trees[:n]:
            stats = tree.stats[tree.ends(tree.leaves(None if depth is None else int(depth), least))]
            total = stats.sum(axis=1, keepdims=True)
            parts.append(np.divide(stats, total, out=np.zeros_like(stats), where=total != 0) if forest else stats)
        tables.append(parts)
    shared = rows.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False)
            leaves = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            for c, parts in enumerate(shared.value):
                votes = parts[0][leaves[:, 0]]
                for k in range(1, len(parts)):
                    votes = votes + parts[k][leaves[:, k]]
                pairs, n = np.unique(np.stack([y, votes.argmax(axis=1)], axis=1), axis=0, return_counts=True)
                for (a, b), m in zip(pairs.tolist(), n.tolist()):
                    counts[c, a, b] = counts.get((c, a, b), 0) + m
        flat = list(zip(*((*k, n) for k, n in counts.items()))) or [[]] * 4
        types = (pa.int32(), pa.float64(), pa.float64(), pa.int64())
        yield pa.record_batch([pa.array(x, t) for x, t in zip(flat, types)], names=["candidate", "t", "p", "n"])

    model = model.copy({model.leafCol: leaf})
    scored = model.transform(rows)
    where = vector_to_array(leaf) if forest else F.array(leaf)
    found = scored.select(F.col(label).cast("double"), where).mapInArrow(run, "candidate int, t double, p double, n bigint")
    out: list[list[tuple[float, float, int]]] = [[] for _ in params]
    for r in found.groupBy("candidate", "t", "p").agg(F.sum("n").alias("n")).collect():
        out[r["candidate"]].append((r["t"], r["p"], r["n"]))
    shared.unpersist()
    return out
