"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A document is the set of its distinct word shingles, and its signature has ``CHUNKS * WIDTH`` values of
16 bits, each the low bits of a minimum under another hash function. Signatures are split into
chunks. By the pigeonhole principle, two signatures that differ in fewer than ``CHUNKS * (ERRORS +
1)`` values have a chunk with at most ``ERRORS`` differing values, so for each chunk all choices of
``ERRORS`` positions to ignore are enumerated and the rest is a join key. Every pair below that
distance shares a key; a pair at the similarity threshold misses every key with a probability
of about 2e-5 with the default widths. Every candidate is confirmed on the full shingle sets.

Sets that are equal are one class from the start, by a digest, so copies cost nothing. Candidates
are not paired off within a key's group. First each class meets the smallest class of its groups
that shares most keys with it; what this links is contracted to components. Only keys whose
members still lie in different components are looked at again, in blocks of bounded size. Pairs across
components whose sizes allow the similarity and whose signatures are close are not confirmed one by
one: each block hands on a star over the components that they touch, and what stars connect is a
cluster. Every candidate pair lies within one cluster, and in each cluster all classes outside its
largest component meet all classes, in blocks of full sets that are sized by their shingles; again a block hands on
a star. So rows grow with the classes and not with their pairs, and no pair is given up.

Defined cases: a null text counts as empty; texts without words have no shingles and link with nothing.
A text with fewer words than a shingle is one shingle. Rows that repeat an id are one document as
regards links. A row without id takes part through its class and is kept only if its whole class has
no id. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import components, drop_ids, give_back, map_batches, whole_text
from rowsmith.session import Scratch

CHUNKS, WIDTH, ERRORS, SEED = 10, 6, 1, 19
VALUES = CHUNKS * WIDTH
# Signatures that a block holds, and shingles of the full sets that a block holds; a larger set is a block of its own.
BLOCK, SET_BLOCK = 1024, 200_000
# Groups of at most this many classes are paired by a plain join; larger ones meet in blocks.
SMALL = 24
# The distance of the join: pairs whose signatures differ in more than this share of their values are no candidates.
# At a similarity of 0.8 a fifth differs on average, with a deviation of a twentieth, so 4.9e-8 of such pairs are beyond it.
FAR = 0.5
# Bytes of a block from which on the memory of its work is given back.
LARGE = 8_000_000
# Hash values kept per process.
WORDS_KEPT = 100_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(SEED)
_PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDEND = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64)
_KEY = _RNG.integers(0, 2**63, (CHUNKS, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IGNORED = list(combinations(range(WIDTH), ERRORS))
_SALT = _RNG.integers(0, 2**63, (CHUNKS, len(_IGNORED)), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_words = _Words()


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.array(list(map(_words.__getitem__, words)), dtype=np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total += _mixed(hashes[k : k + n] + np.uint64(k)) * _PLACE[k % 64]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``VALUES`` numbers of 16 bits."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(low, (shingles[i : i + 2048, None] * _FACTOR + _ADDEND).min(axis=0), out=low)
    return ((low >> np.uint64(12)) & np.uint64(0xFFFF)).astype(np.uint16)


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """The join keys of each signature: one per chunk and choice of values to ignore."""
    chunks = signatures.reshape(len(signatures), CHUNKS, WIDTH).astype(np.uint64) + np.uint64(1)
    terms = chunks * _KEY
    whole = terms.sum(axis=2)
    keys = [_mixed(whole - terms[:, :, list(left_out)].sum(axis=2) + _SALT[:, j]) for j, left_out in enumerate(_IGNORED)]
    return np.stack(keys, axis=2).reshape(len(signatures), -1).view(np.int64)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))


def features(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` of every whole text; digest and signature are null without shingles."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, digests, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signatures.append(signature(s).tobytes() if len(s) else None)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            return pa.record_batch(columns, names=["doc_id", "n_shingles", "digest", "signature"])

        return work

    return map_batches(_documents(docs), make, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def shingle_table(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, shingles`` of every whole text."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(text, size).view(np.int64) for text in batch.column(1).to_pylist()]
            return pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

        return work

    return map_batches(_documents(docs), make, "doc_id bigint, shingles array<bigint>")


def key_table(classes: DataFrame) -> DataFrame:
    """``key, node`` for each join key of each class."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            signatures = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, VALUES)
            keys = keys_of(signatures)
            nodes = np.repeat(np.array(batch.column(0).to_pylist(), dtype=np.int64), keys.shape[1])
            return pa.record_batch([pa.array(keys.ravel()), pa.array(nodes)], names=["key", "node"])

        return work

    return map_batches(classes.select("node", "signature"), make, "key bigint, node bigint")


def _spanning(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """For the links ``a, b`` a star of each connected part, around its smallest member: fewer rows than members."""
    names, place = np.unique(np.concatenate([a, b]).astype(np.int64), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    leaves = np.flatnonzero(root != np.arange(len(names)))
    return pd.DataFrame({"a": names[leaves], "b": names[root[leaves]]})


def _across(left: pd.DataFrame, right: pd.DataFrame, far: float, percent: int) -> pd.DataFrame:
    """Stars over the components that candidates of two blocks of a key's group connect.

    On the left stand the classes outside the group's largest component, on the right all.
    """
    found = np.zeros((0, 2), dtype=np.int64)
    if len(left) and len(right):
        x, y = (np.frombuffer(b"".join(d["signature"]), dtype=np.uint16).reshape(-1, VALUES) for d in (left, right))
        cx, cy, nx, ny = (d[c].to_numpy() for c in ("component", "n") for d in (left, right))
        for i in range(0, len(x), 64):
            differ = np.zeros((len(x[i : i + 64]), len(y)), dtype=np.int16)
            for k in range(VALUES):
                differ += x[i : i + 64, k, None] != y[None, :, k]
            n = nx[i : i + 64, None]
            fits = 100 * np.minimum(n, ny) >= percent * np.maximum(n, ny)
            row, col = np.nonzero((differ <= far * VALUES) & fits & (cx[i : i + 64, None] != cy))
            found = np.unique(np.concatenate([found, np.stack([cx[row + i], cy[col]], axis=1)]), axis=0)
    return _spanning(found[:, 0], found[:, 1])


def _block_links(asking: pd.DataFrame, members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Stars over the classes of two blocks that are similar enough by full sets and lie in different components."""
    found: tuple[list, list] = ([], [])
    if len(asking) and len(members):
        sets = [np.asarray(v) for v in (*asking["shingles"], *members["shingles"])]
        sizes = np.array(list(map(len, sets)))
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        split = sizes[: len(asking)].sum()
        own, theirs = np.split(ids[:split], np.cumsum(sizes[: len(asking)])[:-1]), ids[split:]
        n = sizes[len(asking) :]
        first = np.cumsum(n) - n
        flag = np.zeros(ids.max() + 1, dtype=np.int32)
        nodes, component = members["node"].to_numpy(), members["component"].to_numpy()
        for node, of, shingles in zip(asking["node"], asking["component"], own):
            fits = (100 * np.minimum(n, len(shingles)) >= percent * np.maximum(n, len(shingles))) & (component != of)
            if fits.any():
                flag[shingles] = 1
                common = np.add.reduceat(flag[theirs], first)
                flag[shingles] = 0
                similar = nodes[fits & (100 * common >= percent * (n + len(shingles) - common))]
                found[0].append(np.full(len(similar), node))
                found[1].append(similar)
    return _spanning(*(np.concatenate([np.zeros(0, dtype=np.int64), *f]) for f in found))


def _sets_of(nodes: DataFrame, docs: DataFrame, scratch: Scratch, size: int) -> DataFrame:
    """``doc_id, shingles`` of the documents named in ``nodes``; only these are read out in full."""
    nodes = scratch.write(nodes.toDF("doc_id").distinct(), "asked")
    wanted = drop_ids(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), nodes, how="left_semi")
    return scratch.write(shingle_table(wanted, size).distinct(), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    sets = _sets_of(pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))), docs, scratch, size)
    both = pairs.select("a", "b").join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    return scratch.write(both.where(100 * common >= percent * union).select("a", "b"), "confirmed")


def met_in_blocks(left: DataFrame, right: DataFrame, keys: list[str], meet) -> DataFrame:
    """``a, b`` of ``meet(left rows, right rows)`` for every value of ``keys``.

    Blocks hold like amounts of work but few bytes, so they are dealt to a stated number of tasks.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = []
    for rows, prefix in ((left, "x_"), (right, "y_")):
        rows = rows.select(*(F.col(c).alias(prefix + c) for c in rows.columns)).repartition(tasks, *(prefix + k for k in keys))
        sides.append(rows.groupBy(*(prefix + k for k in keys)))

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = meet(x.rename(columns=lambda c: c[2:]), y.rename(columns=lambda c: c[2:]))
        if x.memory_usage(deep=True).sum() + y.memory_usage(deep=True).sum() > LARGE:
            give_back()
        return found

    return sides[0].cogroup(sides[1]).applyInPandas(run, "a bigint, b bigint")


def confirmed_clusters(edges: DataFrame, placed: DataFrame, sizes: DataFrame, docs: DataFrame, scratch: Scratch, size: int, percent: int, block: int) -> DataFrame:
    """Links ``a, b`` within what the candidate ``edges`` between components connect.

    ``placed`` has ``node, component`` of every class that shares a key, ``sizes`` its ``node, n``.
    """
    clusters = components(edges, scratch).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    members = scratch.write(placed.select("node", "component").distinct().join(clusters, "component").join(sizes, "node"), "members")
    each = members.groupBy("cluster", "component").agg(F.count("*").alias("count"), F.sum("n").alias("n"))
    per_cluster = each.groupBy("cluster").agg(F.max(F.struct("count", "component", "n")).alias("t"), F.sum("n").alias("n"))
    # Within the largest component nothing is left to find, so only the others ask.
    per_cluster = per_cluster.select(
        "cluster", F.col("t.component").alias("top"),
        F.ceil((F.col("n") - F.col("t.n")) / block).cast("int").alias("x_blocks"), F.ceil(F.col("n") / block).cast("int").alias("y_blocks"),
    )
    members = members.drop("n").join(per_cluster, "cluster")
    members = scratch.write(members, "clustered")
    sets = _sets_of(members.select("node"), docs, scratch, size).withColumnRenamed("doc_id", "node")

    def side(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other)
        return rows.join(sets, "node").select("cluster", mine, every, "node", "component", "shingles")

    asking, asked = side(members.where("component != top"), "x", "y"), side(members, "y", "x")
    met = met_in_blocks(asking, asked, ["cluster", "x", "y"], lambda x, y: _block_links(x, y, percent))
    return scratch.write(met, "clusters")


def annotate(docs: DataFrame, size: int = 2, percent: int = 80, far: float = FAR, block: int = BLOCK, set_block: int = SET_BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; links are similarities of ``percent`` hundredths or more."""
    spark = docs.sparkSession
    with Scratch(spark, "minhash") as scratch:
        rows = scratch.write(features(docs, size), "features")
        grouped = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        classes = grouped.agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
        classes = scratch.write(classes, "classes")
        # A set of n can only be similar to another one if one more shingle leaves it similar enough.
        keys = key_table(classes.where(100 * F.col("n") >= percent * (F.col("n") + 1)))
        groups = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
        shared = scratch.write(keys.join(groups.select("key", "low"), "key"), "groups")

        # Each class and the smallest class of a group that it shares most keys with.
        met = shared.where("node != low").groupBy("node", "low").agg(F.count("*").alias("n"))
        best = met.groupBy("node").agg(F.max(F.struct("n", (-F.col("low")).alias("low"))).alias("m"))
        pairs = best.select(F.col("node").alias("a"), (-F.col("m.low")).alias("b"))
        signed = classes.select("node", "n", "signature")
        pairs = _close(pairs, signed, far, percent)
        pairs = scratch.write(pairs, "first")
        links = confirmed(pairs, docs, scratch, size, percent)

        # What is still apart within a key's group.
        roots = components(links, scratch)
        sizes = roots.groupBy("component").agg(F.count("*").alias("members")).where(F.col("members") > 1)
        placed = shared.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        placed = placed.join(sizes, "component", "left").select("key", "node", "component", F.coalesce("members", F.lit(1)).alias("members"))
        placed = scratch.write(placed, "placed")
        top = F.max(F.struct("members", "component"))
        split = placed.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("n"), top.alias("t")).where("c != d")
        split = scratch.write(split.select("key", F.col("n").alias("group"), F.col("t.component").alias("top")), "split")

        few = placed.join(split.where(F.col("group") <= SMALL).select("key"), "key").drop("members")
        apart = few.toDF("key", "a", "c").join(few.toDF("key", "b", "d"), "key").where("a < b AND c != d").drop("key").distinct()
        near = _stars(apart, signed, far, percent)

        # Within the largest component of a group nothing is left to find, so only the others ask.
        mixed = scratch.write(placed.join(split.where(F.col("group") > SMALL), "key").join(signed, "node"), "mixed")
        asking = mixed.where("component != top")
        counts = asking.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("x_blocks"))

        def side(rows: DataFrame, own: str, other: str) -> DataFrame:
            rows = rows.join(counts, "key").withColumn("y_blocks", F.ceil(F.col("group") / block).cast("int"))
            mine = F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int").alias(own)
            every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other)
            return rows.select("key", mine, every, "component", "n", "signature")

        met = met_in_blocks(side(asking, "x", "y"), side(mixed, "y", "x"), ["key", "x", "y"], lambda x, y: _across(x, y, far, percent))
        edges = near.unionByName(met).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = scratch.write(edges, "edges")
        if not edges.isEmpty():
            new = confirmed_clusters(edges, placed, classes.select("node", "n"), docs, scratch, size, percent, set_block)
            links = links.unionByName(new)
            roots = components(links, scratch)

        per_class = classes.join(roots, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
        per_class = scratch.write(per_class, "components")
        out = rows.join(per_class, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        return scratch.write(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "rows", keep=True)


def _signed_pairs(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (``a, b`` and others) whose sizes allow the similarity, with both signatures ``x`` and ``y``."""
    both = pairs.join(signed.toDF("a", "m", "x"), "a").join(signed.toDF("b", "n", "y"), "b")
    return both.where(100 * F.least("m", "n") >= percent * F.greatest("m", "n")).select(*pairs.columns, "x", "y")


def _near(batch: pa.RecordBatch, far: float) -> pa.Array:
    """Whether the signatures of each row differ in at most the share ``far``."""
    x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, VALUES) for c in ("x", "y"))
    return pa.array((x != y).sum(axis=1) <= far * VALUES)


def _close(pairs: DataFrame, signed: DataFrame, far: float, percent: int) -> DataFrame:
    """The rows of ``pairs`` (``a, b`` and others) whose sizes allow the similarity and whose signatures differ in at most the share ``far``."""
    kept = pairs.columns

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.select(kept).filter(_near(batch, far))

        return work

    return map_batches(_signed_pairs(pairs, signed, percent), make, pairs.schema)


def _stars(pairs: DataFrame, signed: DataFrame, far: float, percent: int) -> DataFrame:
    """``a, b``: for the close rows of every batch of ``pairs``, stars that connect what their columns ``c, d`` connect.

    Closeness and stars are one function, so that a task needs one Python worker for both.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            close = batch.select(["c", "d"]).filter(_near(batch, far))
            return pa.RecordBatch.from_pandas(_spanning(*(np.asarray(c) for c in close.columns)), preserve_index=False)

        return work

    return map_batches(_signed_pairs(pairs, signed, percent), make, "a bigint, b bigint")


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of every group of near copies, with all columns of ``docs``."""
    judged = annotate(docs, size, percent)
    with Scratch(docs.sparkSession, "minhash") as scratch:
        dropped = scratch.write(judged.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "dropped", keep=True)
    return drop_ids(docs, dropped)
