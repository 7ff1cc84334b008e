"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, and only the bag has a label. Every passage of the whole text is
encoded (how character classes follow each other, and how words repeat), a gated attention network
learns from document labels which passages matter, and the score comes from the attention-weighted
passage representation. The network is trained in numpy on a bounded, hash-ordered sample of
labelled documents (``PER_CLASS`` of each label, bags of at most ``BAG`` passages; both are
parameters, and bound what reaches the driver to 150 MB); a longer document gives ``BAG`` passages spread over its whole
text. Scoring encodes all passages of all documents, in one pass without a shuffle.

Defined cases: a null text counts as empty; an empty text is one passage without content and gets the
score that the model gives to it. Documents labelled both 0 and 1, or null, are not learnt from.
Repeated label rows count once. A document id that repeats is learnt from once, whatever its texts. Very long texts are scored
whole. An empty table gives no rows. Other columns, whatever their names, are left alone. Without labels of both kinds there is nothing to learn: every score is
the share of label 1, or 1.0 without any label. Rows that repeat a document are scored alike.
Nothing but the text enters a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import give_back, map_batches, whole_text

PER_CLASS, BAG, PASSAGE, ACCEPT = 3000, 64, 768, 0.7
HIDDEN, GATE, EPOCHS, SEED = 24, 12, 30, 7
GROUP_BYTES = 500_000

# Classes of bytes: letters, digits and blanks, each common mark by itself, other marks, non-ASCII.
MARKS = b".,;:!?*#%$&|@/=_<>()[]{}\"'-+~^`\\"
CLASSES = 6 + len(MARKS) + 2


def _class_table() -> np.ndarray:
    table = np.full(256, 6 + len(MARKS), dtype=np.int32)
    table[list(b" \t\r\x0b\x0c")] = 0
    table[10] = 1
    table[ord("a") : ord("z") + 1] = 2
    table[list(b"aeiou")] = 3
    table[ord("A") : ord("Z") + 1] = 4
    table[ord("0") : ord("9") + 1] = 5
    for i, mark in enumerate(MARKS):
        table[mark] = 6 + i
    table[128:] = 7 + len(MARKS)
    return table


CLASS_OF = _class_table()
# What follows what is kept for the first classes only; marks count by themselves.
PAIRED = 6
FEATURES = CLASSES + (PAIRED + 1) ** 2 + 6


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages of all texts, one row each, and how many passages each text has.

    Passages are consecutive windows of ``PASSAGE`` bytes; every byte is in exactly one.
    """
    sizes = [max(1, -(-len(t) // PASSAGE)) for t in texts]
    count = sum(sizes)
    counts = np.array(sizes, dtype=np.int64)
    out = np.zeros((count, FEATURES), dtype=np.float32)
    lengths = np.empty(count, dtype=np.int64)
    at = 0
    for text in texts:
        for i in range(0, max(1, len(text)), PASSAGE):
            window = text[i : i + PASSAGE]
            lengths[at] = len(window)
            words = window.split()
            n = len(words)
            if n:
                distinct = len(set(words))
                same = sum(map(bytes.__eq__, words, words[1:]))
                out[at, -6:] = (distinct / n, same / n, min(1.0, len(window) / n / 40), min(1.0, n / 200), max(map(len, words)) / PASSAGE, 1.0)
            at += 1
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data):
        kind = CLASS_OF[data]
        owner = np.repeat(np.arange(count, dtype=np.int32), lengths)
        share = np.maximum(lengths, 1)[:, None]
        singles = np.bincount(owner * CLASSES + kind, minlength=count * CLASSES).reshape(count, CLASSES)
        out[:, :CLASSES] = np.sqrt(singles / share)
        few = np.minimum(kind, PAIRED)
        inside = owner[1:] == owner[:-1]
        side = PAIRED + 1
        code = (owner[1:] * (side * side) + few[:-1] * side + few[1:])[inside]
        pairs = np.bincount(code, minlength=count * side * side).reshape(count, side * side)
        out[:, CLASSES:-6] = np.sqrt(pairs / share)
    return out, counts


def spread(text: bytes, bag: int) -> bytes:
    """The text, or ``bag`` of its passages at even distances where it has more."""
    n = -(-len(text) // PASSAGE)
    if n <= bag:
        return text
    return b"".join(text[i * n // bag * PASSAGE : (i * n // bag + 1) * PASSAGE] for i in range(bag))


@dataclass
class Model:
    """Gated attention over encoded passages; ``constant`` replaces it where nothing could be learnt."""

    constant: float | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def scores(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of each bag: 0 to 1."""
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        return _forward(self.weights, x, counts)["p"]


def _forward(w: dict, x: np.ndarray, counts: np.ndarray) -> dict:
    first = np.cumsum(counts) - counts
    bag = np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (t * g) @ w["a"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    attention = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(attention[:, None] * h, first, axis=0)
    logit = np.clip(z @ w["c"] + w["d"][0], -30, 30)
    return {"h": h, "t": t, "g": g, "attention": attention, "z": z, "p": 1 / (1 + np.exp(-logit)), "bag": bag, "first": first}


def _gradient(w: dict, x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    f = _forward(w, x, counts)
    h, t, g, attention, bag, first = (f[k] for k in ("h", "t", "g", "attention", "bag", "first"))
    err = weight * (f["p"] - y) / weight.sum()
    dz = err[:, None] * w["c"]
    at_h = (dz[bag] * h).sum(axis=1)  # how the loss moves with each passage's attention
    e = attention * (at_h - np.add.reduceat(attention * at_h, first)[bag])
    dt, dg = e[:, None] * w["a"] * g * (1 - t * t), e[:, None] * w["a"] * t * g * (1 - g)
    dh = (attention[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
    return {
        "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ e,
        "c": f["z"].T @ err, "d": np.array([err.sum()]),
    }


def fit(features: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Trains on bags with labels ``y``; the same input always gives the same model."""
    rng = np.random.default_rng(SEED)
    mean, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 0.02)
    x = np.clip((features - mean) / scale, -8, 8).astype(np.float64)
    w = {
        "W": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b": np.zeros(HIDDEN),
        "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE),
        "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1),
    }
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    first = np.cumsum(counts) - counts
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(counts))
        for i in range(0, len(order), 64):
            chosen = order[i : i + 64]
            rows = np.concatenate([np.arange(first[b], first[b] + counts[b]) for b in chosen])
            grad = _gradient(w, x[rows], counts[chosen], y[chosen], weight[chosen])
            step += 1
            for k in w:
                d = grad[k] + (1e-4 * w[k] if w[k].ndim > 1 else 0)
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean=mean, scale=scale, weights=w)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(labels: DataFrame, per_class: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """At most ``per_class`` ids of each label in hash order, and how many there are of each."""
    clean = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id")
    clean = clean.agg(F.min("quality").alias("q"), F.max("quality").alias("other"), F.count(F.when(F.col("quality").isNull(), 1)).alias("n"))
    clean = clean.where("q = other AND n = 0 AND q IN (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("q").cast("int").alias("q"))
    sizes = {r["q"]: r["n"] for r in clean.groupBy("q").agg(F.count("*").alias("n")).collect()}
    chosen = [
        (r["doc_id"], q) for q in sizes for r in clean.where(F.col("q") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    ]
    return chosen, sizes


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, bag: int = BAG) -> Model:
    """Learns from the labelled, not held out documents among ``docs``."""
    chosen, sizes = labelled_sample(labels, per_class)
    if not chosen:
        return Model(constant=1.0)
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, q int")  # at most twice ``per_class`` rows
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            features, counts = passages([spread(t.as_py().encode(), bag) for t in batch.column(1)])
            ends = np.cumsum(counts)
            cells = [features[e - n : e].tobytes() for e, n in zip(ends, counts)]
            return pa.record_batch([batch.column(0), batch.column(2), pa.array(cells, pa.binary())], names=["doc_id", "q", "cells"])

        return work

    bags = map_batches(rows.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "q"), make, "doc_id bigint, q int, cells binary")
    once = bags.groupBy("doc_id", "q").agg(F.min("cells").alias("cells"))  # rows that repeat a document count once
    found = sorted(once.collect(), key=lambda r: r["doc_id"])  # at most twice ``per_class`` rows of ``bag`` passages
    have = {q: sum(r["q"] == q for r in found) for q in (0, 1)}
    if not have[0] or not have[1]:
        return Model(constant=sizes.get(1, 0) / sum(sizes.values()))
    cells = [np.frombuffer(r["cells"], dtype=np.float32).reshape(-1, FEATURES) for r in found]
    y = np.array([r["q"] for r in found], dtype=np.float64)
    # Each label weighs as much as it does among all labels, so that a score is a probability.
    weight = np.array([sizes[int(q)] / have[int(q)] for q in y])
    return fit(np.concatenate(cells), np.array([len(c) for c in cells]), y, weight / weight.mean())


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores of a batch's texts; only ``GROUP_BYTES`` of them are taken out at a time. A null counts as empty."""
    out, group, size = [], [], 0
    for cell in texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()):
        text = cell.as_py() or b""
        group.append(text)
        size += len(text)
        if size > GROUP_BYTES:
            out.append(model.scores(*passages(group)))
            group, size = [], 0
    if group:
        out.append(model.scores(*passages(group)))
    return np.concatenate(out).astype(np.float64)


def score(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = _scores(model, batch.column(1))
            return pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= accept).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return map_batches(rows, make, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the model accepts, all columns as they were. Only texts go to Python, only scores come back."""

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        scores = pa.array(_scores(model, texts) if len(texts) else [], pa.float64())
        give_back()
        return scores

    return docs.where(quality(whole_text()) >= accept)
