"""Document scores of a log-bilinear language model, trained by noise-contrastive estimation.

Tokens are lower-cased words and one end of text. Counts of all training tokens give the base, an add-one
unigram score. The model predicts symbols: the end, the most frequent words, and classes of all other
words by their last two bytes. The vectors of the last ``CONTEXT`` symbols, each scaled by the weights of its
position, add up to a prediction, whose products with all symbols' vectors, plus their biases, are
normalised over all symbols. Within a class, words share by add-one counts with one place for unseen words,
so probabilities over all words that were counted and one unseen word per class add up to one.

Training reads every training document once, in ``ROUNDS`` of growing size. In each round every task goes
on from the last round's weights over its own documents, by noise-contrastive steps against samples of
the symbols' counts, and the weights are averaged over tasks by their numbers of tokens. The average is a
Spark aggregate; the driver holds one copy of the weights, whatever the number of tasks. Scoring
multiplies each distinct context of a task's tokens with all symbols once.

Counts of words that are not among the ``KNOWN`` most frequent ones are looked up by a join, so nothing is
broadcast that grows with the corpus, and no word is cut off.

Defined cases: a null text counts as empty; an empty text is one end token. A null ``doc_id`` has no
remainder and is trained on. Rows that repeat an id or a text all count. Texts of any length are scored
whole. Without training documents all counts are 0 and every symbol is equally likely; an empty table
gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import whole_text
from rowsmith.session import Scratch

# Symbols that stand for one word each, the end among them, and classes of the other words.
SHORT, CLASSES = 448, 64
# Symbols of a context, numbers of a vector.
CONTEXT, WIDTH = 2, 32
# Words whose counts every task knows; about 30 bytes each.
KNOWN = 131_072
# For each round the parts of 16 of the training documents that it reads, and the tokens of a step.
ROUNDS = ((1, 256), (3, 512), (12, 2048))
# Noise samples of a step, the step size of the first round.
NOISE, RATE = 64, 0.25
# The largest part of a step's tokens that share one context is one of this many.
SHARE = 32
# Products of this many multiplications are done in one thread by common BLAS libraries; the threads of a task
# that shares its machine with others only wait for each other.
SINGLE = 200_000
# Tokens that are scored together, and rows of a product.
STRETCH, PRODUCT = 500_000, 4096
# Distinct words that a task counts before it hands them on.
COUNTED = 500_000
# Words up to this length are their own keys.
LONGEST = 40
END = b""

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The tokens of a UTF-8 text, the end left out, as keys: words, or digests of very long ones behind their first bytes."""
    return [w if len(w) <= LONGEST else w[: LONGEST - 15] + xxhash.xxh3_128_digest(w) for w in text.translate(_LOWER).split()]


def class_of(key: bytes) -> int:
    """The class of a word that is not on the short list."""
    return zlib.crc32(key[-2:]) % CLASSES


def class_column(key: str) -> Column:
    return F.pmod(F.crc32(F.substring(key, -2, 2)), F.lit(CLASSES)).cast("int")


def remainder(doc_id: str = "doc_id", parts: int = 7) -> Column:
    """The remainder of a document's hash, by which documents are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def _documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, part, text`` of every row; ``part`` of 16 places it in a round."""
    held_out = F.coalesce(remainder() == 2, F.lit(False))
    text = whole_text().cast("binary")
    part = F.pmod(F.xxhash64("doc_id", F.length(text)), F.lit(16)).cast("int")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), part.alias("part"), text.alias("text"))


def token_counts(rows: DataFrame) -> DataFrame:
    """``key, n`` of every token of the rows, ends included."""

    def table(totals: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            totals[END] += batch.num_rows
            for text in batch.column(0).to_pylist():
                totals.update(words_of(text))
                if len(totals) > COUNTED:
                    yield table(totals)
                    totals.clear()
        yield table(Counter({k: n for k, n in totals.items() if n}))

    return rows.select("text").mapInArrow(run, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task knows of the counts. Codes number the known words; behind them stands one code for each class."""

    keys: list[bytes]
    counts: np.ndarray
    class_total: np.ndarray
    class_words: np.ndarray
    total: int
    words: int

    def __post_init__(self):
        classes = np.arange(CLASSES)
        of_word = np.array([class_of(k) for k in self.keys], dtype=np.int64)
        single = np.arange(len(self.keys)) < SHORT
        self.symbol = np.concatenate([np.where(single, np.arange(len(self.keys)), SHORT + of_word), SHORT + classes]).astype(np.int32)
        within = np.log10((self.counts + 1) / (self.class_total + self.class_words + 1)[of_word])
        # What rare words have is added behind the join that finds their counts.
        self.within = np.concatenate([np.where(single, 0.0, within), np.zeros(CLASSES)])
        self.base = np.concatenate([np.log10((self.counts + 1) / self.denominator), np.zeros(CLASSES)])
        self.seen = np.concatenate([(self.counts > 0).astype(np.int64), np.zeros(CLASSES, dtype=np.int64)])
        weight = np.zeros(SHORT + CLASSES)
        weight[: min(SHORT, len(self.keys))] = self.counts[:SHORT]
        weight[SHORT:] = self.class_total
        self.noise = (weight + 1) / (weight + 1).sum()

    @property
    def denominator(self) -> int:
        return self.total + self.words + 1


class Codes(dict):
    """Codes of words; of a word that is not known, that of its class."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(zip(vocabulary.keys, range(len(vocabulary.keys))))
        self.known = len(vocabulary.keys)

    def __missing__(self, key: bytes) -> int:
        return self.known + class_of(key)


def frequent(counts: DataFrame) -> list[tuple[bytes, int]]:
    """At most ``KNOWN`` of the words, all above a count that a histogram shows; no task sends more than is kept.

    The end comes first, whatever its count; ties follow the order of the keys.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    steps = {r["s"]: r["words"] for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("words")).collect()}
    low, room = max(steps, default=0) + 1, KNOWN - 1
    for s in sorted(steps, reverse=True):
        room -= steps[s]
        if room < 0:
            break
        low = s
    rows = counts.where((step >= low) | (F.col("key") == F.lit(END))).collect()
    found = {END: 0} | {bytes(r["key"]): r["n"] for r in rows}
    return sorted(found.items(), key=lambda x: (x[0] != END, -x[1], x[0]))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The most frequent words of the written table ``counts``, and totals of all others by class."""
    whole = counts.agg(F.sum("n").alias("total"), F.count("*").alias("words")).first()
    top = frequent(counts)
    keys, n = [k for k, _ in top], [c for _, c in top]
    of_class = {r["c"]: (r["n"], r["words"]) for r in counts.groupBy(class_column("key").alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    total = np.array([of_class.get(c, (0, 0))[0] for c in range(CLASSES)], dtype=np.int64)
    words = np.array([of_class.get(c, (0, 0))[1] for c in range(CLASSES)], dtype=np.int64)
    for k, count in top[:SHORT]:
        if count:
            total[class_of(k)] -= count
            words[class_of(k)] -= 1
    return Vocabulary(keys, np.array(n, dtype=np.int64), total, words, whole["total"] or 0, whole["words"])


@dataclass
class Model:
    """Weights as one vector: vectors of context symbols (and the start), position weights, vectors and biases of predicted symbols."""

    weights: np.ndarray

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        n = SHORT + CLASSES
        return [(n + 1, WIDTH), (CONTEXT, WIDTH), (n, WIDTH), (n,)]

    def parts(self) -> list[np.ndarray]:
        out, at = [], 0
        for shape in self.shapes():
            size = int(np.prod(shape))
            out.append(self.weights[at : at + size].reshape(shape))
            at += size
        return out

    @staticmethod
    def fresh(noise: np.ndarray, seed: int = 11) -> Model:
        """Small random vectors, position weights of one, and biases at which the model is the unigram one."""
        rng = np.random.default_rng(seed)
        n = SHORT + CLASSES
        parts = [rng.normal(0, 0.1, (n + 1, WIDTH)), np.ones((CONTEXT, WIDTH)), rng.normal(0, 0.1, (n, WIDTH)), np.log(noise)]
        return Model(np.concatenate([p.ravel() for p in parts]).astype(np.float32))


def contexts(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every token the ``CONTEXT`` symbols before it in its text, the nearest first; the start stands before the text."""
    n = len(symbols)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    out = np.full((n, CONTEXT), SHORT + CLASSES, dtype=np.int32)
    for k in range(1, CONTEXT + 1):
        has = place >= k
        out[has, k - 1] = symbols[np.flatnonzero(has) - k]
    return out


def _added(target: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``target[rows] += values``, also where rows repeat; ``target`` is contiguous."""
    width = target[0].size
    places = rows[:, None] * width + np.arange(width)
    np.add.at(target.reshape(-1), places.reshape(-1), values.reshape(-1))


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y``, in blocks of rows where a library has several threads."""
    if os.environ.get("OMP_NUM_THREADS") == "1":
        return x @ y
    rows = max(1, SINGLE // y.size)
    whole = len(x) // rows * rows
    out = np.empty((len(x), y.shape[1]), dtype=x.dtype)
    np.matmul(x[:whole].reshape(-1, rows, x.shape[1]), y, out=out[:whole].reshape(-1, rows, y.shape[1]))
    out[whole:] = x[whole:] @ y
    return out


def inner_product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x.T @ y``, in blocks of rows where a library has several threads."""
    if os.environ.get("OMP_NUM_THREADS") == "1":
        return x.T @ y
    rows = max(1, SINGLE // (x.shape[1] * y.shape[1]))
    whole = len(x) // rows * rows
    blocks = np.matmul(x[:whole].reshape(-1, rows, x.shape[1]).transpose(0, 2, 1), y[:whole].reshape(-1, rows, y.shape[1]))
    return blocks.sum(axis=0) + x[whole:].T @ y[whole:]


def shared_contexts(context: np.ndarray, most: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """An order of the tokens in which groups of at most ``most`` tokens of one context follow each other, and the groups' starts.

    Groups come in random order, and so do the tokens of one context.
    """
    n = len(context)
    packed = np.zeros(n, dtype=np.int64)
    for k in range(CONTEXT):
        packed = packed * (SHORT + CLASSES + 1) + context[:, k]
    order = rng.permutation(n)
    order = order[np.argsort(packed[order], kind="stable")]
    new = np.append(True, np.diff(packed[order]) != 0)
    first = np.flatnonzero(new)
    new |= (np.arange(n) - first[np.cumsum(new) - 1]) % most == 0
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    dealt = rng.permutation(len(first))
    starts = np.cumsum(size[dealt]) - size[dealt]
    return order[np.repeat(first[dealt] - starts, size[dealt]) + np.arange(n)], starts


def train_steps(
    model: Model, symbols: np.ndarray, context: np.ndarray, noise: np.ndarray, rng, rate: float, moments: np.ndarray, size: int = 2048
) -> None:
    """Noise-contrastive steps of about ``size`` tokens each, in random order, in place; ``moments`` are summed squares of gradients.

    Tokens that share a context share its products with all symbols, from which those of the tokens and of the
    noise are taken, weighted by their numbers; no context makes up more than a ``SHARE``th of a step.
    """
    if not len(symbols):
        return
    r, c, q, b = Model(model.weights).parts()
    log_noise = np.log(noise * NOISE).astype(np.float32)
    cumulated = np.cumsum(noise)
    order, starts = shared_contexts(context, max(1, size // SHARE), rng)
    own = context[order[starts]]
    bounds = np.append(starts, len(order))
    # A cell is a symbol behind a group's context; cells that repeat are counted.
    cells = np.repeat(np.arange(len(starts)) * len(q), np.diff(bounds)) + symbols[order]
    cells.sort()
    new = np.flatnonzero(np.diff(cells, prepend=-1))
    times = np.diff(np.append(new, len(cells))).astype(np.float32)
    cells = cells[new]
    cell_bounds = np.searchsorted(cells, np.arange(len(starts) + 1) * len(q))
    # Groups belong to the step in which they start.
    steps = np.append(np.flatnonzero(np.diff(starts // size, prepend=-1)), len(starts))
    grad, squares = Model(np.zeros_like(model.weights)), np.empty_like(model.weights)
    gr, gc, gq, gb = grad.parts()
    for i, j in zip(steps[:-1], steps[1:]):
        ctx, n = own[i:j], np.diff(bounds[i : j + 1]).astype(np.float32)
        at = cells[cell_bounds[i] : cell_bounds[j]] - i * len(q)
        drawn = np.minimum(np.searchsorted(cumulated, rng.random(NOISE)), len(noise) - 1)
        drawn, repeats = np.unique(drawn, return_counts=True)
        vectors = [r.take(ctx[:, k], axis=0) for k in range(CONTEXT)]
        predicted = sum(v * c[k] for k, v in enumerate(vectors))
        scores = product(predicted, q.T)
        scores += b - log_noise
        # The gradient of the log-likelihood of telling tokens from noise, by group and symbol.
        pull = times[cell_bounds[i] : cell_bounds[j]] / (1 + np.exp(np.clip(scores.ravel().take(at), -30, 30)))
        push = n[:, None] * repeats.astype(np.float32) / (1 + np.exp(np.clip(-scores[:, drawn], -30, 30)))
        scores.fill(0)
        scores.reshape(-1)[at] = pull
        scores[:, drawn] -= push
        gq[:] = inner_product(scores, predicted)
        gb[:] = scores.sum(axis=0)
        back = product(scores, q)
        gr[:] = 0
        for k, v in enumerate(vectors):
            _added(gr, ctx[:, k], back * c[k])
            gc[k] = np.einsum("ij,ij->j", back, v)
        step = grad.weights
        step /= np.float32(bounds[j] - bounds[i])
        np.multiply(step, step, out=squares)
        moments += squares
        np.add(moments, np.float32(1e-8), out=squares)
        np.sqrt(squares, out=squares)
        step *= np.float32(rate)
        step /= squares
        model.weights += step


def coded(texts: list[bytes], codes: Codes) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Codes of all tokens of the texts, the start of each text, and the words."""
    words = [words_of(t) for t in texts]
    end = codes[END]
    flat: list[int] = []
    starts = np.zeros(len(texts), dtype=np.int64)
    for i, w in enumerate(words):
        starts[i] = len(flat)
        flat.extend(map(codes.__getitem__, w))
        flat.append(end)
    return np.array(flat, dtype=np.int64), starts, words


@cache
def ending_classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of each last byte of a word of one byte, and of each last two bytes."""
    one = [class_of(bytes([x])) for x in range(256)]
    two = [class_of(bytes([x, y])) for x in range(256) for y in range(256)]
    return np.array(one, dtype=np.int32), np.array(two, dtype=np.int32)


def word_hashes(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``data``, of their first ``LONGEST`` bytes; eight more bytes follow the last word."""
    eights = np.lib.stride_tricks.sliding_window_view(data, 8)
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)

    out = lengths.astype(np.uint64) << np.uint64(57)
    rows = np.arange(len(begins))
    for at in range(0, LONGEST, 8):
        rows = rows[lengths[rows] > at]
        if not len(rows):
            break
        eight = np.ascontiguousarray(eights[begins[rows] + at]).view("<u8").ravel() & masks[np.minimum(lengths[rows] - at, 8)]
        out[rows] = mixed(out[rows] ^ mixed(eight + np.uint64(at)))
    return out


class Symbols:
    """Symbols of whole texts, found for all words at once; the same as by ``coded``."""

    def __init__(self, known: Vocabulary):
        self.short = {k: i for i, k in enumerate(known.keys[:SHORT])}
        plain = [k for k in self.short if 0 < len(k) <= LONGEST]
        lengths = np.array([len(k) for k in plain], dtype=np.int64)
        data = np.frombuffer(b"".join(plain) + bytes(LONGEST + 8), dtype=np.uint8)
        hashes = word_hashes(data, np.cumsum(lengths) - lengths, lengths)
        order = np.argsort(hashes)
        # No word's hash is searched for behind the last place.
        self.hashes = np.append(hashes[order], np.uint64(0))
        self.numbers = np.append(np.array([self.short[k] for k in plain], dtype=np.int32)[order], np.int32(0))

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all tokens of the texts, and the start of each text."""
        joined = b"\n" + b"\n".join(texts).translate(_LOWER) + b"\n" + bytes(LONGEST + 8)
        data = np.frombuffer(joined, dtype=np.uint8)
        text = data[: len(data) - LONGEST - 8]
        blank = (text == 32) | ((text >= 9) & (text <= 13))
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        begins, ends = edges[::2], edges[1::2]
        lengths = ends - begins
        one, two = ending_classes()
        last = data[ends - 1].astype(np.int32)
        symbols = SHORT + np.where(lengths > 1, two[data[ends - 2] * np.int32(256) + last], one[last])
        hashes = word_hashes(data, begins, lengths)
        place = np.searchsorted(self.hashes[:-1], hashes)
        symbols = np.where((self.hashes[place] == hashes) & (place < len(self.hashes) - 1), self.numbers[place], symbols)
        for i in np.flatnonzero(lengths > LONGEST):
            key = words_of(joined[begins[i] : ends[i]])[0]
            symbols[i] = self.short.get(key, SHORT + class_of(key))
        # An end stands behind the words of each text.
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        words = np.diff(np.searchsorted(begins, 1 + np.cumsum(sizes)), prepend=0)
        stops = np.cumsum(words + 1) - 1
        out = np.full(len(begins) + len(texts), self.short[END], dtype=np.int32)
        is_word = np.ones(len(out), dtype=bool)
        is_word[stops] = False
        out[is_word] = symbols
        return out, stops - words


def stretches(texts: list[bytes]) -> Iterator[slice]:
    """Slices of texts of bounded size together; a text is never cut."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > 4 * STRETCH:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def train_round(rows: DataFrame, shared, number: int, size: int) -> np.ndarray | None:
    """The weights after one round over ``rows``, averaged over tasks; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start = shared.value
        finder, tokens, model, moments, rng = None, 0, None, None, None
        for batch in batches:
            if finder is None:
                finder, model = Symbols(known), Model(start.copy())
                moments = np.zeros_like(model.weights)
                rng = np.random.default_rng([number, TaskContext.get().partitionId()])
            texts = batch.column(0).to_pylist()
            for part in stretches(texts):
                symbols, starts = finder.of(texts[part])
                train_steps(model, symbols, contexts(symbols, starts), known.noise, rng, RATE / (1 + number), moments, size)
                tokens += len(symbols)
        if tokens:
            yield pa.record_batch([pa.array([tokens], pa.int64()), pa.array([model.weights.astype(np.float64)], pa.list_(pa.float64()))], names=["tokens", "weights"])

    made = rows.select("text").mapInArrow(run, "tokens bigint, weights array<double>")
    each = made.select("tokens", F.posexplode("weights").alias("place", "w"))
    mean = each.groupBy("place").agg((F.sum(F.col("w") * F.col("tokens")) / F.sum("tokens")).alias("w")).collect()
    if not mean:
        return None
    weights = np.zeros(len(mean), dtype=np.float32)
    weights[[r["place"] for r in mean]] = [r["w"] for r in mean]
    return weights


def train(rows: DataFrame, known: Vocabulary) -> Model:
    """A model of the rows; every row is read in one round."""
    context = rows.sparkSession.sparkContext
    model, low = Model.fresh(known.noise), 0
    for number, (parts, size) in enumerate(ROUNDS):
        shared = context.broadcast((known, model.weights))
        weights = train_round(rows.where(F.col("part").between(low, low + parts - 1)), shared, number, size)
        shared.unpersist()
        model, low = model if weights is None else Model(weights), low + parts
    return model


def fresh_totals() -> np.ndarray:
    """Room for what normalises the symbols after each context; what is not known yet is no number."""
    return np.full((SHORT + CLASSES + 1) ** CONTEXT, np.nan)


def log_probabilities(model: Model, symbols: np.ndarray, context: np.ndarray, totals: np.ndarray | None = None) -> np.ndarray:
    """The natural logarithm of each symbol's normalised probability after its context.

    ``totals`` keeps what was found for a context, for later calls with the same model.
    """
    r, c, q, b = model.parts()
    totals = fresh_totals() if totals is None else totals
    size = SHORT + CLASSES + 1
    scaled = [r * c[k] for k in range(CONTEXT)]
    packed = np.zeros(len(context), dtype=np.int64)
    for k in range(CONTEXT):
        packed = packed * size + context[:, k]
    new = np.unique(packed[np.isnan(totals.take(packed))])
    for i in range(0, len(new), PRODUCT):
        some = new[i : i + PRODUCT]
        scores = product(sum(scaled[k][some // size ** (CONTEXT - 1 - k) % size] for k in range(CONTEXT)), q.T)
        scores += b
        top = scores.max(axis=1)
        scores -= top[:, None]
        totals[some] = np.log(np.exp(scores, out=scores).sum(axis=1, dtype=np.float64)) + top
    out = np.empty(len(symbols))
    for i in range(0, len(symbols), PRODUCT):
        s, own = symbols[i : i + PRODUCT], context[i : i + PRODUCT]
        predicted = sum(scaled[k].take(own[:, k], axis=0) for k in range(CONTEXT))
        out[i : i + PRODUCT] = np.einsum("ij,ij->i", predicted, q.take(s, axis=0)) + b.take(s) - totals.take(packed[i : i + PRODUCT])
    return out


SCORED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<struct<key: binary, n: bigint>>"
)


def score_rows(rows: DataFrame, shared) -> DataFrame:
    """Scores of every row from what tasks know, and its words that they don't know. ``row`` numbers the rows."""
    rare_type = pa.list_(pa.struct([("key", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = shared.value
        codes, model, totals, at = Codes(known), Model(weights), fresh_totals(), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(2).to_pylist()
            columns: list[list] = [[], [], [], [], []]
            for part in stretches(texts):
                flat, starts, words = coded(texts[part], codes)
                symbols = known.symbol[flat]
                logs = log_probabilities(model, symbols, contexts(symbols, starts), totals) / np.log(10) + known.within[flat]
                columns[0].extend(np.diff(np.append(starts, len(flat))).tolist())
                for column, values in zip(columns[1:4], (known.seen[flat], known.base[flat], logs)):
                    column.extend(np.add.reduceat(values, starts).tolist())
                rare = flat >= codes.known
                any_rare = np.logical_or.reduceat(rare, starts)
                for i, w in enumerate(words):
                    found = Counter([w[k] for k in np.flatnonzero(rare[starts[i] : starts[i] + len(w)])]) if any_rare[i] else {}
                    columns[4].append([{"key": k, "n": n} for k, n in found.items()])
            numbers = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), rare_type)
            made = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.record_batch([numbers, batch.column(0), batch.column(1), *made], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, SCORED)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    spark = docs.sparkSession
    with Scratch(spark, "lm") as scratch:
        rows = _documents(docs)
        learning = rows.where("NOT held_out")
        counts = scratch.write(token_counts(learning), "counts")
        known = vocabulary(counts)
        model = train(learning, known)
        shared = spark.sparkContext.broadcast((known, model.weights))
        scored = scratch.write(score_rows(rows, shared), "scored")
        shared.unpersist()

        rare = scored.select("row", F.inline("rare")).withColumnRenamed("n", "times")
        each = [x for c in range(CLASSES) for x in (F.lit(c), F.lit(float(known.class_total[c] + known.class_words[c] + 1)))]
        looked = rare.join(counts, "key", "left").select(
            "row", "times", F.coalesce("n", F.lit(0)).alias("c"), F.create_map(*each)[class_column("key")].alias("size")
        )
        added = looked.groupBy("row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(known.denominator)))).alias("more_base"),
            F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.col("size"))).alias("more_score"),
        )
        zero = F.lit(0.0)
        out = scored.drop("rare").join(added, "row", "left").select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
        )
        return scratch.write(out, "rows", keep=True)
