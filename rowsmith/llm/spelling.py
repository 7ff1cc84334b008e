"""Spelling variants by neighbourhoods over a reduced alphabet.

Words are counted over whole texts. Each word is written in a reduced alphabet of ``SYMBOLS`` symbols, and
the full one-edit neighbourhood of every distinct reduced word is generated: itself, every deletion, every
replacement and every insertion. Reduced words are joined with those neighbourhoods, because one edit of a
word is one edit, or none, of its reduced form; so no near pair is missed. Pairs of words under
matching reduced forms are verified by their edit distance on the original strings.

Neighbours travel as 64-bit polynomial hashes, which take one subtraction and one addition each, however
long the word is. A collision only adds a candidate that verification refuses. The neighbourhood grows
with the number of symbols and the number of candidates shrinks with it; neither is capped.

Defined cases: a null text has no words; a null ``doc_id`` is written as nothing before the colon. Rows that
repeat an id or a text all count. A word of any length takes part with its whole neighbourhood. An empty
table, or one without words that are frequent enough, gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.common import whole_text
from rowsmith.session import Scratch

# Symbols of the reduced alphabet.
SYMBOLS = 5
# Every so many distinct (document, word) pairs lose a letter; words of at least so many letters and occurrences stay.
DELETE, LETTERS, OCCURRENCES = 97, 5, 3
# Distinct words that a task counts before it hands them on.
COUNTED = 500_000
# Neighbours that a task hands on at a time.
ROWS = 1_000_000

# Latin-1 bytes: letters stay, A-Z become lower case, everything else parts words.
_LETTER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def symbol_table(symbols: int) -> np.ndarray:
    """The symbol, from 1, of each letter; letters are spread by a multiplicative hash."""
    return ((np.arange(256, dtype=np.uint64) * np.uint64(2654435761) >> np.uint64(11)) % np.uint64(symbols) + np.uint64(1)).astype(np.uint64)


def runs_of(text: str) -> list[bytes]:
    """The lower-cased runs of letters of a text, one Latin-1 byte for each code point."""
    return text.encode("latin-1", "replace").translate(_LETTER).split()


def word_of(run: bytes, prefix: int) -> bytes:
    """The run, or the run without one letter where its hash, which goes on from ``prefix``, is divisible by DELETE."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), prefix)
    if h % DELETE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """``word, n`` of every word with enough letters and occurrences over all documents."""

    def table(totals: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in totals], pa.string())
        return pa.record_batch([words, pa.array(list(totals.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix = zlib.crc32(b":" if i is None else f"{i}:".encode())
                for found, n in Counter(runs_of(text)).items():
                    word = word_of(found, prefix)
                    if len(word) >= letters:
                        totals[word] += n
                if len(totals) > COUNTED:
                    yield table(totals)
                    totals.clear()
        yield table(totals)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= occurrences)


def reduced_hash(symbols: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of a reduced word, the empty one first, modulo 2**64."""
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    power = powers(len(symbols))
    np.cumsum(symbols * power, out=out[1:])
    return out


_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(max(n, 64) - 1, _BASE)]))
    return _POWERS[:n]


def neighbourhood(symbols: np.ndarray, count: int) -> np.ndarray:
    """The hashes of a reduced word and of all reduced words one edit away, each once."""
    n = len(symbols)
    power = powers(n + 1)
    before = reduced_hash(symbols)
    whole = before[n]
    after = whole - before  # of the suffix from each place, where it stands
    every = np.arange(1, count + 1, dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    deleted = before[:n] + after[1:] * inverse
    replaced = (before[:n] + after[1:])[:, None] + every[None, :] * power[:n, None]
    inserted = (before + after * _BASE)[:, None] + every[None, :] * power[:, None]
    return np.unique(np.concatenate([np.array([whole]), deleted, replaced.ravel(), inserted.ravel()]))


def reduced(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with the column ``cell``, the hash of the reduced word."""
    schema = words.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    at = words.columns.index("word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table(symbols)
        for batch in batches:
            texts = [w.encode("latin-1") for w in batch.column(at).to_pylist()]
            cells = np.array([reduced_hash(table[np.frombuffer(t, dtype=np.uint8)])[-1] for t in texts], dtype=np.uint64)
            yield pa.record_batch([*batch.columns, pa.array(cells.view(np.int64))], names=[*batch.schema.names, "cell"])

    return words.mapInArrow(run, schema.replace(",", ", ") + ", cell bigint")


def neighbour_table(cells: DataFrame, symbols: int) -> DataFrame:
    """``cell, near``: the neighbourhood of each distinct cell, by a word that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table(symbols)

        def batch_of(ids: list, near: list) -> pa.RecordBatch:
            own = np.repeat(np.array(ids, dtype=np.int64), [len(x) for x in near])
            return pa.record_batch([pa.array(own), pa.array(np.concatenate(near).view(np.int64))], names=["cell", "near"])

        ids, near, held = [], [], 0
        for batch in batches:
            for cell, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(cell)
                near.append(neighbourhood(table[np.frombuffer(word.encode("latin-1"), dtype=np.uint8)], symbols))
                held += len(near[-1])
                if held >= ROWS:
                    yield batch_of(ids, near)
                    ids, near, held = [], [], 0
        if ids:
            yield batch_of(ids, near)

    return cells.select("cell", "word").mapInArrow(run, "cell bigint, near bigint")


def near_pairs(words: DataFrame, scratch: Scratch, symbols: int = SYMBOLS) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words that differ by exactly one code point inserted, deleted or replaced, in both orders.

    ``words`` has ``word, n``, each word once.
    """
    keyed = scratch.write(reduced(words, symbols), "reduced")
    cells = scratch.write(keyed.groupBy("cell").agg(F.min("word").alias("word")), "cells")
    present = cells.select(F.col("cell").alias("near"))
    # Both directions are generated; each pair of cells is verified once.
    met = scratch.write(neighbour_table(cells, symbols).join(present, "near").where("cell <= near"), "met")
    left = keyed.select("cell", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = keyed.select(F.col("cell").alias("near"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = met.join(left, "cell").join(right, "near").where("cell != near OR a < b")
    # The distance is looked at only where lengths allow it.
    close = F.abs(F.length("a") - F.length("b")) <= 1
    pairs = pairs.where(close & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")
    pairs = scratch.write(pairs, "pairs")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root``: where the pointers ``word, form`` end. Every round doubles the way that is known.

    Counts at least double along a pointer, so the ways are short and have no circles.
    """
    ways = scratch.write(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = ways.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = scratch.write(step, "ways")
        ways = step.select("word", "root")
        if step.where("moved").isEmpty():
            return ways


def group_variants(docs: DataFrame, symbols: int = SYMBOLS, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents.

    ``form`` is the near word of the largest count, the smallest on ties, if that count is at least twice the word's.
    """
    with Scratch(docs.sparkSession, "spelling") as scratch:
        words = scratch.write(word_counts(docs, letters, occurrences), "words")
        pairs = near_pairs(words, scratch, symbols)
        best = pairs.groupBy(F.col("a").alias("word")).agg(
            F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best")
        )
        known = words.join(best, "word", "left")
        leads = -F.col("best.less") >= 2 * F.col("n")
        known = known.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(leads, F.col("best.form")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n"),
        )
        known = scratch.write(known, "known")
        roots = follow(known.where("form IS NOT NULL"), scratch)
        out = known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return scratch.write(out, "rows", keep=True)
