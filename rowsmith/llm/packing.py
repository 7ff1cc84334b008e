"""Packing documents into fixed-length training sequences by shortest-pack-first over lengths.

Every document is tokenised once and cut into pieces of at most ``capacity`` tokens. What is packed is
not the pieces but the histogram of their lengths, at most ``capacity`` numbers: lengths are placed
longest first, each into the open packing pattern that is filled least, and a pattern carries how
many sequences follow it. The result is a small table saying which ranks of which length go where.
Pieces get a rank among those of their length and look their place up, so no task ever holds all
pieces of a length or a sequence builder's state.

Defined cases: a null or empty text is one piece that holds only the end token. Rows that repeat an
id are packed like any other. An empty table gives no sequence. Further columns are not read.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.llm.bpe import WORDS, Vocabulary, encoder
from rowsmith.llm.common import map_batches, whole_text
from rowsmith.session import Scratch

PIECES = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint"
PLACES = "length int, first_rank bigint, n bigint, first_sequence bigint, offset bigint"
# Rows of the placement table that are broadcast; a larger one, which needs patterns of very many tiny pieces, is shuffled.
PLACES_BOUND = 300_000
# Pieces of one length are ranked in this many groups, and in more so that a group's share stays below RANKED.
RANK_GROUPS, RANKED = 64, 1_000_000


# A word or a run of white space longer than this is encoded by the trie encoder, whose time is linear in it.
LONG_RUN = 1024


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tiktoken.Encoding:
    vocabulary = Vocabulary(path)
    return tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=vocabulary.ids, special_tokens=vocabulary.added)


def token_bytes(text: str, path: str) -> bytes:
    """Token ids of a text as little-endian unsigned 32-bit integers."""
    words = text.split()
    inside = sum(map(len, words))
    if max(map(len, words), default=0) > LONG_RUN or len(text) - inside - len(words) > LONG_RUN:
        return encoder(path).encode_bytes([text])[0]
    tokens = array("I", _tokenizer(path).encode(text, allowed_special="all"))
    if sys.byteorder == "big":
        tokens.byteswap()
    return tokens.tobytes()


def cut(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every document, with checksums of their token ids."""

    def make():
        end = end_id.to_bytes(4, "little")
        step = 4 * capacity

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, starts, lengths, sums, totals = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                code = token_bytes(text, path) + end
                for at in range(0, len(code), step):
                    piece = code[at : at + step]
                    ids.append(doc)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(code) // 4)
            columns = [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(sums, pa.int64())]
            return pa.record_batch([*columns, pa.array(totals, pa.int64())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")), make, PIECES)


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns with how many sequences follow each; together they use up the histogram.

    Lengths go in descending order. A length joins the open patterns with the most space left; of
    a pattern that more sequences follow than there are pieces left, only that many are taken.
    """
    space: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], capacity - 1
        while left and room >= length:
            if not space[room]:
                room -= 1
                continue
            pattern, n = space[room].pop()
            used = min(n, left)
            if used < n:
                space[room].append((pattern, n - used))
            left -= used
            # Less space than before: met again further down if the length still fits.
            space[room - length].append(((*pattern, length), used))
        # No open pattern takes the length: new ones, each filled with it before the next is opened.
        fits = capacity // length
        for copies, n in ((fits, left // fits), (left % fits, 1)):
            if copies and n:
                space[capacity - copies * length].append(((length,) * copies, n))
    return [(pattern, n) for r in sorted(space) for pattern, n in space[r]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of each length go to which sequences, at which offset."""
    rows, rank, sequence = [], defaultdict(int), 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, rank[length], n, sequence, offset))
            rank[length] += n
            offset += length
        sequence += n
    return rows


def ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """Pieces with ``rank``, gapless from 0 within each length, without one task per length."""
    slot = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).alias("part")
    parts = pieces.select("*", slot)
    sizes = parts.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")) - 1
    return parts.withColumn("within", within).join(sizes, ["length", "part"]).withColumn("rank", F.col("before") + F.col("within"))


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece."""
    spark = docs.sparkSession
    with Scratch(spark, "pack") as scratch:
        pieces = scratch.write(cut(docs, path, capacity, end_id), "pieces", keep=True)
        histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
        rows = places(pack_histogram(histogram, capacity))
        table = spark.createDataFrame(rows, PLACES)
        if len(rows) <= PLACES_BOUND:
            table = F.broadcast(table)
        order = ranked(pieces, max(RANK_GROUPS, sum(histogram.values()) // RANKED))
        there = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
        return (
            order.join(table, "length")
            .where(there)
            .select(
                "doc_id", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "doc_tokens",
                (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset",
            )
        )
