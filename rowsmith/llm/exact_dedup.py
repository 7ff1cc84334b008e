"""Exact deduplication with a split between heavy and ordinary digests.

Texts are equal when they are identical after each run of ASCII white space became one space. A
digest held by a large share of all rows would make one shuffle partition as large as its group.
Such digests are found by a Misra-Gries type sketch and counted exactly; the winner of each, at
most a thousand, is broadcast and removes its copies where they are read. Only the other digests,
whose groups are small against the table, go through an ordinary shuffle. Everything is DataFrame
expressions.

Defined cases: a null text counts as empty, and all empty texts are one group. Of a group the
smallest ``doc_id`` stays; null ids lose against any other, and a group of null ids only keeps one
of them (``keep_id`` is null). Rows that repeat an id and its text are one document for
``annotate_copies`` (all marked kept, each counted in ``group_size``) and become one row in
``drop_copies``. Further columns pass through ``drop_copies`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsmith.llm.common import fresh, heavy_hitters, whole_text
from rowsmith.session import Scratch


def text_digest(column: str = "text") -> Column:
    """SHA-256 in hex of the text with every run of white space as one space."""
    return F.sha2(F.regexp_replace(whole_text(column), r"[\x20\x09-\x0D]+", " "), 256)


def heavy_winners(digests: DataFrame, share: float) -> DataFrame:
    """``digest, keep_id, group_size`` of the digests above ``share``; at most ``1 / share`` rows, for broadcasting."""
    spark = digests.sparkSession
    heavy = heavy_hitters(digests, "digest", share)
    if not heavy:
        return spark.createDataFrame([], "digest string, keep_id bigint, group_size bigint")
    names = F.broadcast(spark.createDataFrame([(k,) for k, _ in heavy], "digest string"))
    best = digests.join(names, "digest").groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return spark.createDataFrame(best.collect(), "digest string, keep_id bigint, group_size bigint")


def digest_table(docs: DataFrame, scratch: Scratch, keep: bool) -> DataFrame:
    return scratch.write(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_digest().alias("digest")), "digests", keep)


def annotate_copies(docs: DataFrame, share: float = 0.001) -> DataFrame:
    """Every row's ``doc_id, digest, keep_id, group_size, kept``."""
    with Scratch(docs.sparkSession, "exact") as scratch:
        digests = digest_table(docs, scratch, keep=True)
        winners = F.broadcast(heavy_winners(digests, share))
        hot = digests.join(winners, "digest")
        group = W.partitionBy("digest")
        rest = digests.join(winners, "digest", "left_anti").select(
            "digest", "doc_id", F.min("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"),
            F.row_number().over(group.orderBy(F.col("doc_id").asc_nulls_last())).alias("nth"),
        )
        both = hot.withColumn("nth", F.lit(1)).unionByName(rest)
        kept = F.when(F.col("keep_id").isNull(), F.col("nth") == 1).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        return both.select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def drop_copies(docs: DataFrame, share: float = 0.001) -> DataFrame:
    """One row of every group of equal texts, with all columns of ``docs``."""
    digest, keep, nth = (fresh(docs.columns, c) for c in ("digest", "keep_id", "nth"))
    with Scratch(docs.sparkSession, "exact") as scratch:
        winners = heavy_winners(digest_table(docs, scratch, keep=False), share)
    winners = F.broadcast(winners.select(F.col("digest").alias(digest), F.col("keep_id").alias(keep)))
    # Copies of a heavy digest go where they are read; what is left has small groups.
    left = docs.withColumn(digest, text_digest()).join(winners, digest, "left").where(F.col(keep).isNull() | (F.col("doc_id") == F.col(keep)))
    order = W.partitionBy(digest).orderBy(F.col("doc_id").asc_nulls_last())
    return left.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*docs.columns)
