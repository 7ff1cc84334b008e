"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. The caller writes it as Parquet
and reads it back as the next stage's ``docs``. All stages but the last return the columns of
``docs``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowsmith.llm import exact_dedup, minhash, packing, quality, secrets
from rowsmith.llm.queries import vocabulary_path
from rowsmith.session import Scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts; it learns from the ``labels`` of those among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose shingles of five words are linked by a similarity of 0.8."""
    return minhash.drop_near_copies(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced in their texts."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2,048 tokens."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# Learned models, signatures and tokens are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = len(STAGES) - 1
    with Scratch(spark, "pipeline") as scratch:
        for i, (name, stage) in enumerate(STAGES):
            docs = scratch.write(stage(spark, docs, sf_dir), name, keep=i == last)
    return docs
