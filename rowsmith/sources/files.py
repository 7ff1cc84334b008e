"""CSV and JSON files as whole-table sources and sinks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.expressions import NA_TEXTS
from rowsmith.operators.clean import quote


def read_csv(spark: SparkSession, path: str, na_texts: tuple[str, ...] = NA_TEXTS, multi_line: bool = False) -> DataFrame:
    """A CSV table with a header, all columns as text and the usual "missing" texts as NULL.

    No inference pass over the data: types come from the table specification when the rows
    are cleaned. Blanks around a value belong to it. With ``multi_line`` a quoted value may hold line
    breaks, and a file is then read by one task. A missing path raises an ``AnalysisException``.
    """
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
    return df.select(
        *[F.when(~F.col(quote(c)).isin(*na_texts), F.col(quote(c))).alias(c) for c in df.columns]
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", multi_line: bool = False) -> None:
    """Write a folder of CSV parts with headers, one per task; parents are created.

    A line break inside a value fails the job unless ``multi_line`` says that readers expect it.
    """
    if not multi_line:
        stop = F.raise_error(F.lit("a value holds a line break; write and read with multi_line=True"))
        texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
        cells = [
            F.when(F.col(quote(c)).rlike(r"[\r\n]"), stop.cast("string")).otherwise(F.col(quote(c))).alias(c) if c in texts else F.col(quote(c))
            for c in df.columns
        ]
        df = df.select(*cells)
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_document(spark: SparkSession, document: dict, path: str, mode: str = "overwrite") -> None:
    """Write one result document (training or tuning results) as a JSON line."""
    line = json.dumps(document, default=str)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode(mode).text(path)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a given schema; unreadable lines are kept apart in ``_corrupt_record``."""
    full = f"{schema}, _corrupt_record string"
    return spark.read.schema(full).option("mode", "PERMISSIVE").json(path)
