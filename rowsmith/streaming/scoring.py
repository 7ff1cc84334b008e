"""Score, quarantine and log rows as they arrive.

Each micro-batch is handled as an ordinary table in ``foreachBatch``, so every fitted pipeline
works, and is written to a folder named after its batch id in overwrite mode: a batch that is
repeated after a failure replaces its own output instead of adding to it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowsmith.operators.clean import (
    VIOLATION,
    canonicalise,
    check_scoring_input,
    quote,
    rejected_rows,
    valid_rows,
    write_by_verdict,
)
from rowsmith.plans.score import RESULTS, predict
from rowsmith.spec import TableSpec


CORRUPT = "_corrupt_record"
# Log lines repeat the names of all inputs; Spark and common tools read the files as they are.
LOG_COMPRESSION = "gzip"


def read_table_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """New Parquet files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_json_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """New files of JSON request lines as a stream; the text of unreadable lines is kept in ``_corrupt_record``."""
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if CORRUPT not in schema.names else schema
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def checked_requests(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Flagged rows; a line that could not be read is rejected with its text, by the rule ``json``."""
    checked = check_scoring_input(batch, spec)
    if CORRUPT not in batch.columns:
        return checked
    unreadable = F.array(F.struct(F.lit(CORRUPT).alias("field"), F.lit("json").alias("rule"), F.col(CORRUPT).alias("value"))).cast(VIOLATION)
    return checked.withColumn("violations", F.when(F.col(CORRUPT).isNull(), F.col("violations")).otherwise(unreadable))


def _start(stream: DataFrame, handle, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def score_stream(
    stream: DataFrame, model: PipelineModel, spec: TableSpec, target: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Scored rows below ``target/scored``, refused rows with reasons below ``target/rejected``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = checked_requests(batch, spec).persist()
        try:
            part = f"batch_id={batch_id}"
            predict(valid_rows(checked).drop(CORRUPT), model).write.mode("overwrite").parquet(f"{target}/scored/{part}")
            rejected_rows(checked).write.mode("overwrite").parquet(f"{target}/rejected/{part}")
        finally:
            checked.unpersist()

    return _start(stream, handle, checkpoint, once)


def quarantine_stream(
    stream: DataFrame, spec: TableSpec, target: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Clean arriving rows; good and bad ones go to ``verdict=...`` folders in one pass."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_by_verdict(canonicalise(batch, spec), f"{target}/batch_id={batch_id}", mode="overwrite")

    return _start(stream, handle, checkpoint, once)


def prediction_log_rows(scored: DataFrame) -> DataFrame:
    """Log lines: time, the input as one struct, prediction and confidence."""
    inputs = F.struct(*[quote(c) for c in scored.columns if c not in RESULTS])
    return scored.select(F.current_timestamp().alias("timestamp"), inputs.alias("input"), "prediction", "confidence")


def log_predictions(scored: DataFrame, target: str) -> None:
    """Append a batch of scored rows to the JSON log."""
    prediction_log_rows(scored).write.mode("append").json(target, compression=LOG_COMPRESSION)


def prediction_log_stream(
    stream: DataFrame, model: PipelineModel, spec: TableSpec, target: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Score accepted rows as they arrive and write their log lines as JSON."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        scored = predict(valid_rows(checked_requests(batch, spec)).drop(CORRUPT), model)
        prediction_log_rows(scored).write.mode("overwrite").json(f"{target}/batch_id={batch_id}", compression=LOG_COMPRESSION)

    return _start(stream, handle, checkpoint, once)
