"""Structured Streaming over the event and document tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.operators.clean import rejected_rows
from rowsmith.plans.train import fit_pipeline
from rowsmith.queries.base import derive, plain, query, r6, table
from rowsmith.queries.training import EXPECTED, RULE_TREE, SIZED_SPEC, sized_table
from rowsmith.session import scratch_path
from rowsmith.spec import CategoryField, NumericField, TableSpec
from rowsmith.streaming.scoring import (
    checked_requests,
    prediction_log_stream,
    quarantine_stream,
    read_json_stream,
    read_table_stream,
    score_stream,
)

EVENT_SPEC = TableSpec(
    key=("event_id",),
    numeric=(NumericField("value", low=1, high=150), NumericField("k", "int", low=0, high=90)),
    categorical=(CategoryField("event_type", ("click", "view", "purchase", "signup"), null_tokens=("view",)),),
)


@query(
    "stream_quarantine",
    """WITH e AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
        CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS event_type FROM events)
    SELECT event_id, value, k, event_type, concat_ws(',',
        CASE WHEN value NOT BETWEEN 1 AND 150 THEN 'value:range' END,
        CASE WHEN k NOT BETWEEN 0 AND 90 THEN 'k:range' END,
        CASE WHEN event_type = 'error' THEN 'event_type:vocabulary' END) AS reasons,
      CASE WHEN value BETWEEN 1 AND 150 AND (k IS NULL OR k BETWEEN 0 AND 90) AND event_type IS DISTINCT FROM 'error'
        THEN 'valid' ELSE 'rejected' END AS verdict FROM e""",
)
def stream_quarantine(spark, sf):
    root = scratch_path(spark, "quarantine")
    schema = table(spark, sf, "events").schema
    # The pattern also fits a table that is a single file, which a stream source cannot name.
    stream = read_table_stream(spark, f"{sf}/events.parquet*", schema)
    stream = stream.withColumn("k", F.get_json_object("props", "$.k"))
    quarantine_stream(stream, EVENT_SPEC, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    reason = F.transform("violations", lambda v: F.concat_ws(":", v["field"], v["rule"]))
    return spark.read.parquet(f"{root}/out").select(
        "event_id", "value", "k", "event_type", F.concat_ws(",", reason).alias("reasons"), "verdict"
    )


ACCEPTED = EXPECTED + " WHERE l_quantity BETWEEN 1 AND 45"


def _request_stream(spark, sf, root):
    """The line items as JSON request files, read back as a stream of several batches."""
    rows = sized_table(spark, sf).drop("size_class")
    rows.write.option("maxRecordsPerFile", 1_000_000).json(f"{root}/requests", compression="gzip")
    return read_json_stream(spark, f"{root}/requests", rows.schema, max_files=2)


@query("stream_score", ACCEPTED)
def stream_score(spark, sf):
    root = scratch_path(spark, "stream")
    model = fit_pipeline(sized_table(spark, sf), SIZED_SPEC, RULE_TREE)
    stream = _request_stream(spark, sf, root)
    score_stream(stream, model, SIZED_SPEC, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out/scored").select(
        "l_orderkey", "l_linenumber", "prediction", r6("confidence").alias("confidence")
    )


@query("stream_prediction_log", ACCEPTED)
def stream_prediction_log(spark, sf):
    root = scratch_path(spark, "log")
    model = fit_pipeline(sized_table(spark, sf), SIZED_SPEC, RULE_TREE)
    stream = _request_stream(spark, sf, root)
    prediction_log_stream(stream, model, SIZED_SPEC, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    schema = (
        "timestamp timestamp, input struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>, "
        "prediction string, confidence double"
    )
    lines = spark.read.schema(schema).json(f"{root}/out")
    return lines.select("input.l_orderkey", "input.l_linenumber", "prediction", r6("confidence").alias("confidence"))


# Event requests as JSON lines of which some are cut off; chr(123) and chr(125) are the braces.
REQUEST_LINES = """
SELECT event_id, event_type, chr(123) || '"event_id": ' || CAST(event_id AS STRING) ||
  CASE WHEN event_id % 13 = 0 THEN '' ELSE ', "event_type": "' || event_type || '"' || chr(125) END AS line
FROM {events}
"""


@query(
    "stream_bad_json",
    f"""WITH l AS ({plain(REQUEST_LINES)})
    SELECT CASE WHEN event_id % 13 = 0 THEN '_corrupt_record:json' ELSE 'event_type:vocabulary' END AS reason,
      count(*) AS n, max(CASE WHEN event_id % 13 = 0 THEN line END) AS text
    FROM l WHERE event_id % 13 = 0 OR event_type = 'error' GROUP BY 1""",
)
def stream_bad_json(spark, sf):
    """Unreadable request lines keep their text among the rejected rows."""
    root = scratch_path(spark, "lines")
    lines = derive(spark, sf, REQUEST_LINES, "events")
    lines.select("line").write.mode("overwrite").text(f"{root}/requests")
    spec = TableSpec(key=("event_id",), categorical=(CategoryField("event_type", ("click", "view", "purchase", "signup")),))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    stream = read_json_stream(spark, f"{root}/requests", schema, max_files=4)

    def handle(batch, batch_id):
        rejected_rows(checked_requests(batch, spec)).write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{root}/out").select(F.inline("violations"))
    reason = F.concat_ws(":", "field", "rule").alias("reason")
    return rows.groupBy(reason).agg(F.count("*").alias("n"), F.max(F.when(F.col("rule") == "json", F.col("value"))).alias("text"))
