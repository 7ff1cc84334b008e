"""Registry and metric tables, with one registry event and one metric entry per part."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rowsmith.operators import ranking as R
from rowsmith.queries.base import derive, plain, query, r6
from rowsmith.session import scratch_path
from rowsmith.sources.log import AppendLog
from rowsmith.sources.metrics import MetricsStore, read_metric_documents

EVENTS = """
SELECT lower(p_brand) AS model_id, 'e' || lpad(CAST(p_partkey AS STRING), 9, '0') AS event_id,
  CASE WHEN p_partkey % 11 = 0 THEN 'delete' ELSE 'save' END AS event,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + CAST(floor((p_partkey % 5000) / 3) AS INT) * INTERVAL '1' MINUTE AS created,
  p_type AS model_type, CAST(p_partkey * 7001 + p_size AS BIGINT) AS file_size,
  p_name AS step
FROM {part}
"""

VALUES = """
SELECT lower(p_brand) AS model_id, 'm' || lpad(CAST(p_partkey AS STRING), 9, '0') AS entry_id,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + CAST(floor((p_partkey % 5000) / 3) AS INT) * INTERVAL '1' MINUTE AS timestamp,
  CASE WHEN p_partkey % 5 = 0 THEN 'tuned' ELSE '' END AS suffix,
  CAST(p_partkey * 7919 % 1000 AS DOUBLE) / 1000 AS accuracy,
  CAST(p_partkey * 104729 % 1000 AS DOUBLE) / 1000 AS f1,
  CAST(p_size AS DOUBLE) / 50 AS prec
FROM {part}
"""

NEWEST = f"""WITH events AS ({plain(EVENTS)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY created DESC, event_id DESC) AS r FROM events),
cur AS (SELECT * FROM ranked WHERE r = 1 AND event = 'save'),
vals AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY timestamp DESC, entry_id DESC) AS r
  FROM ({plain(VALUES)})),
latest AS (SELECT * FROM vals WHERE r = 1)"""


def _events(spark, sf):
    rows = derive(spark, sf, EVENTS, "part")
    return rows.withColumn("pipeline_steps", F.array(F.lit("preprocessor"), F.col("step"))).withColumn(
        "classes", F.array(F.upper("model_type"))
    )


def _metrics(spark, sf):
    """Metric rows in long form; one entry per part."""
    cell = lambda name, c: F.struct(F.lit(name).alias("metric"), F.col(c).alias("value"))
    return derive(spark, sf, VALUES, "part").select(
        "model_id",
        "timestamp",
        "suffix",
        F.lit("test").alias("split"),
        F.lit("overall").alias("scope"),
        F.lit(None).cast("string").alias("class"),
        "entry_id",
        F.inline(F.array(cell("accuracy", "accuracy"), cell("f1_score", "f1"), cell("precision", "prec"))),
    )


@query(
    "reg_current",
    f"{NEWEST} SELECT model_id, event_id, CAST(created AS VARCHAR) AS created, model_type, file_size FROM cur",
)
def reg_current(spark, sf):
    return R.current_models(_events(spark, sf)).select(
        "model_id", "event_id", F.col("created").cast("string").alias("created"), "model_type", "file_size"
    )


@query(
    "reg_compacted",
    f"{NEWEST} SELECT model_id, event_id, CAST(created AS VARCHAR) AS created, model_type, file_size FROM cur",
)
def reg_compacted(spark, sf):
    """The current models of a log whose first writes lie in a snapshot and whose last ones do not."""
    rows = _events(spark, sf)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", write_id string"
    log = AppendLog(spark, scratch_path(spark, "events"), schema, "write_id")
    for part in range(4):
        log.append(rows.filter(F.pmod(F.crc32("event_id"), F.lit(4)) == part))
        if part == 1:
            log.compact(timedelta(0))
    log.compact()
    log.append(rows.filter("event_id IS NULL"))
    return R.current_models(log.rows()).select(
        "model_id", "event_id", F.col("created").cast("string").alias("created"), "model_type", "file_size"
    )


@query("reg_list", f"{NEWEST} SELECT model_id FROM cur")
def reg_list(spark, sf):
    return R.current_models(_events(spark, sf)).select("model_id").orderBy("model_id")


@query(
    "reg_info",
    f"""{NEWEST}, wanted AS (SELECT DISTINCT lower(p_brand) AS model_id FROM part
      UNION SELECT DISTINCT 'old-' || lower(p_brand) FROM part)
    SELECT model_id, model_type, file_size, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1_score
      FROM wanted JOIN cur USING (model_id) LEFT JOIN latest USING (model_id)""",
)
def reg_info(spark, sf):
    # Asked for: every brand, and as many ids that were never saved.
    asked = "SELECT DISTINCT explode(array(lower(p_brand), 'old-' || lower(p_brand))) AS model_id FROM {part}"
    current = R.current_models(_events(spark, sf))
    found = R.known(current, derive(spark, sf, asked, "part"))
    return (
        current.join(found, "model_id", "left_semi")
        .join(R.compare_models(_metrics(spark, sf)), "model_id", "left")
        .select("model_id", "model_type", "file_size", r6("accuracy").alias("accuracy"), r6("f1_score").alias("f1_score"))
    )


@query(
    "reg_summary",
    f"""{NEWEST} SELECT model_id, model_type, CAST(created AS VARCHAR) AS created,
        round(file_size / 1048576.0::DOUBLE, 2) AS file_size_mb, upper(model_type) AS classes,
        'preprocessor, ' || step AS pipeline_steps FROM cur""",
)
def reg_summary(spark, sf):
    rows = R.models_summary(R.current_models(_events(spark, sf)))
    return rows.withColumns(
        {"created": F.col("created").cast("string"), "classes": F.concat_ws(",", "classes")}
    )


@query("reg_latest", f"{NEWEST} SELECT arg_max(model_id, (created, model_id)) AS model_id FROM cur")
def reg_latest(spark, sf):
    return R.latest_model(R.current_models(_events(spark, sf)))


@query(
    "reg_keep_latest",
    f"{NEWEST} SELECT model_id, row_number() OVER (ORDER BY created DESC, model_id DESC) <= 10 AS kept FROM cur",
)
def reg_keep_latest(spark, sf):
    current = R.current_models(_events(spark, sf))
    kept = R.keep_latest(current, 10).select("model_id", F.lit(True).alias("kept"))
    return kept.unionByName(R.outdated(current, 10).select("model_id", F.lit(False).alias("kept")))


@query(
    "reg_after_delete",
    f"""{NEWEST} SELECT model_id, count(*) AS metric_rows FROM vals SEMI JOIN cur USING (model_id) GROUP BY model_id""",
)
def reg_after_delete(spark, sf):
    kept = R.metrics_of_known(_metrics(spark, sf), R.current_models(_events(spark, sf)))
    return kept.groupBy("model_id").agg(F.count_distinct("entry_id").alias("metric_rows"))


@query(
    "reg_compare",
    f"""{NEWEST} SELECT model_id, CAST(timestamp AS VARCHAR) AS timestamp, round(accuracy, 6) AS accuracy,
        round(prec, 6) AS precision, round(f1, 6) AS f1_score FROM latest""",
)
def reg_compare(spark, sf):
    rows = R.compare_models(_metrics(spark, sf))
    return rows.select(
        "model_id",
        F.col("timestamp").cast("string").alias("timestamp"),
        *[r6(c).alias(c) for c in ("accuracy", "precision", "f1_score")],
    )


@query(
    "reg_best_model",
    f"""{NEWEST} SELECT model_id, round(f1, 6) AS score FROM latest ORDER BY f1 DESC, model_id LIMIT 1""",
)
def reg_best_model(spark, sf):
    return R.best_model(R.compare_models(_metrics(spark, sf))).withColumn("score", r6("score"))


@query("reg_list_metrics", f"{NEWEST} SELECT DISTINCT model_id, suffix FROM vals")
def reg_list_metrics(spark, sf):
    return R.entries(_metrics(spark, sf))


@query(
    "reg_metrics_roundtrip",
    f"""{NEWEST}, newest AS (SELECT *, row_number() OVER (PARTITION BY model_id, suffix
      ORDER BY timestamp DESC, entry_id DESC) AS q FROM vals)
    SELECT model_id, suffix, unnest(['accuracy', 'f1_score', 'precision']) AS metric,
      round(unnest([accuracy, f1, prec]), 6) AS value FROM newest WHERE q = 1""",
)
def reg_metrics_roundtrip(spark, sf):
    store = MetricsStore(spark, scratch_path(spark, "metrics"))
    # One append holds all entries here; the entry column comes from the rows, not the folder.
    _metrics(spark, sf).write.parquet(f"{store.path}/entries")
    return R.latest_entry_values(store.rows(), by_suffix=True).select(
        "model_id", "suffix", "metric", r6("value").alias("value")
    )


@query(
    "reg_latest_metrics",
    f"""{NEWEST}, readable AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY timestamp DESC, entry_id DESC)
      AS q FROM vals WHERE entry_id NOT LIKE '%3')
    SELECT model_id, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1_score FROM readable WHERE q = 1""",
)
def reg_latest_metrics(spark, sf):
    # Every document whose id ends in 3 is damaged and must be skipped.
    path = scratch_path(spark, "documents")
    stamp = F.concat_ws("/", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "entry_id")
    values = F.struct("accuracy", F.col("f1").alias("f1_score"))
    nested = F.to_json(F.struct("model_id", stamp.alias("timestamp"), F.struct(values.alias("test_metrics")).alias("metrics")))
    flat = F.to_json(F.struct("model_id", stamp.alias("timestamp"), values.alias("metrics")))
    document = F.when(F.col("suffix") == "tuned", nested).otherwise(flat)
    damaged = F.when(F.col("entry_id").endswith("3"), F.expr("left(doc, length(doc) - 9)")).otherwise(F.col("doc"))
    derive(spark, sf, VALUES, "part").withColumn("doc", document).select(damaged.alias("value")).write.text(path)
    return read_metric_documents(spark, path).select(
        "model_id", r6("accuracy").alias("accuracy"), r6("f1_score").alias("f1_score")
    )


@query(
    "reg_serving_choice",
    f"""{NEWEST} SELECT true AS model_loaded, 'healthy' AS status, model_id, model_type,
        CAST(created AS VARCHAR) AS created, round(f1, 6) AS score,
        step AS features
        FROM cur JOIN latest USING (model_id) ORDER BY f1 DESC, model_id LIMIT 1""",
)
def reg_serving_choice(spark, sf):
    kept = F.create_map(F.lit("features"), F.to_json(F.split("step", " ")))
    row = R.serving_choice(R.current_models(_events(spark, sf).withColumn("metadata", kept)), _metrics(spark, sf))
    return row.select(
        "model_loaded",
        "status",
        "model_id",
        "model_type",
        F.col("created").cast("string").alias("created"),
        r6("score").alias("score"),
        F.concat_ws(" ", "features").alias("features"),
    )


@query(
    "reg_resave",
    f"""{NEWEST}, ended AS (SELECT model_id, max(created) AS ended FROM events WHERE event = 'delete' GROUP BY model_id)
    SELECT model_id, count(*) AS metric_rows, CAST(min(timestamp) AS VARCHAR) AS oldest FROM vals SEMI JOIN cur USING (model_id)
      LEFT JOIN ended USING (model_id) WHERE ended IS NULL OR timestamp > ended GROUP BY model_id""",
)
def reg_resave(spark, sf):
    """Metrics end with their model: those from before a deletion do not belong to a model saved later."""
    events = _events(spark, sf)
    kept = R.metrics_of_known(_metrics(spark, sf), R.current_models(events), events)
    return kept.groupBy("model_id").agg(
        F.count_distinct("entry_id").alias("metric_rows"), F.min("timestamp").cast("string").alias("oldest")
    )


@query(
    "reg_vacuum",
    f"""WITH events AS ({plain(EVENTS)}), ended AS (SELECT model_id, event_id, event,
      lead(created) OVER (PARTITION BY model_id ORDER BY created, event_id) AS ended FROM events)
    SELECT model_id, event_id, 'a/' || event_id AS artifact, CAST(ended AS VARCHAR) AS ended FROM ended
      WHERE event = 'save' AND ended < TIMESTAMP '2024-01-01 20:00:00'""",
)
def reg_vacuum(spark, sf):
    """The artifacts that a removal with some retention takes away."""
    events = _events(spark, sf).withColumn("artifact", F.concat(F.lit("a/"), "event_id"))
    dead = R.dead_artifacts(events, F.to_timestamp(F.lit("2024-01-01 20:00:00")))
    return dead.withColumn("ended", F.col("ended").cast("string"))


@query(
    "reg_metrics_cleanup",
    f"""{NEWEST}, nth AS (SELECT *, row_number() OVER (PARTITION BY model_id, suffix ORDER BY timestamp DESC, entry_id DESC) AS k FROM vals)
    SELECT model_id, suffix, entry_id FROM nth WHERE k <= 3""",
)
def reg_metrics_cleanup(spark, sf):
    """A store after keeping the newest three entries of each model and suffix."""
    store = MetricsStore(spark, scratch_path(spark, "metrics"))
    _metrics(spark, sf).write.parquet(f"{store.path}/entries")
    store.cleanup(keep_latest=3)
    return store.rows().select("model_id", "suffix", "entry_id").distinct()
