"""Current state, comparison and ranking over registry events and metric rows.

Works on plain tables: ``events`` is an append-only log of saves and deletes, ``metrics`` holds
one row per model, entry and measured value. "Latest" is always an aggregate (combined on the
map side), so one model with very many events is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COMPARED = ("accuracy", "precision", "recall", "f1_score", "roc_auc")


def current_models(events: DataFrame) -> DataFrame:
    """Latest event per model, without the deleted ones."""
    newest = F.max_by(F.struct("*"), F.struct("created", "event_id"))
    latest = events.groupBy("model_id").agg(newest.alias("e")).select("e.*")
    return latest.filter("event = 'save'").drop("event")


def dead_artifacts(events: DataFrame, before: Column) -> DataFrame:
    """``model_id, event_id, artifact, ended`` of saves that a later event of the id ended before the given time."""
    in_order = W.partitionBy("model_id").orderBy("created", "event_id")
    rows = events.select("model_id", "event_id", "event", "artifact", F.lead("created").over(in_order).alias("ended"))
    return rows.filter((F.col("event") == "save") & (F.col("ended") < before)).drop("event")


def models_summary(current: DataFrame) -> DataFrame:
    """Display table, newest first; absent values get defaults."""
    return current.select(
        "model_id",
        F.coalesce("model_type", F.lit("unknown")).alias("model_type"),
        "created",
        F.round(F.coalesce("file_size", F.lit(0)) / F.lit(1048576), 2).alias("file_size_mb"),
        F.coalesce("classes", F.array().cast("array<string>")).alias("classes"),
        F.concat_ws(", ", "pipeline_steps").alias("pipeline_steps"),
    ).orderBy(F.desc("created"), "model_id")


def latest_model(current: DataFrame) -> DataFrame:
    """One row: the id of the newest model, NULL for an empty registry."""
    return current.agg(F.max_by("model_id", F.struct("created", "model_id")).alias("model_id"))


def keep_latest(current: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` models; a distributed top-n, not a global sort."""
    return current.orderBy(F.desc("created"), F.desc("model_id")).limit(n)


def outdated(current: DataFrame, n: int) -> DataFrame:
    """Models beyond the newest ``n``."""
    kept = F.broadcast(keep_latest(current, n).select("model_id")) if n <= 10_000 else keep_latest(current, n)
    return current.join(kept.select("model_id"), "model_id", "left_anti")


def known(current: DataFrame, ids: DataFrame) -> DataFrame:
    """Which of the wanted ids exist (membership, each row once)."""
    return ids.join(current, "model_id", "left_semi")


def metrics_of_known(metrics: DataFrame, current: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Metric rows whose model still exists.

    With the registry's ``events``, rows from before the newest deletion of an id stay with the model
    that was deleted, and do not come back when the id is saved again.
    """
    kept = metrics.join(current.select("model_id"), "model_id", "left_semi")
    return kept if events is None else metrics_since_delete(kept, events)


def metrics_since_delete(metrics: DataFrame, events: DataFrame) -> DataFrame:
    """Metric rows that are newer than the newest deletion of their id."""
    ended = events.filter("event = 'delete'").groupBy("model_id").agg(F.max("created").alias("ended"))
    return metrics.join(ended, "model_id", "left").filter("ended IS NULL OR timestamp > ended").drop("ended")


def outdated_entries(metrics: DataFrame, n: int) -> DataFrame:
    """Ids of all but the newest ``n`` metric entries of each model and suffix."""
    newest = metrics.groupBy("model_id", "suffix", "entry_id").agg(F.max("timestamp").alias("timestamp"))
    rank = F.row_number().over(W.partitionBy("model_id", "suffix").orderBy(F.desc("timestamp"), F.desc("entry_id")))
    return newest.withColumn("nth", rank).filter(F.col("nth") > n).select("entry_id")


def entries(metrics: DataFrame) -> DataFrame:
    """Stored metric entries as ``(model_id, suffix)``."""
    return metrics.select("model_id", "suffix").distinct()


def latest_entry_values(metrics: DataFrame, by_suffix: bool = False) -> DataFrame:
    """Metric rows of the newest entry of each model (or of each model and suffix).

    The newest entries come from a small aggregate; the rows then join on the entry id, which
    spreads evenly even if one model owns most of the entries.
    """
    keys = ["model_id", "suffix"] if by_suffix else ["model_id"]
    newest = metrics.groupBy(*keys).agg(F.max(F.struct("timestamp", "entry_id")).alias("e"))
    wanted = newest.select("model_id", F.col("e.entry_id").alias("entry_id"))
    return metrics.join(wanted, ["model_id", "entry_id"], "left_semi")


def compare_models(metrics: DataFrame, primary: str = "f1_score", names: tuple[str, ...] = COMPARED) -> DataFrame:
    """One row per model with its newest test metrics, best first; NULLs last."""
    overall = latest_entry_values(metrics).filter("scope = 'overall' AND split = 'test'")
    wide = overall.groupBy("model_id").agg(
        F.max("timestamp").alias("timestamp"),
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names],
    )
    if primary not in names:
        return wide.orderBy("model_id")
    return wide.orderBy(F.desc_nulls_last(primary), "model_id")


def best_model(compared: DataFrame, primary: str = "f1_score") -> DataFrame:
    """One row ``(model_id, score)`` of the highest primary metric; NULL for no candidate."""
    if primary not in compared.columns:
        return compared.agg(F.lit(None).cast("string").alias("model_id"), F.lit(None).cast("double").alias("score"))
    rated = compared.filter(F.col(primary).isNotNull())
    # On equal scores the alphabetically first id wins, as in the ordering of the comparison.
    first = F.min_by("model_id", F.struct(-F.col(primary), F.col("model_id")))
    return rated.agg(first.alias("model_id"), F.max(primary).alias("score"))


def best_of_list(rows: list[tuple[str, float | None]]) -> dict:
    """Best of named scores held by the caller: missing scores are skipped, the first one wins
    ties, and with no score at all the first name is reported with score -1."""
    best, score = 0, -1.0
    for i, (_, value) in enumerate(rows):
        if value is not None and value > score:
            best, score = i, value
    return {"best_model_name": rows[best][0], "best_model_index": best, "best_score": score}


def serving_choice(
    current: DataFrame, metrics: DataFrame, primary: str = "f1_score", events: DataFrame | None = None
) -> DataFrame:
    """One row describing the model to score with: best by metric, else newest, else none."""
    rated = compare_models(metrics_of_known(metrics, current, events), primary).select("model_id", F.col(primary).alias("score"))
    described = current.join(rated, "model_id", "left")
    # Rated models come first by score, unrated ones by age; equal ones by id.
    rank = F.struct(
        F.col("score").isNull(),
        -F.coalesce("score", F.lit(0.0)),
        F.when(F.col("score").isNull(), -F.unix_micros("created")),
        F.col("model_id"),
    )
    # What the model was trained on is stored as JSON in its metadata.
    stored = F.col("metadata")["features"] if "metadata" in current.columns else F.lit(None).cast("string")
    described = described.withColumn("features", F.from_json(stored, "array<string>"))
    chosen = F.min_by(F.struct("model_id", "model_type", "classes", "created", "score", "features"), rank)
    return described.agg(F.count("*").alias("n"), chosen.alias("m")).select(
        (F.col("n") > 0).alias("model_loaded"),
        F.when(F.col("n") > 0, "healthy").otherwise("unhealthy").alias("status"),
        "m.*",
    )


def tombstones(lost: DataFrame, created: Column) -> DataFrame:
    """Delete events for the given models."""
    return lost.select("model_id", created.alias("created"), F.lit("delete").alias("event"))
