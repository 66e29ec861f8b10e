"""Questions to the append-only history: events of objects, requests to the facility, selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import truncate_text

STATE_EVENTS = ["created", "activated", "deactivated"]


def selection_counts(selections: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Selections per pipeline, version and survey, with the first and last time. Reduced before the join."""
    per_id = selections.groupBy("pipeline_id", "survey_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("selection_time").alias("first"), F.max("selection_time").alias("last")
    )
    return per_id.join(pipelines, "pipeline_id").groupBy("pipeline_name", "version", "survey_id").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def active_set_as_of(events: DataFrame, moment: Column) -> DataFrame:
    """(object_id, event_type): objects whose last state event up to `moment` is not a deactivation."""
    last = Window.partitionBy("object_id").orderBy(F.desc("event_time"), F.desc("event_id"))
    past = events.filter(F.col("event_type").isin(STATE_EVENTS) & (F.col("event_time") <= moment))
    ranked = past.select("object_id", "event_type", F.row_number().over(last).alias("_rank"))
    return ranked.filter(F.col("_rank") == 1).filter(F.col("event_type") != "deactivated").drop("_rank")


def multi_survey_objects(events: DataFrame) -> DataFrame:
    """(object_id, surveys): objects with alerts of more than one survey."""
    surveys = events.filter(F.col("event_type") == "alert").groupBy("object_id").agg(
        F.sort_array(F.collect_set("survey_id")).alias("surveys")
    )
    return surveys.filter(F.size("surveys") > 1)


def native_ids_of_object(events: DataFrame, object_id: int) -> DataFrame:
    mine = events.filter((F.col("object_id") == object_id) & F.col("event_type").isin("alert", "manual_submission"))
    return mine.select("survey_id", "survey_object_id").distinct()


def object_events(events: DataFrame, object_id: int) -> DataFrame:
    """Everything that happened to one object, in order."""
    return events.filter(F.col("object_id") == object_id).orderBy("event_time", "event_id")


def object_requests(log: DataFrame, object_id: int) -> DataFrame:
    """Every request that named the object, in order, with the start of the answer."""
    mine = log.filter(F.array_contains("object_ids", F.lit(object_id).cast("long")))
    return mine.withColumn("response", truncate_text(F.col("response_text"), 200)).orderBy("request_time")


def recent_requests(log: DataFrame, n: int = 20) -> DataFrame:
    return log.orderBy(F.desc("log_id")).limit(n)


def recent_deactivations(events: DataFrame, objects: DataFrame, n: int = 20) -> DataFrame:
    """The last deactivations with the object's name. Joined first: an event without an object does not count."""
    off = events.filter(F.col("event_type") == "deactivated").select("event_id", "object_id", "event_time", "reason")
    named = off.join(objects.select("object_id", "name"), "object_id")
    return named.orderBy(F.desc("event_time"), F.desc("event_id")).limit(n)


def needs_human(objects: DataFrame) -> DataFrame:
    stuck = objects.filter(F.col("sync_state").isin("failed", "conflict"))
    return stuck.select("object_id", "name", "sync_state", "sync_attempts", "sync_last_error").orderBy("object_id")


def outbox_health(objects: DataFrame) -> DataFrame:
    open_rows = objects.filter(F.col("sync_pending") | F.col("sync_state").isNotNull())
    return open_rows.groupBy(F.coalesce("sync_state", F.lit("normal")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def active_counts(objects: DataFrame) -> DataFrame:
    return objects.groupBy("active").agg(F.count(F.lit(1)).alias("n"))


def request_outcomes_daily(log: DataFrame, now: Column, days: int = 7) -> DataFrame:
    recent = log.filter(F.col("request_time") > now - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(F.date_trunc("day", "request_time").alias("day"), "method", "outcome").agg(
        F.count(F.lit(1)).alias("n")
    )


def event_span(events: DataFrame) -> DataFrame:
    return events.agg(
        F.min("event_time").alias("first"), F.max("event_time").alias("last"), F.count(F.lit(1)).alias("n")
    )


def payload_unpack(log: DataFrame, outcome: str = "dry_run") -> DataFrame:
    """One row per target of the logged payloads; a payload is one JSON object or an array of them."""
    text = F.trim("payload")
    as_array = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    item = "array<struct<name:string,mag:string,mag_type:string,dec:string>>"
    rows = log.filter(F.col("outcome") == outcome).select(
        "log_id", "request_time", F.posexplode(F.from_json(as_array, item)).alias("position", "_item")
    )
    return rows.select("log_id", "position", "_item.name", "_item.mag", "_item.mag_type", "_item.dec", "request_time")
