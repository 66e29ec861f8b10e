"""Column contracts shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

BAND_VALUES = T.MapType(T.StringType(), T.DoubleType())
BAND_COUNTS = T.MapType(T.StringType(), T.LongType())

# The alert contract: what a survey plugin returns, one row per alert.
CONTRACT_COLUMNS = [
    "native_id", "survey_id", "pipeline_id", "ra", "dec", "jdmin", "jdmax",
    "latest_filter", "latest_mag", "n_sources",
]

CONTRACT = T.StructType([
    T.StructField("native_id", T.StringType()),
    T.StructField("survey_id", T.IntegerType()),
    T.StructField("pipeline_id", T.IntegerType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("jdmin", T.DoubleType()),
    T.StructField("jdmax", T.DoubleType()),
    T.StructField("latest_filter", BAND_VALUES),
    T.StructField("latest_mag", BAND_VALUES),
    T.StructField("n_sources", BAND_COUNTS),
])

OBJECTS = T.StructType([
    T.StructField("object_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("ra", T.DoubleType()),
    T.StructField("dec", T.DoubleType()),
    T.StructField("jdmin", T.DoubleType()),
    T.StructField("jdmax", T.DoubleType()),
    T.StructField("jd_obs_trigger", T.DoubleType()),
    T.StructField("latest_mags", BAND_VALUES),
    T.StructField("latest_mjd", BAND_VALUES),
    T.StructField("n_sources", BAND_COUNTS),
    T.StructField("last_survey_id", T.IntegerType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("sync_pending", T.BooleanType()),
    T.StructField("sync_state", T.StringType()),
    T.StructField("sync_attempts", T.IntegerType()),
    T.StructField("sync_last_error", T.StringType()),
    T.StructField("facility_id", T.LongType()),
    T.StructField("facility_mag", T.DoubleType()),
    T.StructField("ostd_targ_id", T.LongType()),
    T.StructField("ostd_u_obj_id", T.LongType()),
    T.StructField("date_ingested", T.TimestampType()),
    T.StructField("created", T.TimestampType()),
    T.StructField("updated", T.TimestampType()),
])

NATIVE_NAMES = T.StructType([
    T.StructField("object_id", T.LongType()),
    T.StructField("survey_id", T.IntegerType()),
    T.StructField("native_id", T.StringType()),
])

SELECTIONS = T.StructType([
    T.StructField("object_id", T.LongType()),
    T.StructField("survey_id", T.IntegerType()),
    T.StructField("pipeline_id", T.IntegerType()),
    T.StructField("selection_time", T.TimestampType()),
])

NIGHTS = T.StructType([
    T.StructField("survey_id", T.IntegerType()),
    T.StructField("night", T.IntegerType()),
])

EVENTS = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("object_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("survey_id", T.IntegerType()),
    T.StructField("survey_object_id", T.StringType()),
    T.StructField("pipeline_id", T.IntegerType()),
    T.StructField("submitted_by", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("code_version", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

REQUEST_LOG = T.StructType([
    T.StructField("request_time", T.TimestampType()),
    T.StructField("object_ids", T.ArrayType(T.LongType())),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("response_text", T.StringType()),
    T.StructField("code_version", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

SYNC_STATES = ("ambiguous", "failed", "conflict", "not_submittable")
