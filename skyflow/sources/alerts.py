"""Alert sources: JSON messages (files or Kafka), bad messages set aside, manual submissions, id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.scalars import json_variant

_BANDS = ["g", "r", "i", "z"]
_d, _l, _s = T.DoubleType(), T.LongType(), T.StringType()

LSST_ALERT = T.StructType(
    [T.StructField("diaObjectId", _l), T.StructField("ra", _d), T.StructField("decl", _d),
     T.StructField("lastDiaSourceMjdTai", _d), T.StructField("firstDiaSourceMjdTai", _d),
     T.StructField("latest_psfFlux", _d)]
    + [T.StructField(f"{b}_{c}", _d) for b in _BANDS for c in ("psfFlux", "psfFluxSigma", "latestMJD")]
    + [T.StructField("nPosDiaSources", _l), T.StructField("nPosDiaSourcesNights", _l)]
    + [T.StructField(f"n{b}Sources", _l) for b in _BANDS]
    + [T.StructField("sherlock_classifications", _s)]
)

ZTF_ALERT = T.StructType([
    T.StructField("objectId", _s), T.StructField("ra", _d), T.StructField("decl", _d),
    T.StructField("first_jd", _d), T.StructField("latest_jd", _d),
    T.StructField("latestFilter", _s), T.StructField("latestMag", _d),
])


def read_alert_files(spark: SparkSession, path: str) -> DataFrame:
    """Message files, one JSON text per line, as a `value` column."""
    return spark.read.text(path)


def stream_alert_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same files as a stream; `max_files` bounds what one trigger reads."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def stream_alert_topic(
    spark: SparkSession, servers: str, topic: str, max_messages: int = 20_000, options: dict[str, str] | None = None
) -> DataFrame:
    """
    A Kafka topic as a stream of `value` texts with `partition` and `offset`, a new checkpoint starting at the
    oldest message. Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", max_messages)
    )
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def _readable(value: Column, id_key: str) -> Column:
    """The message is a JSON object with an id. Repeated keys and non-finite numbers are as good as elsewhere."""
    schema = T.StructType([T.StructField(id_key, _s), T.StructField("_corrupt", _s)])
    found = F.from_json(value, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return F.coalesce(F.ltrim(value).startswith("{") & found[id_key].isNotNull() & found["_corrupt"].isNull(), F.lit(False))


def message_problem(value: Column, id_key: str) -> Column:
    """Why a message that is not readable is skipped: not JSON, no object, or no id."""
    parsed = json_variant(value)
    return (
        F.when(parsed.isNull(), F.lit("not JSON"))
        .when(~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("not an object"))
        .otherwise(F.lit(f"no {id_key}"))
    )


def judged_messages(messages: DataFrame, schema: T.StructType, id_key: str) -> DataFrame:
    """
    `messages` plus `_alert` (the parsed row) and `skip_reason` (NULL for a message that is readable). A message is parsed once;
    only one that isn't right in every field is looked at again.
    """
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", _s)])
    parsed = messages.withColumn("_alert", F.from_json("value", whole, {"columnNameOfCorruptRecord": "_corrupt"}))
    value = F.col("value")
    clean = F.coalesce(F.ltrim(value).startswith("{") & F.col(f"_alert.{id_key}").isNotNull() & F.col("_alert._corrupt").isNull(), F.lit(False))
    reason = F.when(clean, None).when(_readable(value, id_key), None).otherwise(message_problem(value, id_key))
    return parsed.withColumn("skip_reason", reason.cast("string")).withColumn("_alert", F.col("_alert").dropFields("_corrupt"))


def parse_alerts(messages: DataFrame, schema: T.StructType, id_key: str) -> DataFrame:
    """The readable messages as typed rows; other columns of `messages` (offsets) are kept."""
    rest = [c for c in messages.columns if c != "value"]
    return judged_messages(messages, schema, id_key).filter("skip_reason IS NULL").select(*rest, "_alert.*")


def skipped_messages(messages: DataFrame, id_key: str) -> DataFrame:
    """The messages that are set aside, with `skip_reason`."""
    bad = messages.filter(~_readable(F.col("value"), id_key))
    return bad.withColumn("skip_reason", message_problem(F.col("value"), id_key))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """A headerless text file of ids, one column `objectId`."""
    return spark.read.schema("objectId string").csv(path)
