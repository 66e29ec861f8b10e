"""Seeded dimension tables: surveys and selection versions (pipelines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.numbering import with_row_index
from ..operators.upsert import insert_if_absent

# Fixed values.
SURVEYS = [
    ("LSST", 1),
    ("ZTF", 2),
    ("LS4", 3),
    ("FACILITY", 4),
    ("ATLAS", 5),
    ("GOTO", 6),
    ("HSC", 7),
    ("BlackGEM", 8),
    ("TNS", 9),
]
PIPELINES = [
    ("lsst-default", "v1.0"),
    ("ztf-default", "v1.0"),
    ("ls4-default", "v1.0"),
    ("facility-default", "v1.0"),
    ("atlas-default", "v1.0"),
    ("goto-default", "v1.0"),
    ("hsc-default", "v1.0"),
    ("blackgem-default", "v1.0"),
    ("tns-default", "v1.0"),
    ("host", "v1.0"),
    ("manual", "v1.0"),
]


def seed_surveys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SURVEYS, "survey_name string, survey_id int")


def seed_pipelines(spark: SparkSession) -> DataFrame:
    rows = [(i, name, version) for i, (name, version) in enumerate(PIPELINES, start=1)]
    return spark.createDataFrame(rows, "pipeline_id int, pipeline_name string, version string")


def add_surveys(surveys: DataFrame, new: DataFrame) -> DataFrame:
    return insert_if_absent(surveys, new.dropDuplicates(["survey_id"]), ["survey_id"])[0]


def add_pipelines(pipelines: DataFrame, new: DataFrame) -> DataFrame:
    """Insert (pipeline_name, version) pairs that are absent; ids continue in name and version order."""
    keys = ["pipeline_name", "version"]
    fresh = new.select(*keys).distinct().join(pipelines.select(*keys), keys, "left_anti")
    last = pipelines.agg(F.max("pipeline_id")).first()[0] or 0
    numbered = with_row_index(fresh, [F.col(k) for k in keys], "pipeline_id", start=last + 1)
    return pipelines.unionByName(numbered.withColumn("pipeline_id", F.col("pipeline_id").cast("int")))


def pipeline_id_of(pipelines: DataFrame, name: str, version: str) -> int:
    """The id of a selection version; an unknown one is an error."""
    row = pipelines.filter((F.col("pipeline_name") == name) & (F.col("version") == version)).select("pipeline_id").first()
    if row is None:
        raise ValueError(f"no pipeline {name!r} version {version!r}")
    return int(row[0])
