"""Cutting lineage: results written to the cluster's shared folder and read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_unset: dict[str, str] = {}   # application id -> folder, where the session names none


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only where that is unset and all runs on one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _unset:
        _unset[app] = tempfile.mkdtemp(prefix="skyflow-")
    return _unset[app]


def new_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/skyflow/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step", options: Mapping[str, str] | None = None) -> DataFrame:
    """
    Write `df` as parquet to the shared folder and read it back. The result survives lost executors,
    is computed once however often it is used, and its file sizes tell Spark which sides are small
    enough to broadcast. `options` are the parquet writer's.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
