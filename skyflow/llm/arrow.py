"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 2_000      # whole texts are in these batches
BATCH_BYTES = 4 << 20


def map_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` in batches that stay small where texts are long."""
    spark: SparkSession = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a string column; null is the empty text."""
    return [t or "" for t in column.to_pylist()]
