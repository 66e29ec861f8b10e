"""The tables that an ingest keeps, and append-only history. `buckets` stores the former."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.lineage import materialize
from ..operators.numbering import with_row_index

_TABLES = {
    "objects": schemas.OBJECTS,
    "native_names": schemas.NATIVE_NAMES,
    "selections": schemas.SELECTIONS,
    "nights": schemas.NIGHTS,
}


@dataclass(frozen=True)
class SkyState:
    """Everything one ingest reads and replaces. Events are not state: they are only appended."""

    objects: DataFrame
    native_names: DataFrame
    selections: DataFrame
    nights: DataFrame

    def with_tables(self, **tables: DataFrame) -> "SkyState":
        return replace(self, **tables)


def empty_state(spark: SparkSession) -> SkyState:
    return SkyState(**{name: spark.createDataFrame([], schema) for name, schema in _TABLES.items()})


def append_history(events: DataFrame, path: str, batch: int | str, next_id: int = 1) -> int:
    """
    Add one batch of events (with `event_rank`, their order within a moment) to the history and return the
    next free id. Ids break ties of the event time in the order things happened. A batch has its own
    folder, partitioned by date, so writing it again after a failure replaces it instead of doubling it.
    """
    rows = materialize(events, "events")
    n = rows.count()
    keys = ["event_time", "event_rank", "object_id", "survey_id", "survey_object_id", "pipeline_id"]
    numbered = with_row_index(rows, [F.col(c) for c in keys], "event_id", known_rows=n, start=next_id)
    numbered.drop("event_rank").withColumn("event_date", F.to_date("event_time")).write.mode("overwrite").partitionBy(
        "event_date").parquet(f"{path.rstrip('/')}/batch={batch}")
    return next_id + n


def append_requests(log_rows: DataFrame, path: str, batch: int | str) -> None:
    """Add one batch of requests to the log. Writing a batch again replaces it."""
    log_rows.withColumn("request_date", F.to_date("request_time")).write.mode("overwrite").partitionBy(
        "request_date").parquet(f"{path.rstrip('/')}/batch={batch}")
