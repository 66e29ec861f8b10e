"""
Structured Streaming: the streams of several surveys are drained one after the other into the stored state.

Each micro-batch parses its messages once, sets unreadable messages and refused rows aside as dead letters, and folds the rest into the state. Spark moves the
source's offsets only after that. No watermark: late alerts count.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.lineage import materialize
from ..plans.ingest import IngestParams, IngestResult, age_out_into, ingest_into
from ..sources.alerts import judged_messages
from ..sources.buckets import BucketStore
from ..sources.dimensions import pipeline_id_of
from .report import BatchCounts, ProgressListener, StreamReport

DEAD_LETTER = T.StructType([
    T.StructField("stage", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("native_id", T.StringType()), T.StructField("content", T.StringType()),
])


@dataclass(frozen=True)
class SurveyStream:
    """
    One survey's messages (`value`, further columns are kept) and how its parsed rows become contract rows, given the id of the pipeline (name, version)
    that selected them. The caller keeps `name` for as long as it keeps the checkpoint.
    """

    name: str
    messages: DataFrame
    schema: T.StructType
    id_key: str
    to_contract: Callable[[DataFrame, int], DataFrame]
    checkpoint: str
    pipeline: tuple[str, str]


@dataclass
class StreamRun:
    """What a run did: the report of each stream, the objects that ageing switched off, and the steps that failed."""

    reports: list[StreamReport] = field(default_factory=list)
    deactivated: DataFrame | None = None
    failed: dict[str, Exception] = field(default_factory=dict)


def dead_letters(skipped: DataFrame, rejected: DataFrame) -> DataFrame:
    """Messages that could not be read, as they came, and contract rows that were refused, as JSON."""
    unread = skipped.select(F.lit("skipped").alias("stage"), F.col("skip_reason").alias("reason"), F.lit(None).cast("string").alias("native_id"), F.col("value").alias("content"))
    content = F.to_json(F.struct(*[c for c in rejected.columns if c != "reject_reason"]))
    refused = rejected.select(F.lit("rejected").alias("stage"), F.col("reject_reason").alias("reason"), F.col("native_id").cast("string").alias("native_id"), content.alias("content"))
    return unread.unionByName(refused)


def start_stream_ingest(
    stream: SurveyStream, store: BucketStore, params: IngestParams, pipelines: DataFrame, history_path: str | None = None, dead_letter_path: str | None = None,
    on_batch: Callable[[int, BatchCounts, IngestResult], None] | None = None,
) -> StreamingQuery:
    """
    Drain what the source holds now (Trigger.AvailableNow) and stop. Every micro-batch is merged into the state together with its number and a
    fingerprint of its messages (count and XOR of their hashes) under the stream's name. The batch that Spark delivers again after a
    failure has the number and the fingerprint of the last one and is skipped. Any other batch with a number that has been seen comes from a
    checkpoint that was begun anew: it is ingested, under a new generation of the stream, so that nothing is lost and the history of the former batches stays.

    Dead letters and events are written to a folder of the batch's own, which a repetition replaces, before the state is.
    """
    pipeline_id = pipeline_id_of(pipelines, *stream.pipeline)         # an unknown one is an error

    def apply(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{stream.name}-{batch_id}")
        hashed = F.xxhash64("value")
        messages = materialize(
            judged_messages(batch, stream.schema, stream.id_key).observe(
                seen, F.count(F.lit(1)).alias("messages"), F.count("skip_reason").alias("skipped"), F.coalesce(F.bit_xor(hashed), F.lit(0)).alias("fingerprint")),
            "messages")
        counted = seen.get
        applied = store.pointer()["applied"]
        last = applied.get(stream.name, {"batch": -1, "generation": 0, "messages": 0, "fingerprint": 0})
        mark = {"messages": counted["messages"], "fingerprint": counted["fingerprint"]}
        if last["batch"] == batch_id and all(last[k] == v for k, v in mark.items()):
            return
        generation = last["generation"] + (batch_id <= last["batch"])
        key = f"{stream.name}-{generation}-{batch_id}"
        rows = messages.filter("skip_reason IS NULL").select("_alert.*", *[c for c in batch.columns if c != "value"])
        contract = materialize(stream.to_contract(rows, pipeline_id), "contract")
        done = {**applied, stream.name: {"batch": batch_id, "generation": generation, **mark}}
        if dead_letter_path is not None:
            result_rejects = IngestResult.rejects_of(contract, params)
            letters = dead_letters(messages.filter("skip_reason IS NOT NULL"), result_rejects)
            letters.write.mode("overwrite").parquet(f"{dead_letter_path.rstrip('/')}/batch={key}")
        result = ingest_into(store, contract, params, history_path, key, applied=done)
        if on_batch is not None:
            on_batch(batch_id, BatchCounts.of(stream.name, batch_id, counted, contract, result), result)

    return (
        stream.messages.writeStream.queryName(stream.name).foreachBatch(apply).option("checkpointLocation", stream.checkpoint)
        .trigger(availableNow=True).start()
    )


def read_dead_letters(spark, path: str) -> DataFrame:
    """All dead letters with the batch they are from."""
    return spark.read.schema(T.StructType([*DEAD_LETTER.fields, T.StructField("batch", T.StringType())])).option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")


def stream_run(
    streams: list[SurveyStream], store: BucketStore, params: IngestParams, pipelines: DataFrame, history_path: str | None = None, dead_letter_path: str | None = None,
) -> StreamRun:
    """
    One run: each stream in the given order is drained into the state, then ageing once, after the last. A stream that fails (its pipeline
    is unknown, its source or its batch breaks) is listed and the others go on; its batch leaves the state as it was and is read again
    next time, and as its survey's nights did not move, its objects don't age by it. Ageing runs even if nothing came or a stream failed.
    """
    run, spark = StreamRun(), store.spark
    listener = ProgressListener()
    spark.streams.addListener(listener)
    try:
        for stream in streams:
            report = StreamReport(stream.name)
            try:
                query = start_stream_ingest(
                    stream, store, params, pipelines, history_path, dead_letter_path, lambda _, counts, result, r=report: r.add(counts, result))
                try:
                    query.awaitTermination()
                finally:
                    report.progress = listener.progress_of(str(query.id))
            except Exception as error:
                run.failed[stream.name] = error
            run.reports.append(report)
        try:
            run.deactivated = age_out_into(store, params, history_path)
        except Exception as error:
            run.failed["ageing"] = error
    finally:
        spark.streams.removeListener(listener)
    return run
