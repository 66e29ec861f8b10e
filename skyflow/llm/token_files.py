"""Token ids of a corpus as binary files of patched frame-of-reference blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lineage import new_dir
from . import frames
from .arrow import map_rows, texts_of
from .vocab import batches, word_bpe

END_ID = 1
RECORD_IDS = 1 << 17     # a record closes at this many ids; a longer document fills one alone


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text",
    parts: int | None = None,
) -> None:
    """
    Encode every whole text, append `end_id`, and write the ids in ascending id order to `path`.

    The rows are dealt into id ranges, one file each; rows of one id are ordered by their text's hash, so that reruns
    agree. A file is a sequence of records (segment, record, doc_ids, lengths, payload): the payload is `frames.encode`
    of all ids of whole documents, with the index of its block starts inside. Spark commits the files, so a lost task is
    simply written again.

    Null texts are empty (only the end id), null ids come first, repeated rows are written as often as they occur, other
    columns are not read, an empty table gives no records.
    """

    def encode(parts_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, segment, record = word_bpe(vocabulary), TaskContext.get().partitionId(), 0
        keys: list = []
        lengths: list[int] = []
        pieces: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal keys, lengths, pieces, size, record
            out = pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([record], pa.int32()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([frames.encode(np.concatenate(pieces))], pa.binary())],
                names=["segment", "record", "doc_ids", "lengths", "payload"])
            keys, lengths, pieces, size, record = [], [], [], 0, record + 1
            return out

        for part in parts_:
            texts, ids = texts_of(part.column(1)), part.column(0).to_pylist()
            for a, b in batches([len(t) for t in texts]):
                values, counts = model.encode(texts[a:b])
                stops = np.cumsum(counts)
                values = np.insert(values, stops, end_id).astype(np.uint32)
                stops += np.arange(1, len(stops) + 1)
                at = 0
                while at < b - a:                        # as many whole documents as fit into the record
                    begin = int(stops[at - 1]) if at else 0
                    to = max(at + 1, int(np.searchsorted(stops, begin + RECORD_IDS - size, side="right")))
                    keys += ids[a + at:a + to]
                    lengths += (counts[at:to] + 1).tolist()
                    pieces.append(values[begin:stops[to - 1]])
                    size += int(stops[to - 1]) - begin
                    at = to
                    if size >= RECORD_IDS or at < b - a:
                        yield close()
        if keys:
            yield close()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    records = map_rows(
        dealt.sortWithinPartitions(*order), encode,
        "segment int, record int, doc_ids array<bigint>, lengths array<bigint>, payload binary")
    records.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """
    doc_id, start (ids of all documents before it), ids of every document in the files at `path`. The ids before each
    record come from the stored lengths alone: one small row per record is summed up, first by file.
    """
    records = spark.read.parquet(path)
    sizes = records.select("segment", "record", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    files = sizes.groupBy("segment").agg(F.sum("n").alias("n"))        # one row per file
    before = files.alias("a").select(
        "segment", (F.expr("sum(n) OVER (ORDER BY segment)") - F.col("n")).alias("file_start"))
    within = sizes.select("segment", "record", F.expr("sum(n) OVER (PARTITION BY segment ORDER BY record) - n").alias("in_file"))
    starts = within.join(before, "segment").select("segment", "record", (F.col("file_start") + F.col("in_file")).alias("record_start"))

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for keys, lengths, payload, start in zip(*(part.column(i).to_pylist() for i in range(4))):
                values = frames.decode(payload)
                stops = np.cumsum(np.array(lengths, np.int64))
                begins = stops - np.array(lengths, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(begins + start),
                     pa.LargeListArray.from_arrays(np.append(begins, stops[-1]), pa.array(values.astype(np.int32))).cast(pa.list_(pa.int32()))],
                    names=["doc_id", "start", "ids"])

    joined = records.join(starts, ["segment", "record"]).select("doc_ids", "lengths", "payload", "record_start")
    return map_rows(joined, decode, "doc_id bigint, start bigint, ids array<int>")


def id_digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (unsigned, of little-endian unsigned 32-bit ids) of rows with ids."""

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column(2)
            values, offsets = np.asarray(ids.values).astype("<u4"), np.asarray(ids.offsets)
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_rows(documents.select("doc_id", "start", "ids"), digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files in the shared folder, read back."""
    path = new_dir(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return id_digests(read_token_files(spark, path))
