"""A log of accepted messages with running numbers, and a stream over it whose batches are bounded by accepted messages."""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..operators.lineage import materialize
from ..operators.numbering import write_row_index
from .alerts import judged_messages
from .buckets import _file_system, _names

SOURCE = "accepted_messages"
MAX_ACCEPTED = 20_000         # fixed value: accepted messages that one run takes


def _index(spark: SparkSession, path: str) -> dict[int, list[dict]]:
    """The files of each logged batch with the numbers they hold."""
    out = {}
    for name in _names(spark, f"{path}/index"):
        if name.endswith(".json"):
            out[int(name.split(".")[0])] = json.loads(spark.read.text(f"{path}/index/{name}", wholetext=True).first()[0])
    return out


def log_accepted(messages: DataFrame, path: str, batch: int, schema: T.StructType, id_key: str, skipped_path: str | None = None) -> int:
    """
    Add the accepted messages (`value`) of one batch to the log at `path`, numbered on from the batches before it, and return how many they
    are. Unreadable ones go to `skipped_path`. Writing a batch again replaces it. The index has one entry a file.
    """
    spark, path = messages.sparkSession, path.rstrip("/")
    judged = materialize(judged_messages(messages, schema, id_key).select("value", "skip_reason", F.monotonically_increasing_id().alias("_arrival")), "judged")
    if skipped_path is not None:
        judged.filter("skip_reason IS NOT NULL").select("value", "skip_reason").write.mode("overwrite").parquet(f"{skipped_path.rstrip('/')}/batch={batch}")
    first = max((f["last"] + 1 for number, files in _index(spark, path).items() if number < batch for f in files), default=0)
    accepted, n = write_row_index(judged.filter("skip_reason IS NULL").select("value", "_arrival"), [F.col("_arrival")], "number", first)
    folder = f"{path}/data/batch={batch}"
    accepted.select("number", "value").write.mode("overwrite").parquet(folder)      # each file holds neighbouring numbers
    files = spark.read.schema("number bigint, value string").parquet(folder).groupBy(F.input_file_name().alias("file")).agg(
        F.min("number").alias("first"), F.max("number").alias("last")).collect() if n else []      # one row a file
    target, fs = _file_system(spark, f"{path}/index/{batch}.json")
    out = fs.create(target, True)
    out.write(bytearray(json.dumps([f.asDict() for f in files]), "utf-8"))
    out.close()
    return n


def start_log(messages: DataFrame, path: str, checkpoint: str, schema: T.StructType, id_key: str, skipped_path: str | None = None) -> StreamingQuery:
    """Drain a stream of messages into the log."""
    return (
        messages.writeStream.foreachBatch(lambda batch, number: log_accepted(batch, path, number, schema, id_key, skipped_path) and None)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


class _Numbers(InputPartition):
    """The numbers from `low` to `high` of one file."""

    def __init__(self, file: str, low: int, high: int):
        self.file, self.low, self.high = file, low, high


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://") if "://" in uri or uri.startswith("file:") else uri)


class AcceptedReader(DataSourceStreamReader):
    """
    An offset is a number of accepted messages. A batch ends `bound` messages after its begin, or where the log ends; Spark keeps the offsets. Only the
    index is read to plan it, the messages are read by the tasks, a file's share each. After a restart Spark plans the last batch once more, from
    whose end the reader goes on.
    """

    def __init__(self, path: str, bound: int):
        self.path, self.bound, self.at = path.rstrip("/"), bound, 0

    def _files(self) -> list[dict]:
        fs, folder = _open(f"{self.path}/index")
        found = fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        files = []
        for info in sorted(found, key=lambda i: i.path):
            if info.path.endswith(".json"):
                with fs.open_input_stream(info.path) as stream:
                    files += json.loads(stream.read())
        return files

    def initialOffset(self) -> dict:
        return {"number": 0}

    def latestOffset(self) -> dict:
        end = max((f["last"] + 1 for f in self._files()), default=0)
        return {"number": max(self.at, min(self.at + self.bound, end))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["number"])
        low, high = start["number"], end["number"] - 1
        return [_Numbers(f["file"], max(low, f["first"]), min(high, f["last"])) for f in self._files() if f["first"] <= high and f["last"] >= low]

    def read(self, partition: _Numbers) -> Iterator[pa.RecordBatch]:
        fs, file = _open(unquote(partition.file))
        with fs.open_input_file(file) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=["number", "value"]):
                number = batch.column(0)
                wanted = pc.and_(pc.greater_equal(number, partition.low), pc.less_equal(number, partition.high))
                rows = batch.filter(wanted)
                if rows.num_rows:
                    yield rows

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class AcceptedMessages(DataSource):
    """spark.readStream.format("accepted_messages").option("path", log).option("bound", n)"""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "number bigint, value string"

    def streamReader(self, schema: T.StructType) -> AcceptedReader:
        return AcceptedReader(self.options["path"], int(self.options.get("bound", MAX_ACCEPTED)))


def stream_accepted(spark: SparkSession, path: str, bound: int = MAX_ACCEPTED) -> DataFrame:
    """The log as a stream of (number, value). With Trigger.AvailableNow one run takes at most `bound` messages and the next one goes on from there."""
    spark.dataSource.register(AcceptedMessages)
    return spark.readStream.format(SOURCE).option("path", path).option("bound", bound).load()
