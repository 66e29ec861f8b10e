"""What a stream's run read and did, batch by batch."""

from __future__ import annotations

import threading
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..plans.ingest import IngestResult

REPORT_ROWS = 50


class ProgressListener(StreamingQueryListener):
    """Collects the progress of every query until it ends."""

    def __init__(self) -> None:
        self._progress: dict[str, list[dict]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, query_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(query_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.id)).clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self._progress.setdefault(str(p.id), []).append({"batch_id": p.batchId, "input_rows": p.numInputRows, "millis": p.batchDuration})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.id)).set()

    def progress_of(self, query_id: str, wait: float = 30.0) -> list[dict]:
        """All progress of a query that has ended; events come a little later than the end."""
        self._end_of(query_id).wait(wait)
        with self._lock:
            return list(self._progress.pop(query_id, []))


@dataclass(frozen=True)
class BatchCounts:
    """One micro-batch: messages read and skipped, contract rows refused and staged, objects made and changed."""

    stream: str
    batch_id: int
    messages: int
    skipped: int
    alerts: int
    rejected: int
    staged: int
    created: int
    updated: int

    @classmethod
    def of(cls, stream: str, batch_id: int, seen: dict, contract: DataFrame, result: IngestResult) -> "BatchCounts":
        alerts = contract.count()
        staged, created = result.resolution.n_rows, result.resolution.n_new
        return cls(stream, batch_id, seen["messages"], seen["skipped"], alerts, alerts - staged, staged, created, result.updated.count())


@dataclass
class StreamReport:
    """A stream's batches with Spark's progress, and the newest alerts of each."""

    stream: str
    counts: list[BatchCounts] = field(default_factory=list)
    progress: list[dict] = field(default_factory=list)
    shown: list[DataFrame] = field(default_factory=list)

    def add(self, counts: BatchCounts, result: IngestResult) -> None:
        self.counts.append(counts)
        self.shown.append(result.staged.orderBy(F.desc("jdmax"), "native_id").limit(REPORT_ROWS).select("native_id", "ra", "dec", "jdmax", "object_id"))

    def rows(self) -> list[dict]:
        """One row a batch; a batch without progress (the query broke) has none."""
        known = {p["batch_id"]: p for p in self.progress}
        return [asdict(c) | {"input_rows": known.get(c.batch_id, {}).get("input_rows"), "millis": known.get(c.batch_id, {}).get("millis")} for c in self.counts]

    def text(self) -> str:
        """The report as Markdown: the counts of each batch and at most REPORT_ROWS of its newest alerts."""
        lines = [f"# Stream {self.stream}"]
        for row, frame in zip(self.rows(), self.shown):
            lines += ["", f"## Batch {row['batch_id']}", "", ", ".join(f"{k}: {v}" for k, v in row.items() if k not in ("stream", "batch_id")), ""]
            shown = frame.collect()
            if shown:
                lines += ["| " + " | ".join(frame.columns) + " |", "|" + "---|" * len(frame.columns)]
                lines += ["| " + " | ".join(str(v) for v in r) + " |" for r in shown]
        if not self.counts:
            lines += ["", "_Nothing came._"]
        return "\n".join(lines)


def report_table(spark: SparkSession, reports: list[StreamReport]) -> DataFrame:
    """All batches of a run as a table."""
    rows = [tuple(r.values()) for report in reports for r in report.rows()]
    kinds = ", ".join(f"{f.name} {'string' if f.name == 'stream' else 'bigint'}" for f in fields(BatchCounts))
    return spark.createDataFrame(rows, f"{kinds}, input_rows bigint, millis bigint")
