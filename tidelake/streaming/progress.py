"""Progress of a streaming query as rows, and the backlog verdict."""

from __future__ import annotations

import json
import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelake.sources.tables import read_or_empty

SCHEMA = (
    "batch_id long, input_rows long, input_rows_per_second double, processed_rows_per_second double,"
    " batch_duration_ms long, state_rows long, state_updated_rows long, state_removed_rows long,"
    " state_memory_bytes long, rows_dropped_by_watermark long"
)
STATE_FIELDS = (
    "numRowsTotal",
    "numRowsUpdated",
    "numRowsRemoved",
    "memoryUsedBytes",
    "numRowsDroppedByWatermark",
)


def _row(progress: Any) -> tuple:
    report = json.loads(progress.json)
    states = report.get("stateOperators") or []
    totals = [sum(int(s.get(field, 0)) for s in states) for field in STATE_FIELDS]
    return (
        int(report["batchId"]),
        int(report.get("numInputRows", 0)),
        float(report.get("inputRowsPerSecond", 0.0)),
        float(report.get("processedRowsPerSecond", 0.0)),
        int(report.get("durationMs", {}).get("triggerExecution", 0)),
        *totals,
    )


def progress_df(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch; Spark keeps a fixed number of them (see :class:`ProgressLog` for all).

    State is summed over operators.
    """
    return spark.createDataFrame([_row(p) for p in query.recentProgress], SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Writes every batch of every query of the session to a folder, however long they run.

    Reports wait in memory until there are ``rows_per_file`` of them, or until a query ends or the log is
    left; they are then written as one file. A driver that is lost takes with it what waits.

    Spark reports in the background: :meth:`rows` waits for a query's end before it reads.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 500) -> None:
        self.spark, self.path, self.rows_per_file = spark, path, rows_per_file
        self._ended: dict[str, threading.Event] = {}
        self._waiting: list[tuple] = []
        self._lock = threading.Lock()

    def _end(self, run_id: Any) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def flush(self) -> None:
        """Write what waits."""
        with self._lock:
            rows, self._waiting = self._waiting, []
        if rows:
            made = self.spark.createDataFrame(rows, f"run_id string, {SCHEMA}")
            made.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event: Any) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event: Any) -> None:
        with self._lock:
            self._waiting.append((str(event.progress.runId), *_row(event.progress)))
            full = len(self._waiting) >= self.rows_per_file
        if full:
            self.flush()

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self.flush()
        self._end(event.runId).set()

    def rows(self, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """All batches of a query that has ended."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError("the query has not ended")
        return read_or_empty(self.spark, self.path, f"run_id string, {SCHEMA}").filter(F.col("run_id") == str(query.runId))


def classify_progress(df: DataFrame, trigger_seconds: float, duration_ms: str = "batch_duration_ms") -> DataFrame:
    """FALLING_BEHIND when a batch took longer than the trigger interval, else KEEPING_UP."""
    behind = F.col(duration_ms) > F.lit(trigger_seconds * 1000)
    return df.withColumn("status", F.when(behind, "FALLING_BEHIND").otherwise("KEEPING_UP"))
