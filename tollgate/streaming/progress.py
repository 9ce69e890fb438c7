"""E9 from query progress: one row for each micro-batch of every watched stream, whatever its sink.

A listener gets Spark's own progress reports (rows, rates, offsets, time by phase, watermark, rows that came
too late) and writes each to ``query=<name>/batch_id=<n>``, so a batch that runs again replaces its row.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = (
    "at STRING, input_rows BIGINT, input_rate DOUBLE, processed_rate DOUBLE, watermark STRING, late_rows BIGINT, state_rows BIGINT, "
    "phases MAP<STRING, BIGINT>, offsets ARRAY<STRUCT<source: STRING, from: STRING, to: STRING>>"
)


def progress_row(report: dict) -> tuple:
    """A progress report (its JSON as a dict) as a row of ``PROGRESS_SCHEMA``.

    ``late_rows`` adds up what all stateful operators dropped for the watermark.
    """
    state = report.get("stateOperators") or []

    def text(x) -> str | None:
        return x if x is None or isinstance(x, str) else json.dumps(x, sort_keys=True)

    return (
        report.get("timestamp"),
        int(report.get("numInputRows") or 0),
        float(report.get("inputRowsPerSecond") or 0.0),
        float(report.get("processedRowsPerSecond") or 0.0),
        (report.get("eventTime") or {}).get("watermark"),
        sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in state),
        sum(int(s.get("numRowsTotal") or 0) for s in state),
        {k: int(v) for k, v in (report.get("durationMs") or {}).items()},
        [(s.get("description"), text(s.get("startOffset")), text(s.get("endOffset"))) for s in report.get("sources") or []],
    )


class ProgressLog(StreamingQueryListener):
    """Writes the progress of streams to ``path``.  Streams without a name go under their id."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: dict[str, threading.Event] = {}
        self.failures: list[Exception] = []

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        if "addBatch" not in (report.get("durationMs") or {}):
            return  # an idle look for new data, no batch
        try:
            row = self.spark.createDataFrame([progress_row(report)], PROGRESS_SCHEMA)
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/query={report.get('name') or report['id']}/batch_id={report['batchId']}")
        except Exception as e:  # a listener must not throw; ``watched`` does
            self.failures.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, timeout: float = 60.0) -> None:
        """Until every stream that started has ended and its reports are written."""
        for done in list(self.ended.values()):
            if not done.wait(timeout):
                raise TimeoutError("a stream's reports have not all come")
        if self.failures:
            raise self.failures[0]


@contextmanager
def watched(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """Within the block the progress of all streams of the session is written to ``path``."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
        log.wait()
    finally:
        spark.streams.removeListener(log)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The written reports; (query, batch_id) is their key."""
    return spark.read.schema(f"{PROGRESS_SCHEMA}, query STRING, batch_id BIGINT").parquet(path)


def progress_totals(log: DataFrame) -> DataFrame:
    """Batches, rows, late rows and seconds of each stream, with its slowest batch."""
    seconds = F.col("phases")["triggerExecution"] / 1000
    return log.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("rows"),
        F.sum("late_rows").alias("late_rows"),
        F.sum(seconds).alias("seconds"),
        F.max(seconds).alias("slowest"),
    )
