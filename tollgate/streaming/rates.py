"""E4 and E5 as a running stream: windows come out once the watermark has passed their end.

Events are told apart by their key, so one that is delivered twice counts once.  An event whose time lies before the
watermark that the batch before had reached is dropped, row by row, and counted: ``late_rows`` of the progress log
(``streaming.progress``).
Each micro-batch writes the windows it closed to its own folder, which a batch that runs again replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.telemetry import TS_FORMAT, dead_letter_percent, interval_micros
from tollgate.streaming.pipeline import _finish

WINDOW_SCHEMA = "series STRING, window_start TIMESTAMP, n BIGINT, batch_id BIGINT"


def run_rate_stream(log: DataFrame, out_path: str, checkpoint: str, window: str = "1 minute", slide: str | None = "15 seconds",
                    delay: str = "10 minutes", key: str = "event_id", ts: str = "ts", name: str = "rates", available_now: bool = True,
                    processing_time: str | None = None, timeout: float | None = None):
    """Count the streamed ``log`` by series and window; ``delay`` is how late an event may come.

    State holds the keys of the last ``delay`` and the open windows, whatever the stream's length.
    """
    events = log.select(F.col(key).alias("_key"), "series", F.col(ts).cast("timestamp").alias("_ts"))
    events = events.withWatermark("_ts", delay).dropDuplicatesWithinWatermark(["_key"])
    w = F.window("_ts", window, slide) if slide else F.window("_ts", window)
    closed = events.groupBy("series", w.alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    closed = closed.select("series", F.col("_w.start").alias("window_start"), "n")

    def write_batch(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={int(batch_id)}")

    q = closed.writeStream.queryName(name).outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else (q.trigger(processingTime=processing_time) if processing_time else q)
    q = q.start()
    _finish(q, timeout)
    return q


def closed_windows(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(WINDOW_SCHEMA).parquet(out_path).drop("batch_id")


def rates_now(spark: SparkSession, out_path: str, window: str = "1 minute") -> DataFrame:
    """E4 over the windows that are closed."""
    return closed_windows(spark, out_path).select(
        "series",
        F.date_format("window_start", TS_FORMAT).alias("window_start"),
        "n",
        (F.col("n") / F.lit(interval_micros(window) / 1_000_000)).alias("rate"),
    )


def shares_now(spark: SparkSession, out_path: str) -> DataFrame:
    """E5 over the windows that are closed."""
    dlq, sent = (F.coalesce(F.sum(F.when(F.col("series") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("dlq", "sent"))
    g = closed_windows(spark, out_path).groupBy("window_start").agg(dlq, sent)
    return g.select(F.date_format("window_start", TS_FORMAT).alias("window_start"), "dlq", "sent", dead_letter_percent().alias("dlq_percent"))
