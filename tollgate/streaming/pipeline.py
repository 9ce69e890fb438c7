"""Structured Streaming pipelines.

* ``run_user_stream``: topic -> decode -> per micro-batch: malformed rows to
  dead letters, the rest upserted into the change-log table (F1, F3).
* ``run_ingest_stream``: landed responses or fetches -> route -> accepted users published
  to the user topic, rejected rows to the dead-letter topic, transient failures to the retry queue (F4).
* ``run_retry_round``: fetches that are due again, routed like fresh ones (B13).
* ``run_dlq_stats_stream``: dead letters -> statistics kept current (F5).

Topics are Kafka topics or folders of Kafka-shaped rows, so F1 reads what F4
publishes and A8 reads the dead letters of both.  Every ``foreachBatch``
persists its batch once, writes both sinks from it, and unpersists in
``finally``.  A failed batch is retried by Spark with the same batch id; all
file writes go to that id's own folder, so the retry replaces rather than
duplicates (at-least-once delivery, idempotent result).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tollgate.operators import deadletters as D
from tollgate.operators.contracts import USER_COLUMNS
from tollgate.operators.fetches import RETRY_SCHEMA, RetryPolicy, fetch_letters, fetch_retries, route_fetches
from tollgate.operators.route import is_replayable, route
from tollgate.sources import due_queue as Q
from tollgate.sources import messages as M
from tollgate.sources import sinks as S

# One telemetry row per micro-batch; ``query`` and ``batch_id`` are the
# folder keys (query=<q>/batch_id=<n>), the file holds the measurements.
BATCH_LOG_SCHEMA = "rows BIGINT, written BIGINT, rejected BIGINT, seconds DOUBLE"


@dataclass
class StreamPaths:
    table: str  # change log of the keyed user table; F4: the user topic
    dead_letters: str
    checkpoint: str
    batch_log: str | None = None  # E9 telemetry, one row per micro-batch
    retries: str | None = None  # queue of fetches that are due again


def _log_batch(spark: SparkSession, paths: StreamPaths, query: str, batch_id: int, rows: int, written: int, rejected: int, secs: float):
    """One telemetry row per micro-batch, keyed by batch id (replay-safe)."""
    if not paths.batch_log:
        return
    row = spark.createDataFrame([(rows, written, rejected, secs)], BATCH_LOG_SCHEMA)
    row.write.mode("overwrite").parquet(f"{paths.batch_log.rstrip('/')}/query={query}/batch_id={int(batch_id)}")


def _utc_now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds").replace("+00:00", "Z")


def _start(stream_df: DataFrame, fn: Callable, checkpoint: str, available_now: bool, processing_time: str | None, name: str):
    w = stream_df.writeStream.queryName(name).foreachBatch(fn).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_user_stream(spark: SparkSession, source: M.MessageSource, paths: StreamPaths, available_now: bool = True,
                    processing_time: str | None = None, timeout: float | None = None,
                    on_batch: Callable[[DataFrame, int], None] | None = None, now: str | None = None,
                    dead_letter_format: str = "parquet", redelivery: str | None = None, name: str = "users"):
    """endless (or ``availableNow`` / time-bounded) user stream.

    Offsets live in the checkpoint; a restart resumes after the last
    committed batch.  ``timeout`` bounds the run (F2): wait, then stop.  Dead
    letters carry the message as it came and ``now``, or the time of their batch.

    ``redelivery`` (a length of time) keeps messages that a topic hands out twice within it from counting twice:
    a message is known by topic, partition and offset.  Messages older than the newest one by more than that are
    dropped then, and counted as late in the progress log; without it every delivery counts, the table alone is the same.
    """
    raw = M.read_message_stream(spark, source)
    if redelivery:
        raw = raw.withWatermark("timestamp", redelivery).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])
    decoded = M.decode_messages(raw, keep=("partition", "offset", "timestamp", "value"))

    def write_batch(batch: DataFrame, batch_id: int):
        t0 = time.time()
        at = now or _utc_now()
        batch = batch.persist()
        try:
            kept, gone = Observation(f"kept_{int(batch_id)}"), Observation(f"gone_{int(batch_id)}")
            good = S.with_order(M.wellformed_messages(batch).drop("value")).observe(kept, F.count(F.lit(1)).alias("n"))
            text = M.message_text()
            bad = M.malformed_messages(batch).select(
                text.alias("original_message"),
                F.lit("DecodeError").alias("error_type"),
                F.lit("message could not be decoded or has no id").alias("error_message"),
                F.lit(at).alias("timestamp"),
                D.retries_so_far(text).alias("retry_count"),
                F.lit(source.topic).alias("source_topic"),
            ).observe(gone, F.count(F.lit(1)).alias("n"))
            written = S.upsert_users(good, batch_id, paths.table)
            S.write_dead_letters(bad, dead_letter_format, paths.dead_letters, batch_id, now=at)
            if on_batch:
                on_batch(batch, batch_id)
            rejected = int(gone.get["n"])
            _log_batch(spark, paths, "users", batch_id, int(kept.get["n"]) + rejected, written, rejected, time.time() - t0)
        finally:
            batch.unpersist()

    q = _start(decoded, write_batch, paths.checkpoint, available_now, processing_time, name)
    _finish(q, timeout)
    return q


def run_ingest_stream(spark: SparkSession, landed_path: str, paths: StreamPaths, now: str | None = None,
                      fmt: str = "json", available_now: bool = True, processing_time: str | None = None,
                      timeout: float | None = None, on_batch: Callable[[DataFrame, int], None] | None = None,
                      max_files: int | None = None, topic: str = "user_data", topic_format: str = "parquet",
                      normalize_first: bool = False, policy: RetryPolicy | None = None, name: str = "ingest"):
    """landed responses -> route -> accepted users + dead letters.

    Accepted rows are published to the user topic (JSON keyed by id, in the
    order of the responses), rejected rows to the dead-letter topic, both from
    one persisted routed batch.  ``max_files`` bounds what one micro-batch takes
    in.  Dead letters carry ``now``, or the time of their batch.

    The rows are bodies by ``response_id``.  With a ``policy`` they are A3's landed fetches
    instead, failed ones among them (C8): transient failures go to the queue
    ``paths.retries`` until their tries are used up, other failures to the dead letters.
    """
    if policy:
        stream = M.read_landed_responses(spark, landed_path, fmt, stream=True, max_files=max_files)
    else:
        reader = spark.readStream.format(fmt).schema("response_id BIGINT, body STRING")
        stream = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(landed_path)

    def write_batch(batch: DataFrame, batch_id: int):
        t0 = time.time()
        if policy:
            routed = route_fetches(batch, policy, normalize_first).persist()
        else:
            routed = route(batch, normalize_first=normalize_first).withColumnRenamed("response_id", "fetch_id")
            routed = routed.withColumn("sink", F.when(F.col("stage") == "accepted", "accepted").otherwise("dead_letter")).persist()
        try:
            written, rejected, deferred = _write_routed(routed, paths, batch_id, now or _utc_now(), topic, topic_format, policy)
            if on_batch:
                on_batch(routed, batch_id)
            _log_batch(spark, paths, "ingest", batch_id, written + rejected + deferred, written, rejected, time.time() - t0)
        finally:
            routed.unpersist()

    q = _start(stream, write_batch, paths.checkpoint, available_now, processing_time, name)
    _finish(q, timeout)
    return q


def _write_routed(routed: DataFrame, paths: StreamPaths, batch_id: int, now: str, topic: str, topic_format: str, policy: RetryPolicy | None):
    """Each row of a persisted routed batch to its sink; the numbers accepted, dead and deferred.

    All three writes replace what the same batch id has written before.
    """
    sent, gone, later = (Observation(f"{n}_{uuid.uuid4().hex}") for n in ("sent", "gone", "later"))
    n = F.count(F.lit(1)).alias("n")
    acc = routed.where(F.col("sink") == "accepted").select("fetch_id", "user.*").observe(sent, n)
    published = S.publish_messages(acc, topic, "id", columns=USER_COLUMNS, keep=("fetch_id",))
    S.write_messages(published, topic_format, paths.table, batch_id, offset="fetch_id", now=now)
    letters = (fetch_letters(routed, now, topic) if policy else D.to_dead_letters(routed, now, topic)).observe(gone, n)
    S.write_dead_letters(letters, topic_format, paths.dead_letters, batch_id, now=now)
    if not policy:
        return int(sent.get["n"]), int(gone.get["n"]), 0
    Q.enqueue(fetch_retries(routed).observe(later, n), paths.retries, batch_id)
    return int(sent.get["n"]), int(gone.get["n"]), int(later.get["n"])


# Rounds of retries write to the same sinks as the stream, under batch ids of their own: the upper half.
FIRST_ROUND = 1 << (S.BATCH_BITS - 1)


def run_retry_round(spark: SparkSession, paths: StreamPaths, claims: str, round_id: int, now: str,
                    fetch: Callable[[DataFrame], DataFrame], policy: RetryPolicy = RetryPolicy(), topic: str = "user_data",
                    topic_format: str = "parquet", normalize_first: bool = False) -> tuple[int, int, int]:
    """Fetch again what is due at ``now`` and route it like a fresh fetch.

    ``fetch`` gets (fetch_id, attempt) of the next tries and returns landed fetches (A3's columns) with the
    same ids and attempts.  The round is settled last: one that fails is run again under its id, takes the same rows and
    replaces what it had written.  Returns the numbers accepted, dead and deferred once more.
    """
    t0 = time.time()
    batch_id = FIRST_ROUND + int(round_id)
    due = Q.claim(spark, paths.retries, claims, round_id, now, RETRY_SCHEMA, below_batch=batch_id)
    landed = fetch(due.select("fetch_id", (F.col("attempt") + 1).alias("attempt")))
    routed = route_fetches(landed, policy, normalize_first).persist()
    try:
        written, rejected, deferred = _write_routed(routed, paths, batch_id, now, topic, topic_format, policy)
        Q.settle(spark, claims, round_id)
        _log_batch(spark, paths, "retries", batch_id, written + rejected + deferred, written, rejected, time.time() - t0)
    finally:
        routed.unpersist()
    return written, rejected, deferred


def run_dlq_stats_stream(spark: SparkSession, source: M.MessageSource, out_path: str, checkpoint: str,
                         available_now: bool = True, processing_time: str | None = None, timeout: float | None = None,
                         name: str = "dlq_stats"):
    """D3 and D4 kept current, one row per error type.

    A streaming aggregation (state store keyed by error type) in ``complete``
    mode.  Each batch writes its own folder, which ``dlq_stats_now`` finds once
    it is complete, so a failed write leaves the state before.
    """
    decoded = M.read_dead_letters(M.read_message_stream(spark, source)).where("readable")
    again = is_replayable(F.col("error_type"), F.col("retry_count"))
    counts = decoded.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(again).alias("replayable"), F.min(D.iso_timestamp(F.col("timestamp"))).alias("oldest")
    )

    def write_batch(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/upto={int(batch_id)}")

    w = counts.writeStream.queryName(name).outputMode("complete").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else (w.trigger(processingTime=processing_time) if processing_time else w)
    q = w.start()
    _finish(q, timeout)
    return q


DLQ_STATS_SCHEMA = "error_type STRING, n BIGINT, replayable BIGINT, oldest TIMESTAMP"


def dlq_stats_now(spark: SparkSession, out_path: str) -> DataFrame:
    """the newest complete counts by error type; no rows before the first batch."""
    upto = S.compacted_upto(spark, out_path)
    if upto is None:
        return spark.createDataFrame([], DLQ_STATS_SCHEMA)
    return spark.read.schema(DLQ_STATS_SCHEMA).parquet(f"{out_path.rstrip('/')}/upto={upto}")


def dlq_totals(stats: DataFrame, now: str) -> DataFrame:
    """D3's row of totals from F5's counts by error type."""
    hours = (F.unix_micros(F.to_timestamp(F.lit(now))) - F.unix_micros(F.min("oldest"))).cast("double") / 3_600_000_000
    total, again = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "replayable"))
    return stats.agg(
        total.alias("total_messages"),
        again.alias("retryable_count"),
        (total - again).alias("non_retryable_count"),
        F.round(F.greatest(F.coalesce(hours, F.lit(0.0)), F.lit(0.0)), 2).alias("oldest_message_hours"),
    )


def _finish(q, timeout: float | None):
    """Wait for an ``availableNow`` run, or stop after ``timeout`` (F2)."""
    if timeout is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout)
        q.stop()
    if q.exception() is not None:
        raise q.exception()


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """The per-batch telemetry table; ``rows`` came in, ``written`` are the rows of the
    sink (one per id in F1), ``rejected`` the dead letters."""
    return spark.read.parquet(path).select("query", F.col("batch_id").cast("long"), "rows", "written", "rejected", "seconds")


def batch_totals(log: DataFrame) -> DataFrame:
    """E3 from the batch log: batches and records of each stream."""
    return log.groupBy("query").agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in ("rows", "written", "rejected")])
