"""Sinks and the keyed user table.

The keyed store is a change log: each micro-batch is de-duplicated by id
(last write wins) and written to its own ``batch_id=<n>`` folder with
``overwrite``, so a replayed batch replaces itself instead of adding rows.
Readers see "latest row per id" through ``current_users``.  Compaction
writes a NEW folder (never overwrites a path it is reading).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.jsonout import message_json
from tollgate.operators.contracts import USER_COLUMNS

ORDER_COLS = ("_ts", "_partition", "_offset")
# Bits of a file topic's offset: batch, task in the batch, row of the task.
BATCH_BITS, TASK_BITS, ROW_BITS = 23, 15, 25


def publish_messages(df: DataFrame, topic: str, key: str | Column | None = None,
                     columns: tuple[str, ...] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A4: rows -> Kafka sink shape (key, value, topic), and the columns in ``keep``.

    ``value`` is the JSON text of the row (nulls kept), ``key`` the given
    column as text (R14: publish with key = id so one id stays in one
    partition), ``topic`` the default topic.
    """
    cols = columns or tuple(df.columns)
    k = F.col(key) if isinstance(key, str) else key
    return df.select(
        (k.cast("string").cast("binary") if k is not None else F.lit(None).cast("binary")).alias("key"),
        message_json(*cols).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        *keep,
    )


def topic_rows(published: DataFrame, batch_id: int, offset: str | None = None, now: str | None = None,
               partitions: int = 3) -> DataFrame:
    """A published frame with the columns of Spark's Kafka source, for topics kept as files.

    Rows of one key share a partition.  ``offset`` names a column that orders the
    rows; otherwise offsets rise with the batch, the task and the row's place in it, so that
    (partition, offset) is unique; more batches, tasks or rows than the offset has bits for raise.
    ``timestamp`` is ``now`` (ISO text) or the time of the write.
    """
    place = F.monotonically_increasing_id()
    task, row = F.shiftright(place, 33), place.bitwiseAND((1 << 33) - 1)
    partition = F.when(F.col("key").isNull(), task).otherwise(F.pmod(F.xxhash64("key"), F.lit(partitions)))
    if not 0 <= int(batch_id) < 1 << BATCH_BITS:
        raise ValueError(f"batch ids have {BATCH_BITS} bits")
    own = F.lit(int(batch_id) << (TASK_BITS + ROW_BITS)) + F.shiftleft(task, ROW_BITS) + row
    fits = (task < 1 << TASK_BITS) & (row < 1 << ROW_BITS)
    own = F.when(fits, own).otherwise(F.raise_error(F.lit("too many tasks or rows in a batch")).cast("long"))
    return published.select(
        "key",
        "value",
        "topic",
        partition.cast("int").alias("partition"),
        (F.col(offset) if offset else own).cast("long").alias("offset"),
        (F.to_timestamp(F.lit(now)) if now else F.current_timestamp()).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_messages(published: DataFrame, fmt: str, path_or_servers: str, batch_id: int = 0,
                   offset: str | None = None, now: str | None = None) -> None:
    """Write a published frame to Kafka (``fmt='kafka'``) or to a topic kept as files.

    Files go to the batch's own folder and replace what it held, so a repeated
    batch does not repeat its messages.  A failure is raised: in a stream Spark
    then runs the batch again, while a message passed over would be lost.
    """
    if fmt == "kafka":
        published.select("key", "value", "topic").write.format("kafka").option("kafka.bootstrap.servers", path_or_servers).save()
    else:
        rows = topic_rows(published, batch_id, offset, now)
        rows.write.mode("overwrite").format(fmt).save(f"{path_or_servers.rstrip('/')}/batch_id={int(batch_id)}")


def with_order(df: DataFrame, ts: str = "timestamp", partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Carry the source order (timestamp, partition, offset) as change-log columns."""
    return df.withColumnsRenamed({ts: "_ts", partition: "_partition", offset: "_offset"})


def latest_per_id(df: DataFrame, key: str | tuple[str, ...] = "id", columns: tuple[str, ...] = USER_COLUMNS) -> DataFrame:
    """Last write wins: per key the row with the largest (ts, partition, offset).

    ``max_by`` over a struct: partial aggregation on the map side, one
    shuffle by key; a hot key is reduced to one row per task before the
    shuffle, so skew never sends all its rows to one task.
    """
    keys = (key,) if isinstance(key, str) else key
    payload = F.struct(*[c for c in columns if c not in keys], *ORDER_COLS)
    order = F.struct(*ORDER_COLS)
    best = df.groupBy(*keys).agg(F.max_by(payload, order).alias("_r"))
    return best.select(*keys, "_r.*")


def upsert_users(batch_df: DataFrame, batch_id: int, path: str) -> int:
    """A5: append one micro-batch to the change log, replay-safe.

    In-batch de-duplication first, then ``overwrite`` of ``batch_id=<n>``.
    Returns the number of rows written (counted by ``observe``, one pass).
    """
    from pyspark.sql import Observation

    obs = Observation(f"upsert_{batch_id}")
    deduped = latest_per_id(batch_df).observe(obs, F.count(F.lit(1)).alias("rows"))
    deduped.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}")
    return int(obs.get.get("rows", 0))


def current_users(spark: SparkSession, path: str, compacted: str | None = None) -> DataFrame:
    """The table as a reader sees it: latest row per id over all batches.

    With ``compacted``, a folder that ``compact_users`` fills, only its newest
    state and the batches after it are read.
    """
    log_df = spark.read.parquet(path)
    upto = compacted_upto(spark, compacted) if compacted else None
    if upto is not None:
        newer = log_df.where(F.col("batch_id") > upto).drop("batch_id")
        log_df = newer.unionByName(spark.read.parquet(f"{compacted.rstrip('/')}/upto={upto}"))
    return latest_per_id(log_df).select(*USER_COLUMNS)


def compacted_upto(spark: SparkSession, compacted: str) -> int | None:
    """The last batch that the newest complete state in ``compacted`` holds; None if there is none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{compacted.rstrip('/')}/upto=*/_SUCCESS")
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath) or []
    return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=None)


def compact_users(spark: SparkSession, path: str, compacted: str) -> int:
    """Write the state after the change log's last batch to its own folder ``upto=<n>``.

    Starts from the newest state there is, never overwrites what it reads, and a
    failed run leaves no ``_SUCCESS``, so readers keep to the state before.
    """
    log_df = spark.read.parquet(path)
    last = log_df.agg(F.max("batch_id")).first()[0]
    upto = compacted_upto(spark, compacted)
    if upto is not None:
        log_df = log_df.where(F.col("batch_id") > upto)
    state = log_df.drop("batch_id")
    if upto is not None:
        state = state.unionByName(spark.read.parquet(f"{compacted.rstrip('/')}/upto={upto}"))
    if upto != last:
        latest_per_id(state).write.mode("overwrite").parquet(f"{compacted.rstrip('/')}/upto={int(last)}")
    return int(last)


def write_dead_letters(df: DataFrame, fmt: str, path_or_servers: str, batch_id: int = 0,
                       topic: str = "user_data_dlq", now: str | None = None) -> None:
    """Dead letters as messages of their topic, which A8 reads; see ``write_messages``."""
    write_messages(publish_messages(df, topic), fmt, path_or_servers, batch_id, now=now)


USERS_DDL_COLUMNS = ", ".join(f"{c} STRING" for c in USER_COLUMNS)


def table_conflicts(spark: SparkSession, name: str) -> list[str]:
    """Where the catalog's table ``name`` departs from the user contract; columns beside it are allowed."""
    found = {f.name.lower(): f.dataType.simpleString() for f in spark.table(name).schema}
    missing = [f"{c}: missing" for c in USER_COLUMNS if c.lower() not in found]
    other = [f"{c}: {found[c.lower()]} instead of string" for c in USER_COLUMNS if found.get(c.lower(), "string") != "string"]
    return missing + other


def ensure_users_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Create the user table if missing (idempotent); returns it.

    A table of that name whose columns conflict with the contract is an error, found before
    anything is written to it; it may have columns of its own.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({USERS_DDL_COLUMNS}) USING parquet LOCATION '{location}'")
    conflicts = table_conflicts(spark, name)
    if conflicts:
        raise ValueError(f"table {name} does not fit the user contract: {'; '.join(conflicts)}")
    return spark.table(name)
