"""B13's waiting room: a table of rows that are due later, claimed in rounds.

Rows lie in ``batch=<n>/due_hour=<yyyyMMddHH>``, each batch in its own folder, so a batch that
runs again replaces its rows.  A claim reads only hours up to its own (partition pruning) and takes
what is due and not taken yet, of the partitions that it found.  What was taken is known by partition, not by row: a partition is written
once, so "everything due up to then" says it all.  ``settle`` writes that state to the claim's own folder after
the claimed rows have been dealt with; a claim that fails before is made again and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLAIM_SCHEMA = "batch BIGINT, due_hour BIGINT, upto TIMESTAMP_NTZ"


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def hour_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHH").cast("long")


def newest_complete(spark: SparkSession, path: str, key: str, below: int | None = None) -> int | None:
    """The largest n of the complete folders ``key=<n>`` in ``path`` (below a bound); None if there is none."""
    jpath, fs = _path(spark, f"{path.rstrip('/')}/{key}=*/_SUCCESS")
    found = [int(f.getPath().getParent().getName().split("=")[1]) for f in fs.globStatus(jpath) or []]
    return max((n for n in found if below is None or n < below), default=None)


def enqueue(rows: DataFrame, path: str, batch: int) -> None:
    """Write ``rows``, which have a timestamp ``due`` without zone, as the queue's batch ``batch``."""
    out = rows.withColumn("due_hour", hour_of(F.col("due")))
    out.write.mode("overwrite").partitionBy("due_hour").parquet(f"{path.rstrip('/')}/batch={int(batch)}")


def queued(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Every row ever put into the queue, with ``batch`` and ``due_hour``; no rows if there is no queue yet."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*fields.fields, T.StructField("batch", T.LongType()), T.StructField("due_hour", T.LongType())])
    jpath, fs = _path(spark, path)
    if not fs.exists(jpath):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def _state(spark: SparkSession, claims: str, key: str, n: int | None) -> DataFrame:
    if n is None:
        return spark.createDataFrame([], CLAIM_SCHEMA)
    return spark.read.schema(CLAIM_SCHEMA).parquet(f"{claims.rstrip('/')}/{key}={int(n)}")


def taken(spark: SparkSession, claims: str, below: int | None = None) -> DataFrame:
    """How far each partition has been claimed by the newest settled claim (before claim ``below``)."""
    return _state(spark, claims, "claim", newest_complete(spark, claims, "claim", below))


def claim(spark: SparkSession, path: str, claims: str, claim_id: int, now: str, schema: T.StructType | str,
          below_batch: int | None = None) -> DataFrame:
    """Rows due at ``now`` that no earlier settled claim has taken, of batches before ``below_batch`` if given.

    The partitions in reach are written down first, so the same ``claim_id`` gives the same rows again,
    whatever is added meanwhile; what is added later waits for the next claim.
    """
    waiting = queued(spark, path, schema)
    if newest_complete(spark, claims, "plan", claim_id + 1) != claim_id:
        at = F.to_timestamp_ntz(F.lit(now))
        reached = waiting.where(F.col("due_hour") <= hour_of(at))
        if below_batch is not None:
            reached = reached.where(F.col("batch") < below_batch)
        reached = reached.select("batch", "due_hour").distinct().withColumn("upto", at)
        reached.write.mode("overwrite").parquet(f"{claims.rstrip('/')}/plan={int(claim_id)}")
    plan = _state(spark, claims, "plan", claim_id).withColumnRenamed("upto", "_now")
    before = taken(spark, claims, claim_id)
    rows = waiting.join(plan, ["batch", "due_hour"]).where(F.col("due") <= F.col("_now")).join(before, ["batch", "due_hour"], "left")
    return rows.where(F.col("upto").isNull() | (F.col("due") > F.col("upto"))).select(*waiting.columns)


def settle(spark: SparkSession, claims: str, claim_id: int) -> None:
    """Record that all that claim ``claim_id`` took has been dealt with: one row for each partition."""
    state = _state(spark, claims, "plan", claim_id).unionByName(taken(spark, claims, claim_id))
    state = state.groupBy("batch", "due_hour").agg(F.max("upto").alias("upto"))
    state.write.mode("overwrite").parquet(f"{claims.rstrip('/')}/claim={int(claim_id)}")


def drop_taken(spark: SparkSession, path: str, claims: str) -> int:
    """Delete the queue's partitions whose hour the last claim but one had already passed; their number.

    The newest claim can still be made again, as all its rows stay.
    """
    newest = newest_complete(spark, claims, "claim")
    done = taken(spark, claims, newest) if newest is not None else spark.createDataFrame([], CLAIM_SCHEMA)
    gone = 0
    for r in done.where(hour_of(F.col("upto")) > F.col("due_hour")).select("batch", "due_hour").toLocalIterator():
        jpath, fs = _path(spark, f"{path.rstrip('/')}/batch={r['batch']}/due_hour={r['due_hour']}")
        gone += fs.delete(jpath, True)
    return gone
