"""The keyed user table as a bucketed state (A6): merged without shuffling the state, looked up by one bucket.

A state lies in ``<folder>/buckets=<b>/upto=<n>``: what the change log says after batch n, one row for
each id, in ``b`` buckets by id with one file each.  Compaction joins the newest state with the batches
after it.  Only those batches are shuffled, into the state's own buckets, so the cost of a shuffle grows
with what is new and not with the table.  The number of buckets is part of the path, since a reader that
counts them otherwise would look into the wrong files.  The catalog entry is only a name for the folder
and is made again where a session's catalog lacks it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.contracts import USER_COLUMNS
from tollgate.sources.sinks import ORDER_COLS, compacted_upto, latest_per_id

STATE_COLUMNS = (*USER_COLUMNS, *ORDER_COLS)


def _root(folder: str, buckets: int) -> str:
    if buckets < 1:
        raise ValueError("a state has at least one bucket")
    return f"{folder.rstrip('/')}/buckets={int(buckets)}"


def _name(root: str, upto: int) -> str:
    return f"user_state_{hashlib.sha256(root.encode()).hexdigest()[:16]}_{int(upto)}"


def state(spark: SparkSession, folder: str, buckets: int) -> DataFrame | None:
    """The newest complete state, as a scan that knows its buckets; None if there is none."""
    root = _root(folder, buckets)
    upto = compacted_upto(spark, root)
    if upto is None:
        return None
    name = _name(root, upto)
    if not spark.catalog.tableExists(name):
        path = f"{root}/upto={upto}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _newer(spark: SparkSession, path: str, upto: int | None) -> DataFrame:
    """The change log's rows after batch ``upto``; a folder of batches, so older ones aren't opened."""
    log = spark.read.parquet(path)
    return (log if upto is None else log.where(F.col("batch_id") > upto)).drop("batch_id").where("id is not null")


def merged(old: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """Latest row per id of a bucketed state and newer rows; the state is read bucket by bucket, never shuffled.

    ``new`` is reduced to one row per id first (a hot id on the map side) and then dealt into the
    state's buckets.  Of equal (timestamp, partition, offset) the state's row stays: it is the same message.
    """
    rest = [c for c in STATE_COLUMNS if c != "id"]

    def sides(df: DataFrame, row: str, order: str) -> DataFrame:
        return df.select("id", F.struct(*rest).alias(row), F.struct(*ORDER_COLS).alias(order))

    latest = latest_per_id(new).repartition(int(buckets), "id")
    both = sides(old, "old", "old_order").join(sides(latest, "new", "new_order"), "id", "full_outer")
    newer = F.col("old").isNull() | (F.col("new").isNotNull() & (F.col("new_order") > F.col("old_order")))
    return both.select("id", F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")).select("id", "row.*").select(*STATE_COLUMNS)


def compact(spark: SparkSession, path: str, folder: str, buckets: int = 64) -> int:
    """Write the state after the change log's last batch; returns that batch's number.

    Never overwrites what it reads.  A run that fails leaves no ``_SUCCESS``, so readers keep to the
    state before and the next run writes the folder anew.  Rows without an id are no users.
    """
    root = _root(folder, buckets)
    last = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    upto = compacted_upto(spark, root)
    if upto != last:
        new, old = _newer(spark, path, upto), state(spark, folder, buckets)
        rows = merged(old, new, buckets) if old is not None else latest_per_id(new).select(*STATE_COLUMNS).repartition(int(buckets), "id")
        out = rows.write.mode("overwrite").format("parquet").bucketBy(int(buckets), "id").sortBy("id")
        out.option("path", f"{root}/upto={int(last)}").saveAsTable(_name(root, last))
    return int(last)


def users(spark: SparkSession, path: str, folder: str, buckets: int = 64) -> DataFrame:
    """The table as a reader sees it, from the newest state and the batches after it."""
    old = state(spark, folder, buckets)
    new = _newer(spark, path, compacted_upto(spark, _root(folder, buckets)))
    return (merged(old, new, buckets) if old is not None else latest_per_id(new)).select(*USER_COLUMNS)


def lookup(spark: SparkSession, path: str, folder: str, ids: list[str], buckets: int = 64) -> DataFrame:
    """The current rows of a few ids: opens their buckets of the state and, of newer batches, the row groups that may hold them."""
    if not ids:
        raise ValueError("name at least one id")
    old = state(spark, folder, buckets)
    found = _newer(spark, path, compacted_upto(spark, _root(folder, buckets))).where(F.col("id").isin(*ids))
    if old is not None:
        found = found.select(*STATE_COLUMNS).unionByName(old.where(F.col("id").isin(*ids)).select(*STATE_COLUMNS))
    return latest_per_id(found).select(*USER_COLUMNS)
