"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in a local session without ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tollgate-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def saved(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back; the files go when the session's JVM ends.

    ``path``: a folder there, to whose rows it is added.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.mode("append").parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Lets the session hand at most ``rows`` rows to Python at once, instead of Spark's 10,000.

    Whole texts are long: large batches of them take hundreds of MB a task, in the JVM and in Python.
    No result depends on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes a query's shuffle files when the query ends, not when the driver next collects its garbage.

    For code that writes one table after another; no result depends on it.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def released(run: Callable) -> Callable:
    """``run``, which after its last batch gives the memory that it used back to the system.

    Spark keeps Python workers for later tasks; what a task has freed would otherwise stay with them.
    """

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of a corpus: a null text is empty, rows without an id are left out.

    Rows that share an id are one document with the smallest of their texts; other columns, whatever
    their names, are not looked at.
    """
    small_batches(docs.sparkSession)
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    out = out.where(F.col("id").isNotNull())
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null")
    if ids.groupBy("id").count().where("count > 1").isEmpty():
        return out
    return out.groupBy("id").agg(F.min("text").alias("text"))


def plain(text):
    """Words of the lower-cased (A-Z) text; every run of other ASCII characters becomes blanks."""
    other = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
    return F.translate(text, UPPER + other, UPPER.lower() + " " * len(other))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the smallest node reachable.

    Alternating large-star and small-star rounds: each round points nodes at the least neighbour, so
    chains halve and stars stay linear in size; a hub is a skewed join key, which adaptive execution
    splits.  Every round is written to the shared folder.
    """
    cur = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        both = cur.union(cur.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        cur = saved(small.where("a <> b").distinct())
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(cur.select("b", "b").distinct())
