"""Session helpers for tests, the bench and local runs.

Library code never creates a session; callers pass theirs in.  The helpers
here only set what a local run needs and read cluster settings as given.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tollgate") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared directory.

    ``spark.checkpoint.dir`` or else the directory given to ``setCheckpointDir``
    names storage that every executor can reach; both are read, neither is
    changed.  Where none is set a local session gets a temporary folder; on a
    cluster that would be a path executors cannot see, so it is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tollgate-ckpt-")
        sc.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique (not yet existing) path below the shared directory; what is
    written there goes when the session's JVM ends."""
    path = shared_dir(spark, "tollgate", f"{name}-{uuid.uuid4().hex}")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path
