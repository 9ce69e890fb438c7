"""D5 as a consumer group: a replay remembers what it has sent.

A run plans the letters that no earlier run has sent, writes the plan to its own folder, sends the plan's
retried messages, and only then records them in the ledger.  A run that fails while sending leaves
its letters open; under the same id it sends the same plan again.  Skipped and failed letters stay open, so
each run reports on them anew (R15: nothing vanishes behind a commit).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators import deadletters as D
from tollgate.sources import sinks as S
from tollgate.sources.due_queue import newest_complete

SENT_SCHEMA = "partition INT, offset BIGINT, run BIGINT"
PLAN_SCHEMA = "partition INT, offset BIGINT, outcome STRING, target_topic STRING, body STRING, new_retry_count BIGINT"


def sent_letters(spark: SparkSession, ledger: str, below: int | None = None) -> DataFrame:
    """(partition, offset, run) of every letter that settled runs (before run ``below``) have sent."""
    base = ledger.rstrip("/")
    upto = newest_complete(spark, base, "upto", below)
    runs, n = [], newest_complete(spark, base, "run", below)
    while n is not None and (upto is None or n > upto):
        runs.append(f"{base}/run={n}")
        n = newest_complete(spark, base, "run", n)
    runs += [f"{base}/upto={upto}"] if upto is not None else []
    return spark.read.schema(SENT_SCHEMA).parquet(*runs) if runs else spark.createDataFrame([], SENT_SCHEMA)


def open_letters(letters: DataFrame, ledger: str, below: int | None = None) -> DataFrame:
    """Decoded letters that are not in the ledger: an anti-join on their place in the topic."""
    return letters.join(sent_letters(letters.sparkSession, ledger, below).drop("run"), ["partition", "offset"], "left_anti")


def replay(letters: DataFrame, ledger: str, run_id: int, send: Callable[[DataFrame, int], None], **options) -> DataFrame:
    """Send the open letters once; D6's counts of this run.

    ``letters`` is A8's frame, ``options`` are those of ``plan_replay`` (``max_messages`` bounds the open letters),
    ``send`` writes messages in Kafka's sink shape under the run's id and raises if it can't.  A run
    that was settled before only reports again.
    """
    spark, base = letters.sparkSession, ledger.rstrip("/")
    folder = f"{base}/plan={int(run_id)}"
    if newest_complete(spark, base, "plan", run_id + 1) != run_id:
        plan = D.plan_replay(open_letters(letters, ledger, run_id), **options)
        plan.write.mode("overwrite").parquet(folder)
    plan = spark.read.schema(PLAN_SCHEMA).parquet(folder)
    if newest_complete(spark, base, "run", run_id + 1) != run_id:
        send(D.replay_messages(plan), run_id)
        sent = plan.where(F.col("outcome") == "retried").select("partition", "offset", F.lit(int(run_id)).cast("long").alias("run"))
        sent.write.mode("overwrite").parquet(f"{base}/run={int(run_id)}")
    return D.replay_summary(plan)


def to_topic(path: str, fmt: str = "parquet", now: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``send`` that writes to a topic kept as files (or to Kafka's servers), replacing what the same run wrote."""

    def send(messages: DataFrame, run_id: int) -> None:
        S.write_messages(messages, fmt, path, run_id, now=now)

    return send


def compact_ledger(spark: SparkSession, ledger: str) -> int | None:
    """Merge all settled runs into one folder; readers take it and the runs after it.  The last run's id."""
    base = ledger.rstrip("/")
    last, upto = newest_complete(spark, base, "run"), newest_complete(spark, base, "upto")
    if last is not None and last != upto:
        sent_letters(spark, ledger, last + 1).write.mode("overwrite").parquet(f"{base}/upto={last}")
    return last
