"""F4's first half: every landed fetch goes to exactly one of three sinks.

``accepted``: a response that passes the contracts.  ``retry``: a transient failure with tries left, due
again after its back-off.  ``dead_letter``: any other failure, and responses that a contract rejects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.backoff import backoff_delay
from tollgate.functions.text import error_text
from tollgate.operators import deadletters as D
from tollgate.operators.route import classify_fetch, route, stage_error_type

SINKS = ("accepted", "retry", "dead_letter")

# What the queue holds of a fetch that is due again.
RETRY_SCHEMA = "fetch_id BIGINT, attempt INT, error_type STRING, status INT, due TIMESTAMP_NTZ"


@dataclass(frozen=True)
class RetryPolicy:
    """``retries`` after the first try; the waiting time doubles from ``base`` up to ``max_delay`` seconds.

    With ``heed_retry_after`` a rate-limited fetch waits at least as long as the server asked for.
    """

    retries: int = 3
    base: float = 1.0
    max_delay: float = 30.0
    factor: float = 2.0
    jitter: bool = False
    heed_retry_after: bool = True


def route_fetches(fetches: DataFrame, policy: RetryPolicy = RetryPolicy(), normalize_first: bool = False, body_chars: int = 500) -> DataFrame:
    """Landed fetches (A3's columns) plus ``sink``, ``due``, the failure's columns, and ``stage``, ``errors``, ``user``.

    One narrow pass, rows in = rows out; the body is parsed once for C8 and C7.  A missing attempt is the
    first; a fetch without a time is due at once when it fails (the start of 1970).
    """
    attempt = F.coalesce(F.col("attempt"), F.lit(0))
    routed = route(fetches.withColumn("attempt", attempt), keep_parsed=True, normalize_first=normalize_first)
    failure = classify_fetch(
        F.col("status"), F.col("body"), F.col("retry_after"), F.col("failure"), body_chars=body_chars, parsed=F.col("_parsed")
    )
    routed = routed.select(*[c for c in routed.columns if c not in ("retry_after", "_parsed")], *failure)
    failed = F.col("outcome") == "error"
    again = failed & F.col("is_transient") & (F.col("attempt") < policy.retries)
    sink = F.when(again, "retry").when(failed | (F.col("stage") != "accepted"), "dead_letter").otherwise("accepted")
    wait = backoff_delay(F.col("attempt"), policy.base, policy.max_delay, policy.factor, policy.jitter, F.struct("fetch_id", "attempt"))
    if policy.heed_retry_after:
        wait = F.greatest(wait, F.coalesce(F.col("retry_after").cast("double"), F.lit(0.0)))
    start = F.coalesce(F.col("ts"), F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
    return routed.select("*", sink.alias("sink"), F.when(again, start + F.make_dt_interval(secs=wait)).alias("due"))


def fetch_letters(routed: DataFrame, now: str, source_topic: str = D.DEFAULT_TOPIC) -> DataFrame:
    """D1 for fetches: a failed fetch keeps its body (``{}`` without one), class, message and attempts."""
    failed = F.col("outcome") == "error"
    text = F.concat(F.lit("Validation failed: "), D.rejection_text())
    return routed.where(F.col("sink") == "dead_letter").select(
        F.coalesce(F.col("body"), F.lit("{}")).alias("original_message"),
        F.when(failed, F.col("error_type")).otherwise(stage_error_type(F.col("stage"))).alias("error_type"),
        F.when(failed, error_text(F.col("error_message"), status=F.col("status_code"))).otherwise(text).alias("error_message"),
        F.lit(now).alias("timestamp"),
        F.when(failed, F.col("attempt")).otherwise(D.retries_so_far(F.col("body"))).alias("retry_count"),
        F.lit(source_topic).alias("source_topic"),
    )


def fetch_retries(routed: DataFrame) -> DataFrame:
    """The queue's rows: fetches to try again, with the attempt that has just failed."""
    return routed.where(F.col("sink") == "retry").select("fetch_id", "attempt", "error_type", "status", "due")
