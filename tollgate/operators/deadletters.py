"""Dead letters (D1-D7): build, age, statistics, replay plan, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import variant as V
from tollgate.functions.text import py_list_repr
from tollgate.operators.route import REPLAY_LIMIT, REPLAYABLE_ERRORS, is_replayable, stage_error_type
from tollgate.sources.messages import first_rows

DEFAULT_TOPIC = "user_data"


def to_dead_letters(routed: DataFrame, now: str, source_topic: str = DEFAULT_TOPIC, body_col: str = "body") -> DataFrame:
    """One dead letter per rejected row.

    ``original_message`` is the body as it arrived (text), ``error_type`` the
    stage's error class, ``error_message`` "Validation failed: " + the
    Python list text of the errors (envelope, contract) or the errors
    joined by "; " (transform), ``timestamp`` the run time ``now`` (a
    parameter, so reruns agree), ``retry_count`` the ``_retry_count`` that a
    replay has put into the body (R10), else 0.
    """
    stage = F.col("stage")
    return routed.where(stage != "accepted").select(
        F.col(body_col).alias("original_message"),
        stage_error_type(stage).alias("error_type"),
        F.concat(F.lit("Validation failed: "), rejection_text()).alias("error_message"),
        F.lit(now).alias("timestamp"),
        retries_so_far(F.col(body_col)).alias("retry_count"),
        F.lit(source_topic).alias("source_topic"),
    )


def rejection_text() -> Column:
    """The errors of a rejected row: joined by "; " for the transform stage, else their Python list text."""
    return F.when(F.col("stage") == "transform", F.array_join("errors", "; ")).otherwise(py_list_repr(F.col("errors")))


def retries_so_far(text: Column) -> Column:
    """How often a message was replayed: its body's ``_retry_count``, 0 if there is none."""
    return retry_number(F.get_json_object(text, "$._retry_count"))


def retry_number(text: Column) -> Column:
    """A retry count from its JSON text: 0 for none or no number; a number beyond 64 bits counts as the largest."""
    huge = F.when(text.try_cast("double") > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(0))
    return F.coalesce(text.try_cast("bigint"), huge)


# A date, with or without a time and an offset, as ISO 8601 writes them.
ISO_TIME = r"^\d{4}-\d\d-\d\d([T ]\d\d(:\d\d(:\d\d(\.\d{1,6})?)?)?(Z|[+-]\d\d(:?\d\d)?)?)?$"


def iso_timestamp(text: Column) -> Column:
    """The time that an ISO text names; null for anything else, such as a time without a date or a bare year."""
    return F.when(text.rlike(ISO_TIME), F.try_to_timestamp(text))


def age_hours(ts_text: Column, now: str) -> Column:
    """(now - ts) in hours; unreadable or empty timestamp -> 0.0."""
    ts = iso_timestamp(ts_text)
    now_ts = F.to_timestamp(F.lit(now))
    micros = F.unix_micros(now_ts) - F.unix_micros(ts)
    return F.coalesce(micros.cast("double") / F.lit(3_600_000_000.0), F.lit(0.0))


def readable_first(decoded: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` readable rows (unreadable ones do not use up n)."""
    return first_rows(decoded.where("readable"), n)


def dead_letter_stats(decoded: DataFrame, now: str, max_messages: int | None = None,
                      limit: int = REPLAY_LIMIT, replayable: tuple[str, ...] = REPLAYABLE_ERRORS) -> DataFrame:
    """D3: one row of totals, replayable split and oldest age.

    Over all readable rows, or the first ``max_messages`` of them in (partition, offset)
    order.  The oldest age is never below 0 and rounded to 2 places; empty input gives
    zeros.  Unreadable rows are counted by ``undecodable_count``.  The counts by error
    type are rows of ``error_type_counts``: types are free text, so their number has no
    bound and they aren't gathered into one map.
    """
    rows = readable_first(decoded, max_messages)
    rows = rows.select(
        "error_type",
        is_replayable(F.col("error_type"), F.col("retry_count"), limit, replayable).alias("r"),
        age_hours(F.col("timestamp"), now).alias("age"),
    )
    return rows.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if("r").alias("retryable_count"),
        F.count_if(~F.col("r")).alias("non_retryable_count"),
        F.round(F.greatest(F.coalesce(F.max("age"), F.lit(0.0)), F.lit(0.0)), 2).alias("oldest_message_hours"),
    )


def undecodable_count(decoded: DataFrame) -> DataFrame:
    """Rows that could not be read as dead letters (R16: counted apart)."""
    return decoded.agg(F.count_if(~F.col("readable")).alias("undecodable"))


def error_type_counts(decoded: DataFrame, max_messages: int | None = None) -> DataFrame:
    """The per-type counts as rows (one shuffle keyed by error type)."""
    return readable_first(decoded, max_messages).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def plan_replay(decoded: DataFrame, target_topic: str | None = None, max_messages: int | None = None,
                only_replayable: bool = True, limit: int = REPLAY_LIMIT,
                replayable: tuple[str, ...] = REPLAYABLE_ERRORS, default_topic: str = DEFAULT_TOPIC) -> DataFrame:
    """What a replay would do with each row (or the first ``max_messages``).

    Every read row counts, skipped and failed ones too.  Outcome: unreadable
    -> ``failed``; not replayable (when ``only_replayable``) -> ``skipped``
    (tested before the body); body not a JSON object, with repeated keys or
    followed by other text -> ``failed``; else
    ``retried`` with ``target_topic`` = the argument, else the letter's own
    topic, else the default (empty text counts as absent), and ``body`` =
    the original object plus ``_retry_count = retry_count + 1`` (replacing
    an existing one).  No shuffle: a top-k read, then one projection.
    """
    rows = first_rows(decoded, max_messages)
    parsed = V.with_parsed(rows, "original_message", "_b")
    is_obj = V.is_json_object_text("original_message", F.col("_b"))
    staged = parsed.select("*", F.when(is_obj, F.try_variant_get("_b", "$", "map<string,variant>")).alias("_m"))
    ok_r = is_replayable(F.col("error_type"), F.col("retry_count"), limit, replayable)
    outcome = (
        F.when(~F.col("readable"), F.lit("failed"))
        .when(F.lit(only_replayable) & ~ok_r, F.lit("skipped"))
        .when(F.col("_m").isNull(), F.lit("failed"))
        .otherwise(F.lit("retried"))
    )
    staged = staged.select("*", outcome.alias("outcome"))
    topic = F.coalesce(
        F.lit(target_topic) if target_topic else F.lit(None).cast("string"),
        F.when(F.col("topic") != "", F.col("topic")),
        F.lit(default_topic),
    )
    count_v = F.parse_json((F.col("retry_count") + 1).cast("string"))
    kept = F.map_filter(F.col("_m"), lambda k, _: k != "_retry_count")
    new_body = F.to_json(F.map_concat(kept, F.create_map(F.lit("_retry_count"), count_v)))
    retried = F.col("outcome") == "retried"
    return staged.select(
        "partition",
        "offset",
        "outcome",
        F.when(retried, topic).alias("target_topic"),
        F.when(retried, new_body).alias("body"),
        F.when(retried, F.col("retry_count") + 1).alias("new_retry_count"),
    )


def replay_messages(plan: DataFrame) -> DataFrame:
    """D5 -> A4: the plan's retried rows in Kafka sink shape, each for its own topic."""
    sent = plan.where(F.col("outcome") == "retried")
    return sent.select(F.lit(None).cast("binary").alias("key"), F.col("body").cast("binary").alias("value"), F.col("target_topic").alias("topic"))


def replay_summary(plan: DataFrame) -> DataFrame:
    """Retried / skipped / failed counts of a replay plan."""
    return plan.agg(
        F.count_if(F.col("outcome") == "retried").alias("retried"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )


def sample_dead_letters(decoded: DataFrame, n: int) -> DataFrame:
    """The first ``n`` readable dead letters (a top-k, not a full sort)."""
    return readable_first(decoded, n)
