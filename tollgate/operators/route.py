"""Route every record to exactly one outcome.

``route`` adds ``stage`` (accepted / envelope / contract / transform),
``errors`` (array<string>) and the flattened ``user`` struct in ONE
projection over a body parsed once.  Rows in = rows out, always.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import variant as V
from tollgate.operators.contracts import (
    API_USER,
    USER,
    USER_COLUMNS,
    _node_projections,
    cached,
    column_contract_errors,
    contract_errors,
    envelope_errors,
    node_columns,
    with_nodes,
)
from tollgate.operators.users import flatten_user, unwrap_response

STAGES = ("accepted", "envelope", "contract", "transform")

# Retry policies of the reference (two different lists, R7).
TRANSIENT_ERRORS = (
    "APIConnectionError",
    "APITimeoutError",
    "APIRateLimitError",
    "KafkaConnectionError",
    "CassandraConnectionError",
)
REPLAYABLE_ERRORS = ("ConnectionError", "TimeoutError", "CassandraWriteError", "KafkaConnectionError")
REPLAY_LIMIT = 3


def route(df: DataFrame, body_col: str = "body", keep_parsed: bool = False, normalize_first: bool = False) -> DataFrame:
    """One pass adding ``stage``, ``errors`` and ``user``.

    Order of checks: envelope (C1), contract 1 on ``results[0]`` (C2),
    flatten (B11), contract 2 on the flat record (C3).  The body is parsed
    once (``_parsed``); each JSON path of contract 1 is read once into a
    helper column that the checks and the flattening share.  All steps are
    narrow projections: no shuffle, rows in = rows out.  ``stage``, ``errors``
    and ``user`` come out of a generator, so a filter on them neither repeats
    the checks nor needs the rows written first.  ``normalize_first`` flattens
    the record as contract 1 normalises it: a gender outside the list is
    ``other`` instead of an error of contract 2 (R1).
    """
    staged = V.with_parsed(df, body_col, "_parsed")
    steps = cached(("route", body_col, normalize_first), lambda: _route_steps(body_col, normalize_first))
    staged = staged.select("*", *steps["env"])
    staged, nodes = with_nodes(staged, "_user", API_USER, tag="u")
    staged = staged.select("*", *steps["c1_flat"]).drop(*node_columns(nodes))
    staged = staged.select("*", steps["c2"])
    out = V.computed_once(staged, F.struct(*steps["final"]), "_routed")
    kept = [c for c in df.columns] + (["_parsed"] if keep_parsed else [])
    return out.select(*kept, "_routed.*")


def _route_steps(body_col: str, normalize_first: bool) -> dict:
    """The routing projections as expression lists (built once, see ``cached``)."""
    _, nodes = cached(("nodes", "_user", API_USER, "u"), lambda: _node_projections("_user", API_USER, "u"))
    env = [
        envelope_errors(F.col(body_col), F.col("_parsed")).alias("_env"),
        unwrap_response(F.col("_parsed")).alias("_user"),
    ]
    # Flattened fields as top-level columns: later checks reference them as
    # attributes, so no field expression is copied into another one.
    flat = [f"__f_{c}" for c in USER_COLUMNS]
    c1_flat = [
        F.when(F.col("_env").isNull(), contract_errors(F.col("_user"), API_USER, nodes)).alias("_c1"),
        *[F.when(F.col("_env").isNull(), e).alias(n) for e, n in zip(flatten_user(F.col("_user"), nodes, normalize_first), flat)],
    ]
    c2 = column_contract_errors({c: F.col(n) for c, n in zip(USER_COLUMNS, flat)}, USER)
    c2 = F.when(F.col("_env").isNull() & (F.size("_c1") == 0), c2).alias("_c2")
    user = F.when(F.col("_env").isNull(), F.struct(*[F.col(n).alias(c) for c, n in zip(USER_COLUMNS, flat)])).alias("user")
    stage = (
        F.when(F.col("_env").isNotNull(), F.lit("envelope"))
        .when(F.size("_c1") > 0, F.lit("contract"))
        .when(F.size("_c2") > 0, F.lit("transform"))
        .otherwise(F.lit("accepted"))
    )
    errors = (
        F.when(F.col("_env").isNotNull(), F.array(F.col("_env")))
        .when(F.size("_c1") > 0, F.col("_c1"))
        .when(F.size("_c2") > 0, F.col("_c2"))
        .otherwise(F.array().cast("array<string>"))
    )
    return {"env": env, "c1_flat": c1_flat, "c2": c2, "final": [stage.alias("stage"), errors.alias("errors"), user]}


def accepted(routed: DataFrame) -> DataFrame:
    """Accepted rows as the flat 11-column user table."""
    return routed.where(F.col("stage") == "accepted").select("user.*")


def route_outcomes(routed: DataFrame) -> DataFrame:
    """Counts per (stage, first error): the run's routing report."""
    return routed.groupBy(
        "stage", F.try_element_at(F.col("errors"), F.lit(1)).alias("first_error")
    ).agg(F.count(F.lit(1)).alias("n"))


def classify_fetch(status: Column, body: Column, retry_after: Column | None = None,
                   failure: Column | None = None, body_chars: int | None = None,
                   parsed: Column | None = None) -> list[Column]:
    """Outcome of one HTTP fetch.

    429 -> APIRateLimitError (keeps retry_after); >=500 -> APIConnectionError;
    >=400 -> APIError; body not JSON -> APIError; else ok.  A null status is a
    fetch without a response: ``failure`` names why ("timeout", "connection",
    anything else or nothing), the first two are transient.  The body is kept
    on errors, to its first ``body_chars`` characters if given.  ``parsed`` is the
    body's parsed value where the caller has it.
    """
    none = status.isNull()
    why = F.lit(None).cast("string") if failure is None else failure
    bad_json = (V.parse_body(body) if parsed is None else parsed).isNull()
    error_type = (
        F.when(none & (why == "timeout"), F.lit("APITimeoutError"))
        .when(none & (why == "connection"), F.lit("APIConnectionError"))
        .when(none, F.lit("APIError"))
        .when(status == 429, F.lit("APIRateLimitError"))
        .when(status >= 500, F.lit("APIConnectionError"))
        .when(status >= 400, F.lit("APIError"))
        .when(bad_json, F.lit("APIError"))
    )
    message = (
        F.when(none & (why == "timeout"), F.lit("Request timed out"))
        .when(none & (why == "connection"), F.lit("Connection failed"))
        .when(none, F.lit("Request failed"))
        .when(status == 429, F.lit("API rate limit exceeded"))
        .when(status >= 500, F.concat(F.lit("Server error: "), status.cast("string")))
        .when(status >= 400, F.concat(F.lit("Client error: "), status.cast("string")))
        .when(bad_json, F.lit("Invalid JSON response"))
    )
    http = F.when(status >= 400, status)
    kept = F.substring(body, 1, body_chars) if body_chars else body
    kept_body = F.when((status >= 500) | ((status >= 400) & (status != 429)) | ((status < 400) & bad_json), kept)
    outcome = F.when(error_type.isNull(), F.lit("ok")).otherwise(F.lit("error"))
    cols = [
        outcome.alias("outcome"),
        error_type.alias("error_type"),
        message.alias("error_message"),
        http.alias("status_code"),
        kept_body.alias("response_body"),
        is_transient(error_type).alias("is_transient"),
    ]
    if retry_after is not None:
        cols.append(F.when(status == 429, retry_after).alias("retry_after"))
    return cols


def is_transient(error_type: Column) -> Column:
    """Error class is one the pipeline retries in-process."""
    return F.coalesce(error_type.isin(*TRANSIENT_ERRORS), F.lit(False))


def is_replayable(error_type: Column, retry_count: Column, limit: int = REPLAY_LIMIT,
                  replayable: tuple[str, ...] = REPLAYABLE_ERRORS) -> Column:
    """Dead letter may be replayed: listed error and ``retry_count < limit``."""
    return F.coalesce(error_type.isin(*replayable) & (retry_count < limit), F.lit(False))


def stage_error_type(stage: Column) -> Column:
    """Dead-letter error class of a routing stage."""
    return F.when(stage == "transform", F.lit("TransformationError")).otherwise(F.lit("DataValidationError"))
