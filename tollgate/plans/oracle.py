"""DuckDB SQL for every registered query (same names as the catalog)."""

from __future__ import annotations

from tollgate.plans import duck as D
from tollgate.plans.fixtures import LANDED_FETCH, duckdb_cte, fetched_again

ORACLE: dict[str, str] = {}


def _parsed() -> str:
    return (
        duckdb_cte("raw_responses")
        + ", _p AS MATERIALIZED (SELECT response_id, body, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS pj FROM raw_responses)"
    )


def _users() -> str:
    return (
        _parsed()
        + f", _users AS MATERIALIZED (SELECT response_id, {D.get('pj', 'results', 0)} AS u FROM _p WHERE {D.envelope_errors('body', 'pj')} IS NULL)"
    )


def _routed(normalize_first: bool = False) -> str:
    flat = D.flatten_user("u")
    if normalize_first:
        flat["gender"] = D.normalize_gender(flat["gender"])
    flat_sql = ", ".join(f"CASE WHEN env IS NULL THEN {e} END AS {k}" for k, e in flat.items())
    c2 = D.column_user_errors()
    return (
        _parsed()
        + f", _e AS MATERIALIZED (SELECT response_id, body, {D.envelope_errors('body', 'pj')} AS env, {D.get('pj', 'results', 0)} AS u FROM _p)"
        + f", _c1 AS MATERIALIZED (SELECT *, CASE WHEN env IS NULL THEN {D.api_errors('u')} END AS c1 FROM _e)"
        + f", _f AS MATERIALIZED (SELECT *, {flat_sql} FROM _c1)"
        + f", _c2 AS MATERIALIZED (SELECT *, CASE WHEN env IS NULL AND len(c1) = 0 THEN {c2} END AS c2 FROM _f)"
        + ", routed AS MATERIALIZED (SELECT *, CASE WHEN env IS NOT NULL THEN 'envelope' WHEN len(c1) > 0 THEN 'contract' "
        "WHEN len(c2) > 0 THEN 'transform' ELSE 'accepted' END AS stage, "
        "CASE WHEN env IS NOT NULL THEN [env] WHEN len(c1) > 0 THEN c1 WHEN len(c2) > 0 THEN c2 "
        "ELSE CAST([] AS VARCHAR[]) END AS errors FROM _c2)\n"
    )


ORACLE["route_outcomes"] = _routed() + "SELECT stage, errors[1] AS first_error, count(*) AS n FROM routed GROUP BY ALL"

ORACLE["route_outcomes_normalized"] = _routed(True) + "SELECT stage, errors[1] AS first_error, count(*) AS n FROM routed GROUP BY ALL"

ORACLE["run_summary"] = _routed() + (
    "SELECT count(*) FILTER (WHERE stage = 'accepted') AS success_count, "
    "count(*) FILTER (WHERE stage <> 'accepted') AS failure_count, "
    "coalesce(count(*) FILTER (WHERE stage = 'accepted') / nullif(count(*), 0), 0.0) AS success_rate, "
    "CAST(72.5 AS DOUBLE) AS duration_seconds FROM routed"
)

ORACLE["envelope_errors"] = _parsed() + f"SELECT response_id, {D.envelope_errors('body', 'pj')} AS envelope_error FROM _p"

_ce = D.api_errors("u")
ORACLE["api_contract_errors"] = _users() + (
    f"SELECT response_id, len({_ce}) AS n_errors, array_to_string({_ce}, ' | ') AS errors FROM _users"
)

_mt = "CAST(value AS VARCHAR)"
_uce = D.user_errors("v")
ORACLE["user_contract_errors"] = duckdb_cte("user_messages") + (
    ", _m AS (SELECT partition, \"offset\", CASE WHEN json_valid(value_text) THEN CAST(value_text AS JSON) END AS v FROM user_messages) "
    f"SELECT partition, \"offset\", len({_uce}) AS n_errors, array_to_string({_uce}, ' | ') AS errors FROM _m"
)

ORACLE["unwrap_response"] = _users() + (
    f"SELECT response_id, {D.python_type_name('u')} AS user_type, {D.py_text(D.get('u', 'gender'))} AS gender_raw FROM _users"
)


def _nested(v: str, keys: tuple, default: str) -> str:
    return f"coalesce({D.py_text(D.get(v, *keys))}, {D.q(default)})"


ORACLE["nested_get"] = _parsed() + (
    "SELECT response_id, "
    f"{_nested('pj', ('results', 0, 'name', 'first'), 'Unknown')} AS first, "
    f"{_nested('pj', ('results', 0, 'location', 'street', 'number'), '')} AS street_number, "
    f"{_nested('pj', ('results', 0, 'name', 'middle'), '')} AS middle, "
    f"{_nested('pj', ('results', 0, 'email', 'domain'), 'n/a')} AS through_text, "
    f"{_nested('pj', ('info', 'seed'), 'none')} AS seed FROM _p"
)

_flat = D.flatten_user("u")
ORACLE["flatten_user"] = _users() + "SELECT response_id, " + ", ".join(f"{e} AS {k}" for k, e in _flat.items()) + " FROM _users"
ORACLE["stable_user_id"] = _users() + f"SELECT response_id, {_flat['id']} AS id FROM _users"
ORACLE["build_address"] = _users() + f"SELECT response_id, {_flat['address']} AS address FROM _users"
_g = D.py_text(D.get("u", "gender"))
ORACLE["normalize_gender"] = _users() + f"SELECT response_id, {_g} AS gender_raw, {D.normalize_gender(_g)} AS gender FROM _users"
ORACLE["postcode_text"] = _users() + (
    f"SELECT response_id, coalesce({D.py_text(D.get('u', 'location', 'postcode'))}, '') AS postcode FROM _users"
)

# --------------------------------------------------------------------------- shared DuckDB pieces
RUN_NOW = "2024-02-01T00:00:00Z"
# Errors that are retried in-process, errors that are replayed and how often,
# bounds of the two histograms in seconds.
TRANSIENT = ("APIConnectionError", "APITimeoutError", "APIRateLimitError", "KafkaConnectionError", "CassandraConnectionError")
REPLAYABLE, REPLAY_LIMIT = ("ConnectionError", "TimeoutError", "CassandraWriteError", "KafkaConnectionError"), 3
SEND_BOUNDS = (0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
BATCH_BOUNDS = (0.1, 0.5, 1.0, 5.0, 10.0, 30.0)

USER_COLS = list(D.USER_COLUMNS)
_cols = ", ".join(USER_COLS)


def _in(col: str, values) -> str:
    return f"coalesce({col} IN ({', '.join(D.q(v) for v in values)}), false)"


def _json_or_null(text: str) -> str:
    return f"CASE WHEN json_valid({text}) THEN CAST({text} AS JSON) END"


def _decoded() -> str:
    fields = ", ".join(f"json_extract_string(v, {D.path(f)}) AS {f}" for f in USER_COLS)
    return duckdb_cte("user_messages") + (
        f", _m0 AS (SELECT \"partition\", \"offset\", \"timestamp\", {_json_or_null('value_text')} AS j FROM user_messages)"
        ", _m AS (SELECT *, CASE WHEN json_type(j) = 'OBJECT' THEN j END AS v FROM _m0)"
        f", decoded AS (SELECT \"partition\", \"offset\", \"timestamp\", v, {fields} FROM _m)\n"
    )


def _latest() -> str:
    return _decoded() + (
        f"SELECT {_cols} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY \"timestamp\" DESC, "
        "\"partition\" DESC, \"offset\" DESC) AS rn FROM decoded WHERE v IS NOT NULL AND id IS NOT NULL) WHERE rn = 1"
    )


def _repr_list(arr: str) -> str:
    base = (
        "replace(replace(replace(replace(s, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    )
    one = (
        f"CASE WHEN contains(s, '''') AND NOT contains(s, '\"') THEN '\"' || {base} || '\"' "
        f"ELSE '''' || replace({base}, '''', '\\''') || '''' END"
    )
    return f"('[' || array_to_string(list_transform({arr}, lambda s: {one}), ', ') || ']')"


def _dead_letters_from_routed() -> str:
    msg = f"CASE WHEN stage = 'transform' THEN array_to_string(errors, '; ') ELSE {_repr_list('errors')} END"
    return (
        "SELECT body AS original_message, "
        "CASE WHEN stage = 'transform' THEN 'TransformationError' ELSE 'DataValidationError' END AS error_type, "
        f"'Validation failed: ' || {msg} AS error_message, {D.q(RUN_NOW)} AS timestamp, 0 AS retry_count, "
        "'user_data' AS source_topic FROM routed WHERE stage <> 'accepted'"
    )


def _dl() -> str:
    def t(k):
        return D.py_text(D.get("v", k))

    rc = D.get("v", "retry_count")
    om = D.get("v", "original_message")
    readable = (
        f"(v IS NOT NULL AND json_type(v) = 'OBJECT' AND ({rc} IS NULL OR json_type({rc}) IN ('BIGINT', 'UBIGINT', 'DOUBLE')))"
    )
    om_text = f"CASE WHEN json_type({om}) = 'VARCHAR' THEN json_extract_string({om}, '$') ELSE CAST({om} AS VARCHAR) END"
    return duckdb_cte("dead_letters") + (
        f", _d AS (SELECT \"partition\", \"offset\", {_json_or_null('value_text')} AS v FROM dead_letters)"
        f", _dl0 AS (SELECT \"partition\", \"offset\", v, {readable} AS readable FROM _d)"
        ", dl AS (SELECT \"partition\", \"offset\", readable, "
        f"CASE WHEN readable THEN coalesce({om_text}, '{{}}') END AS original_message, "
        f"CASE WHEN readable THEN coalesce({t('error')}, {t('error_message')}, 'Unknown error') END AS error_message, "
        f"CASE WHEN readable THEN coalesce({t('error_type')}, 'Unknown') END AS error_type, "
        f"CASE WHEN readable THEN coalesce({t('timestamp')}, '') END AS timestamp, "
        f"CASE WHEN readable THEN coalesce({t('topic')}, {t('source_topic')}, '') END AS topic, "
        f"CASE WHEN readable THEN coalesce(CASE WHEN TRY_CAST(json_extract_string({rc}, '$') AS DOUBLE) < 9e18 THEN "
        f"TRY_CAST(json_extract_string({rc}, '$') AS BIGINT) WHEN {rc} IS NOT NULL THEN 9223372036854775807 END, 0) END AS retry_count "
        "FROM _dl0)\n"
    )


def _age(ts: str) -> str:
    now = f"epoch_us(TIMESTAMP '{RUN_NOW[:-1].replace('T', ' ')}')"
    iso = f"regexp_matches({ts}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ].*)?$')"
    return f"coalesce((({now} - epoch_us(CASE WHEN {iso} THEN TRY_CAST(replace({ts}, 'Z', '') AS TIMESTAMP) END)) / 3600000000.0), 0.0)"


def _replayable(et: str = "error_type", rc: str = "retry_count") -> str:
    return f"coalesce({et} IN ({', '.join(D.q(v) for v in REPLAYABLE)}) AND {rc} < {REPLAY_LIMIT}, false)"


def _stats(limit: str) -> str:
    return _dl() + (
        f", _r AS (SELECT * FROM dl WHERE readable ORDER BY \"partition\", \"offset\" {limit})"
        f", _a AS (SELECT error_type, {_replayable()} AS r, {_age('timestamp')} AS age FROM _r)"
        "SELECT count(*) AS total_messages, count(*) FILTER (WHERE r) AS retryable_count, "
        "count(*) FILTER (WHERE NOT r) AS non_retryable_count, "
        "round(greatest(coalesce(max(age), 0.0), 0.0), 2) AS oldest_message_hours FROM _a"
    )


def _plan(limit: str) -> str:
    mo = "original_message"
    keys = f"json_keys(CAST({mo} AS JSON))"
    is_obj = (
        f"coalesce(CASE WHEN json_valid({mo}) THEN json_type(CAST({mo} AS JSON)) = 'OBJECT' "
        f"AND len({keys}) = len(list_distinct({keys})) END, false)"
    )
    outcome = (
        f"CASE WHEN NOT readable THEN 'failed' WHEN NOT {_replayable()} THEN 'skipped' WHEN NOT {is_obj} THEN 'failed' "
        "ELSE 'retried' END"
    )
    body = f"CAST(json_merge_patch({mo}, json_object('_retry_count', retry_count + 1)) AS VARCHAR)"
    return _dl() + (
        f", _r AS (SELECT * FROM dl ORDER BY \"partition\", \"offset\" {limit})"
        f", _o AS (SELECT *, {outcome} AS outcome FROM _r)"
        ", plan AS (SELECT \"partition\", \"offset\", outcome, "
        "CASE WHEN outcome = 'retried' THEN coalesce(nullif(topic, ''), 'user_data') END AS target_topic, "
        f"CASE WHEN outcome = 'retried' THEN {body} END AS body, "
        "CASE WHEN outcome = 'retried' THEN retry_count + 1 END AS new_retry_count FROM _o)\n"
    )


def _classified() -> str:
    bad = "NOT json_valid(body)"
    et = (
        "CASE WHEN status IS NULL THEN (CASE failure WHEN 'timeout' THEN 'APITimeoutError' "
        "WHEN 'connection' THEN 'APIConnectionError' ELSE 'APIError' END) WHEN status = 429 THEN 'APIRateLimitError' WHEN status >= 500 THEN 'APIConnectionError' "
        f"WHEN status >= 400 THEN 'APIError' WHEN {bad} THEN 'APIError' END"
    )
    msg = (
        "CASE WHEN status IS NULL THEN (CASE failure WHEN 'timeout' THEN 'Request timed out' "
        "WHEN 'connection' THEN 'Connection failed' ELSE 'Request failed' END) WHEN status = 429 THEN 'API rate limit exceeded' WHEN status >= 500 THEN 'Server error: ' || status "
        f"WHEN status >= 400 THEN 'Client error: ' || status WHEN {bad} THEN 'Invalid JSON response' END"
    )
    keep = f"status >= 500 OR (status >= 400 AND status <> 429) OR (status < 400 AND {bad})"
    return duckdb_cte("fetch_log") + (
        f", _c AS (SELECT fetch_id, status, attempt, ts, retry_after, body, {et} AS error_type, {msg} AS error_message FROM fetch_log)"
        ", classified AS (SELECT fetch_id, status, attempt, ts, "
        "CASE WHEN error_type IS NULL THEN 'ok' ELSE 'error' END AS outcome, error_type, error_message, "
        "CASE WHEN status >= 400 THEN status END AS status_code, "
        f"CASE WHEN {keep} THEN substr(body, 1, 500) END AS response_body, "
        f"{_in('error_type', TRANSIENT)} AS is_transient, "
        "CASE WHEN status = 429 THEN retry_after END AS retry_after FROM _c)\n"
    )


ROUNDS = ("2024-01-31 01:00:00", "2024-01-31 02:10:00", "2024-01-31 02:10:04", "2024-01-31 02:10:30")


def _fetch_rounds(rounds: int) -> str:
    """``tries``: every try of every fetch with its sink; rows that are due again name the round that takes them."""
    bad = "NOT json_valid(body)"
    error = (
        "CASE WHEN status IS NULL THEN (CASE failure WHEN 'timeout' THEN 'APITimeoutError' WHEN 'connection' THEN 'APIConnectionError' "
        "ELSE 'APIError' END) WHEN status = 429 THEN 'APIRateLimitError' WHEN status >= 500 THEN 'APIConnectionError' "
        f"WHEN status >= 400 THEN 'APIError' WHEN {bad} THEN 'APIError' END"
    )

    def sinks(k: int) -> str:
        again = f"{_in('error_type', TRANSIENT)} AND attempt < 3"
        wait = "greatest(least(pow(2.0, attempt), 30.0), CASE WHEN status = 429 THEN coalesce(retry_after, 0) ELSE 0 END)"
        taken = " ".join(f"WHEN due <= TIMESTAMP '{t}' THEN {n}" for n, t in enumerate(ROUNDS[:rounds], 1) if n > k)
        return (
            f", _e{k} AS (SELECT *, {error} AS error_type FROM _l{k})"
            f", _s{k} AS (SELECT *, CASE WHEN {again} THEN 'retry' WHEN error_type IS NOT NULL THEN 'dead_letter' END AS failed, "
            f"CASE WHEN {again} THEN ts + to_microseconds(CAST({wait} * 1000000 AS BIGINT)) END AS due FROM _e{k})"
            f", _t{k} AS MATERIALIZED (SELECT *, {f'CASE {taken} END' if taken else 'NULL'} AS taken FROM _s{k})"
        )

    first = ", ".join(f"{e.format(ntz='TIMESTAMP')} AS {n}" for n, e in LANDED_FETCH.items())
    out = _routed() + f", _l0 AS (SELECT {first} FROM raw_responses)" + sinks(0)
    for k in range(1, rounds + 1):
        before = " UNION ALL ".join(f"SELECT fetch_id, attempt FROM _t{j} WHERE taken = {k}" for j in range(k))
        again = ", ".join(f"{e.format(ntz='TIMESTAMP')} AS {n}" for n, e in fetched_again(ROUNDS[k - 1]).items())
        out += (
            f", _d{k} AS (SELECT q.fetch_id, q.attempt + 1 AS attempt, r.body FROM ({before}) q JOIN raw_responses r ON r.response_id = q.fetch_id)"
            f", _l{k} AS (SELECT {again} FROM _d{k})" + sinks(k)
        )
    every = " UNION ALL ".join(f"SELECT fetch_id, attempt, status, error_type, failed, due FROM _t{k}" for k in range(rounds + 1))
    return out + (
        f", _every AS ({every}), tries AS (SELECT t.*, r.stage, coalesce(t.failed, CASE r.stage WHEN 'accepted' THEN 'accepted' "
        "ELSE 'dead_letter' END) AS sink FROM _every t JOIN routed r ON r.response_id = t.fetch_id)\n"
    )


_SINK_COUNTS = (
    "SELECT sink, CASE WHEN sink = 'accepted' THEN NULL WHEN error_type IS NOT NULL THEN error_type WHEN stage = 'transform' "
    "THEN 'TransformationError' ELSE 'DataValidationError' END AS error_type, "
    "CASE WHEN error_type IS NULL THEN 0 ELSE attempt END AS attempt, count(*) AS n FROM tries GROUP BY ALL"
)


def _f(x: float) -> str:
    return f"CAST({repr(float(x))} AS DOUBLE)"


# --------------------------------------------------------------------------- messages, sinks
ORACLE["decode_messages"] = _decoded() + f"SELECT \"partition\", \"offset\", {_cols} FROM decoded"
ORACLE["malformed_messages"] = _decoded() + (
    "SELECT \"partition\", \"offset\", CASE WHEN v IS NULL THEN 'undecodable' ELSE 'no id' END AS reason "
    "FROM decoded WHERE v IS NULL OR id IS NULL"
)
_obj = ", ".join(f"'{c}', {c}" for c in USER_COLS)
ORACLE["message_json"] = _decoded() + f"SELECT \"partition\", \"offset\", CAST(json_object({_obj}) AS VARCHAR) AS json FROM decoded"
ORACLE["is_uuid"] = _decoded() + f"SELECT \"partition\", \"offset\", id, {D.is_uuid('id')} AS is_uuid FROM decoded"
ORACLE["publish_encode"] = _routed() + (
    f"SELECT id AS key, CAST(json_object({_obj}) AS VARCHAR) AS value, 'user_data' AS topic FROM routed WHERE stage = 'accepted'"
)
ORACLE["is_email"] = _routed() + f"SELECT response_id, email, {D.is_email('email')} AS is_email FROM routed WHERE env IS NULL"
ORACLE["upsert_latest"] = _latest()
ORACLE["current_users"] = _latest()
ORACLE["replay_idempotent"] = _latest()
ORACLE["compacted_users"] = _latest()
ORACLE["bucketed_users"] = _latest()
ORACLE["users_looked_up"] = (
    f"WITH latest AS MATERIALIZED ({_latest()}) SELECT * FROM latest "
    "WHERE id = (SELECT min(id) FROM latest) OR id = (SELECT max(id) FROM latest)"
)
ORACLE["batch_telemetry"] = _decoded() + (
    "SELECT 'users' AS query, 1 AS batches, count(*) AS rows, count(DISTINCT CASE WHEN v IS NOT NULL THEN id END) AS written, "
    "count(*) FILTER (WHERE v IS NULL OR id IS NULL) AS rejected FROM decoded"
)
ORACLE["ingest_to_table"] = _routed() + (
    f"SELECT {_cols} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY response_id DESC) AS rn "
    "FROM routed WHERE stage = 'accepted') WHERE rn = 1"
)
ORACLE["stream_users"] = _latest()
ORACLE["users_table_schema"] = _routed() + f"SELECT {_cols} FROM routed WHERE stage = 'accepted'"
ORACLE["to_dead_letters"] = _routed() + _dead_letters_from_routed()
ORACLE["dead_letters_written"] = _routed() + _dead_letters_from_routed()
ORACLE["dead_letters_roundtrip"] = _routed() + (
    f"SELECT true AS readable, original_message, error_message, error_type, timestamp, source_topic AS topic, retry_count "
    f"FROM ({_dead_letters_from_routed()})"
)
ORACLE["stream_route"] = _routed() + (
    "SELECT CASE stage WHEN 'accepted' THEN 'accepted' WHEN 'transform' THEN 'TransformationError' "
    "ELSE 'DataValidationError' END AS outcome, count(*) AS n FROM routed GROUP BY ALL"
)
ORACLE["ingest_fetches"] = _fetch_rounds(0) + _SINK_COUNTS
ORACLE["retry_rounds"] = _fetch_rounds(len(ROUNDS)) + _SINK_COUNTS
ORACLE["retry_queue"] = _fetch_rounds(len(ROUNDS)) + (
    "SELECT fetch_id, attempt, error_type, status, strftime(due, '%Y-%m-%d %H:%M:%S.%f') AS due FROM tries WHERE sink = 'retry'"
)
ORACLE["stream_read_messages"] = duckdb_cte("user_messages") + (
    "SELECT \"partition\", \"offset\", value_text AS value FROM user_messages"
)

# --------------------------------------------------------------------------- dead letters
ORACLE["dlq_read_bounded"] = duckdb_cte("dead_letters") + (
    "SELECT \"partition\", \"offset\", value_text AS value FROM dead_letters ORDER BY \"partition\", \"offset\" LIMIT 1000"
)
ORACLE["dlq_decode"] = _dl() + "SELECT * FROM dl"
ORACLE["dlq_age_hours"] = _dl() + f"SELECT \"partition\", \"offset\", timestamp, {_age('timestamp')} AS age_hours FROM dl WHERE readable"
ORACLE["dlq_stats"] = _stats("LIMIT 1000")
ORACLE["dlq_stats_all"] = _stats("")
ORACLE["dlq_undecodable"] = _dl() + "SELECT count(*) FILTER (WHERE NOT readable) AS undecodable FROM dl"
ORACLE["dlq_error_types"] = _dl() + "SELECT error_type, count(*) AS n FROM dl WHERE readable GROUP BY error_type"
ORACLE["dlq_error_types_first_1000"] = _dl() + (
    ", _r AS (SELECT * FROM dl WHERE readable ORDER BY \"partition\", \"offset\" LIMIT 1000) "
    "SELECT error_type, count(*) AS n FROM _r GROUP BY error_type"
)
ORACLE["stream_dlq_stats"] = ORACLE["dlq_error_types"]
ORACLE["replay_plan"] = _plan("") + "SELECT * FROM plan"
ORACLE["replay_plan_first_100"] = _plan("LIMIT 100") + "SELECT * FROM plan"
ORACLE["replay_published"] = _plan("") + "SELECT body AS value, target_topic AS topic FROM plan WHERE outcome = 'retried'"
ORACLE["replay_ledger"] = _plan("") + (
    "SELECT \"partition\", \"offset\", CASE WHEN \"offset\" % 3 = 0 THEN 0 ELSE 2 END AS run, target_topic AS topic, body AS value "
    "FROM plan WHERE outcome = 'retried'"
)
ORACLE["stream_dlq_totals"] = ORACLE["dlq_stats_all"]
ORACLE["replay_summary"] = _plan("") + (
    "SELECT count(*) FILTER (WHERE outcome = 'retried') AS retried, count(*) FILTER (WHERE outcome = 'skipped') AS skipped, "
    "count(*) FILTER (WHERE outcome = 'failed') AS failed FROM plan"
)
ORACLE["dlq_sample"] = _dl() + "SELECT * FROM dl WHERE readable ORDER BY \"partition\", \"offset\" LIMIT 5"
ORACLE["is_transient"] = _dl() + (
    f"SELECT \"partition\", \"offset\", error_type, {_in('error_type', TRANSIENT)} AS is_transient FROM dl WHERE readable"
)
ORACLE["is_replayable"] = _dl() + (
    f"SELECT \"partition\", \"offset\", error_type, retry_count, {_replayable()} AS is_replayable FROM dl WHERE readable"
)

# --------------------------------------------------------------------------- fetches
ORACLE["classify_fetch"] = _classified() + (
    "SELECT fetch_id, status, outcome, error_type, error_message, status_code, response_body, is_transient, retry_after "
    "FROM classified"
)
ORACLE["error_text"] = _classified() + (
    "SELECT fetch_id, concat_ws(' ', error_message, CASE WHEN status_code IS NOT NULL AND status_code <> 0 "
    "THEN '[HTTP ' || status_code || ']' END) AS text FROM classified WHERE outcome = 'error'"
)
ORACLE["backoff_schedule"] = _classified() + (
    ", _b AS (SELECT fetch_id, attempt, ts, least(1.0 * pow(2.0, attempt), 30.0) AS delay_seconds FROM classified WHERE is_transient) "
    "SELECT fetch_id, attempt, delay_seconds, "
    "strftime(ts + to_microseconds(CAST(round(delay_seconds * 1000000) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS next_attempt_at FROM _b"
)
ORACLE["fetch_stats"] = _classified() + (
    "SELECT count(*) AS requests, count(*) FILTER (WHERE outcome = 'ok') AS successes, "
    "count(*) FILTER (WHERE outcome <> 'ok' AND (status >= 500 OR (status IS NULL AND is_transient))) AS retries, "
    "count(*) FILTER (WHERE outcome <> 'ok' AND (status < 500 OR (status IS NULL AND NOT is_transient))) AS failures FROM classified"
)
ORACLE["responses_landed"] = duckdb_cte("fetch_log") + "SELECT fetch_id, ts, status, failure, retry_after, body, attempt FROM fetch_log"

# --------------------------------------------------------------------------- text cells
_cell = "cell"
ORACLE["validation_error_text"] = duckdb_cte("text_cells") + (
    "SELECT doc_id, concat_ws(' ', 'Validation failed', '[field=text]', "
    "CASE WHEN cell IS NOT NULL THEN '[value=' || substr(cell, 1, 50) || ']' END) AS text FROM text_cells"
)
ORACLE["clean_string"] = duckdb_cte("text_cells") + (
    f"SELECT doc_id, length({D.clean_string(_cell)}) AS cleaned_len, md5({D.clean_string(_cell)}) AS cleaned_md5, "
    f"{D.clean_string(_cell, 'N/A', 100)} AS cut100, md5(coalesce(cell, '')) AS raw_md5 FROM text_cells"
)
ORACLE["clean_email"] = duckdb_cte("text_cells") + (
    f"SELECT doc_id, length({D.clean_email(_cell)}) AS len, md5({D.clean_email(_cell)}) AS email_md5 FROM text_cells"
)


def _blank(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {D.strip(c)} = '' THEN '{c}' END"


ORACLE["missing_fields"] = duckdb_cte("text_cells") + (
    f"SELECT doc_id, concat_ws(',', {_blank('cell')}, {_blank('lang')}, {_blank('source')}) AS missing FROM text_cells"
)

# --------------------------------------------------------------------------- telemetry
_L = duckdb_cte("delivery_log")
_TSF = "'%Y-%m-%d %H:%M:%S'"
ORACLE["delivery_stats"] = _L + (
    "SELECT count(*) FILTER (WHERE series = 'sent') AS messages_sent, count(*) FILTER (WHERE series = 'retry') AS send_retries, "
    "count(*) FILTER (WHERE series = 'failed') AS messages_failed, "
    "count(*) FILTER (WHERE series = 'dlq') AS sent_to_dlq FROM delivery_log"
)
ORACLE["counter_totals"] = _L + (
    ", _h AS (SELECT series, date_trunc('hour', ts) AS h, count(*) AS n FROM delivery_log GROUP BY ALL) "
    f"SELECT series, strftime(h, {_TSF}) AS hour, n, "
    "sum(n) OVER (PARTITION BY series ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total FROM _h"
)
_SLIDES = ", _w AS (SELECT l.*, time_bucket(INTERVAL 15 SECOND, ts) - to_seconds(15 * k) AS ws FROM delivery_log l, range(4) AS t(k)) "
ORACLE["rate_per_second"] = _L + _SLIDES + (
    f"SELECT series, strftime(ws, {_TSF}) AS window_start, count(*) AS n, count(*) / CAST(60 AS DOUBLE) AS rate "
    "FROM _w GROUP BY series, ws"
)
ORACLE["rate_odd_slide"] = _L + (
    ", _s AS (SELECT l.*, time_bucket(INTERVAL 25 SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds(25 * k) AS ws "
    "FROM delivery_log l, range(3) AS t(k)) "
    f"SELECT series, strftime(ws, {_TSF}) AS window_start, count(*) AS n, count(*) / CAST(60 AS DOUBLE) AS rate "
    "FROM _s WHERE ts < ws + INTERVAL 60 SECOND GROUP BY series, ws"
)
ORACLE["rate_five_minutes"] = _L + (
    f"SELECT series, strftime(time_bucket(INTERVAL 5 MINUTE, ts), {_TSF}) AS window_start, count(*) AS n, "
    "count(*) / CAST(300 AS DOUBLE) AS rate FROM delivery_log GROUP BY ALL"
)
ORACLE["dead_letter_share"] = _L + _SLIDES + (
    ", _g AS (SELECT ws, count(*) FILTER (WHERE series = 'dlq') AS dlq, count(*) FILTER (WHERE series = 'sent') AS sent "
    "FROM _w GROUP BY ws) "
    f"SELECT strftime(ws, {_TSF}) AS window_start, dlq, sent, "
    "CAST(dlq AS DOUBLE) / nullif(CAST(sent + dlq AS DOUBLE), 0) * 100.0 AS dlq_percent FROM _g"
)


def _hist(name: str, col: str, bounds) -> str:
    parts = []
    les = [repr(float(b)) for b in bounds] + ["+Inf"]
    conds = [f"{col} <= {_f(b)}" for b in bounds] + [f"{col} IS NOT NULL"]
    for le, cond in zip(les, conds):
        parts.append(
            f"SELECT '{name}' AS histogram, '{le}' AS le, count(*) FILTER (WHERE {cond}) AS bucket_count, count({col}) AS total_count, "
            f"round(coalesce(sum({col}), 0.0), 4) AS total_sum FROM delivery_log"
        )
    return " UNION ALL ".join(parts)


ORACLE["duration_histogram"] = _L + (
    _hist("send", "send_seconds", SEND_BOUNDS) + " UNION ALL " + _hist("batch", "batch_seconds", BATCH_BOUNDS)
)


def _quantile(q: float, bounds) -> str:
    rank = f"({_f(q)} * CAST(cnt AS DOUBLE))"
    whens = []
    for i, b in enumerate(bounds):
        lo = 0.0 if i == 0 else bounds[i - 1]
        below = _f(0.0) if i == 0 else f"CAST(b{i - 1} AS DOUBLE)"
        val = f"({_f(lo)} + {_f(b - lo)} * (({rank} - {below}) / (CAST(b{i} AS DOUBLE) - {below})))"
        whens.append(f"WHEN CAST(b{i} AS DOUBLE) >= {rank} THEN {val}")
    return f"CASE WHEN cnt > 0 THEN round(CASE {' '.join(whens)} ELSE {_f(bounds[-1])} END, 9) END"


_qb = ", ".join(f"count(*) FILTER (WHERE batch_seconds <= {_f(b)}) AS b{i}" for i, b in enumerate(BATCH_BOUNDS))
ORACLE["duration_quantiles"] = _L + (
    f", _g AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS ws, {_qb}, count(batch_seconds) AS cnt FROM delivery_log GROUP BY ws) "
    f"SELECT strftime(ws, {_TSF}) AS window_start, cnt, {_quantile(0.5, BATCH_BOUNDS)} AS p50, "
    f"{_quantile(0.99, BATCH_BOUNDS)} AS p99 FROM _g"
)
_PASSED = "ws + INTERVAL 60 SECOND <= (SELECT max(ts) FROM delivery_log) - INTERVAL 10 MINUTE"
ORACLE["stream_rates"] = _L + _SLIDES + (
    f"SELECT series, strftime(ws, {_TSF}) AS window_start, count(*) AS n, count(*) / CAST(60 AS DOUBLE) AS rate "
    f"FROM _w WHERE {_PASSED} GROUP BY series, ws"
)
ORACLE["stream_shares"] = _L + _SLIDES + (
    ", _g AS (SELECT ws, count(*) FILTER (WHERE series = 'dlq') AS dlq, count(*) FILTER (WHERE series = 'sent') AS sent "
    f"FROM _w WHERE {_PASSED} GROUP BY ws) "
    f"SELECT strftime(ws, {_TSF}) AS window_start, dlq, sent, "
    "CAST(dlq AS DOUBLE) / nullif(CAST(sent + dlq AS DOUBLE), 0) * 100.0 AS dlq_percent FROM _g"
)
ORACLE["stream_progress"] = duckdb_cte("user_messages", "raw_responses", "dead_letters") + (
    "SELECT 'users' AS query, count(*) AS rows, 0 AS late_rows FROM user_messages UNION ALL "
    "SELECT 'ingest', count(*), 0 FROM raw_responses UNION ALL SELECT 'dlq_stats', count(*), 0 FROM dead_letters"
)
ORACLE["sliding_quantiles"] = _L + (
    ", _s AS (SELECT l.*, time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(k) AS ws FROM delivery_log l, range(5) AS t(k))"
    f", _g AS (SELECT ws, {_qb}, count(batch_seconds) AS cnt FROM _s GROUP BY ws) "
    f"SELECT strftime(ws, {_TSF}) AS window_start, cnt, {_quantile(0.5, BATCH_BOUNDS)} AS p50, "
    f"{_quantile(0.99, BATCH_BOUNDS)} AS p99 FROM _g"
)
ORACLE["counter_increase"] = _L + (
    ", _n AS (SELECT series, time_bucket(INTERVAL 15 SECOND, ts) + INTERVAL 15 SECOND AS seen, count(*) AS n FROM delivery_log GROUP BY ALL)"
    ", _v AS (SELECT series, seen, sum(n) OVER (PARTITION BY series, epoch_us(seen) // 21600000000 ORDER BY seen) AS value FROM _n)"
    ", _i AS (SELECT series, seen, value, lag(value) OVER (PARTITION BY series ORDER BY seen, value) AS before FROM _v)"
    ", _d AS (SELECT series, time_bucket(INTERVAL 1 MINUTE, seen) AS ws, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value "
    "ELSE value - before END AS grown, value < before AS reset FROM _i) "
    f"SELECT series, strftime(ws, {_TSF}) AS window_start, CAST(sum(grown) AS DOUBLE) AS increase, count(*) FILTER (WHERE reset) AS resets, "
    "CAST(sum(grown) AS DOUBLE) / 60 AS rate FROM _d GROUP BY series, ws"
)
ORACLE["dlq_status"] = _L + (
    ", _t AS (SELECT count(*) FILTER (WHERE series = 'dlq') AS dlq_total FROM delivery_log) "
    f"SELECT dlq_total, CASE WHEN dlq_total >= 1 THEN 'red' ELSE 'green' END AS status FROM _t"
)
