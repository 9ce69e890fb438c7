"""Derived inputs (FIXTURES.md section 3) from the driver's parquet tables.

Each fixture is one SELECT: a join of driver tables plus column
expressions.  The expression texts are shared by the Spark builder and
the DuckDB oracle, so both engines see byte-identical inputs; the few
spots where the dialects differ carry one text per engine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Expr = str | dict  # text, or {"spark": text, "duckdb": text}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(e: Expr, dialect: str) -> str:
    return e if isinstance(e, str) else e[dialect]


@dataclass(frozen=True)
class Fixture:
    """``joins``: (table, alias, columns read, join condition or None for the
    first table); ``where``: optional filter; ``columns``: (alias, expr).
    ``spread``: the first table's rows are dealt out before the join, for rows
    that are small on disk and much work afterwards."""

    name: str
    joins: tuple[tuple[str, str, tuple[str, ...], str | None], ...]
    where: str | None
    columns: tuple[tuple[str, Expr], ...]
    spread: bool = False

    def source(self) -> str:
        out = []
        for tname, alias, _, on in self.joins:
            out.append(f"JOIN {tname} {alias} ON {on}" if on else f"FROM {tname} {alias}")
        if self.where:
            out.append(f"WHERE {self.where}")
        return " ".join(out)

    def duckdb_sql(self) -> str:
        cols = ",\n  ".join(f'{_pick(e, "duckdb")} AS "{a}"' for a, e in self.columns)
        return f"SELECT\n  {cols}\n{self.source()}"


# ---------------------------------------------------------------------------
# 3.1 raw_responses: customer x nation x region -> landed API response body
# ---------------------------------------------------------------------------
_K = "CAST(c.c_custkey AS STRING)"
_USER_JSON = (
    "'\"gender\":\"' || (CASE c.c_custkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'MALE' "
    "WHEN 3 THEN 'unknown' ELSE 'other' END) || '\",'"
    " || '\"name\":{\"title\":\"Mx\",\"first\":' || (CASE WHEN c.c_custkey % 41 = 0 THEN '\"\"' "
    "WHEN c.c_custkey % 37 = 0 THEN 'null' ELSE '\"  ' || c.c_mktsegment || ' \"' END)"
    " || ',\"last\":\"' || c.c_name || '\"},'"
    " || '\"location\":{\"street\":{\"number\":' || (CASE WHEN c.c_custkey % 43 = 0 THEN '\"x\"' ELSE " + _K + " END)"
    " || ',\"name\":\"Kiln Row\"},\"city\":\"' || (CASE WHEN c.c_custkey % 47 = 0 THEN '' ELSE n.n_name END)"
    " || '\",\"state\":\"' || r.r_name || '\",\"country\":\"C' || CAST(n.n_regionkey AS STRING) || '\",'"
    " || '\"postcode\":' || (CASE WHEN c.c_custkey % 29 = 0 THEN 'null' ELSE CAST(c.c_custkey * 7 AS STRING) END) || '},'"
    " || '\"email\":\"' || (CASE WHEN c.c_custkey % 31 = 0 THEN 'not-an-email' ELSE 'User' || " + _K + " || '@Example.COM' END) || '\",'"
    " || '\"login\":{\"uuid\":\"u-' || " + _K + " || '\",\"username\":\"u' || " + _K + " || '\"},'"
    " || '\"dob\":{\"date\":\"1967-11-08T21:14:37.512Z\",\"age\":57},'"
    " || '\"registered\":{\"date\":\"2013-02-27T16:45:09.204Z\",\"age\":11},'"
    " || '\"phone\":\"0161-40-77\",\"cell\":\"07700-31\","
    "\"picture\":{\"large\":\"https://pics.example/l.jpg\",\"medium\":\"https://pics.example/m.jpg\","
    "\"thumbnail\":\"https://pics.example/t.jpg\"},\"nat\":\"US\"'"
)
RAW_RESPONSES = Fixture(
    "raw_responses",
    (("customer", "c", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), None),
     ("nation", "n", ("n_nationkey", "n_name", "n_regionkey"), "c.c_nationkey = n.n_nationkey"),
     ("region", "r", ("r_regionkey", "r_name"), "n.n_regionkey = r.r_regionkey")),
    None,
    (
        ("response_id", "c.c_custkey"),
        (
            "body",
            "CASE WHEN c.c_custkey % 53 = 0 THEN '{\"info\":{}}'"
            " WHEN c.c_custkey % 59 = 0 THEN '{\"results\":[]}'"
            " WHEN c.c_custkey % 61 = 0 THEN '\"text\"'"
            " WHEN c.c_custkey % 67 = 0 THEN '{\"results\":[{\"gender\":\"male\",\"name\":{'"
            " ELSE '{\"results\":[{' || " + _USER_JSON + " || '}],\"info\":{\"seed\":\"tg\",\"results\":1,\"page\":1,\"version\":\"1.4\"}}' END",
        ),
    ),
    spread=True,
)

# ---------------------------------------------------------------------------
# 3.2 user_messages: orders x customer -> Kafka-shaped topic rows
# ---------------------------------------------------------------------------
_CK = "CAST(c.c_custkey AS STRING)"
_H = "md5('user' || " + _CK + ")"
_ID = (
    f"substr({_H}, 1, 8) || '-' || substr({_H}, 9, 4) || '-' || substr({_H}, 13, 4) || '-' || "
    f"substr({_H}, 17, 4) || '-' || substr({_H}, 21, 12)"
)
_MSG_TAIL = (
    "'\"first_name\":\"' || (CASE WHEN o.o_orderkey % 107 = 0 THEN '' ELSE c.c_mktsegment END)"
    " || '\",\"last_name\":\"' || c.c_name"
    " || '\",\"gender\":\"' || (CASE WHEN o.o_orderkey % 101 = 0 THEN 'unknown' WHEN c.c_custkey % 3 = 0 THEN 'male' "
    "WHEN c.c_custkey % 3 = 1 THEN 'female' ELSE 'other' END)"
    " || '\",\"address\":\"' || " + _CK + " || ' Kiln Row, ' || n.n_name || ', ' || r.r_name"
    " || '\",\"email\":\"user' || " + _CK + " || '@example.com\",\"username\":\"u' || " + _CK
    + " || '\",\"dob\":\"1967-11-08T21:14:37.512Z\",\"registered_date\":\"2013-02-27T16:45:09.204Z\""
    ",\"phone\":\"' || CAST(o.o_orderkey AS STRING) || '\",\"picture\":\"https://pics.example/m.jpg\"'"
    " || (CASE WHEN o.o_orderkey % 103 = 0 THEN ',\"nickname\":\"x\"' ELSE '' END) || '}'"
)
USER_MESSAGES = Fixture(
    "user_messages",
    (("orders", "o", ("o_orderkey", "o_custkey", "o_orderdate"), None),
     ("customer", "c", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "o.o_custkey = c.c_custkey"),
     ("nation", "n", ("n_nationkey", "n_name", "n_regionkey"), "c.c_nationkey = n.n_nationkey"),
     ("region", "r", ("r_regionkey", "r_name"), "n.n_regionkey = r.r_regionkey")),
    None,
    (
        ("key", {"spark": "CAST(NULL AS BINARY)", "duckdb": "CAST(NULL AS BLOB)"}),
        (
            "value_text",
            "CASE WHEN o.o_orderkey % 97 = 0 THEN '{\"id\":'"
            " WHEN o.o_orderkey % 89 = 0 THEN '{' || " + _MSG_TAIL +
            " ELSE '{\"id\":\"' || " + _ID + " || '\",' || " + _MSG_TAIL + " END",
        ),
        ("topic", "'user_data'"),
        ("partition", "CAST(o.o_orderkey % 3 AS INT)"),
        ("offset", {"spark": "CAST(o.o_orderkey DIV 3 AS BIGINT)", "duckdb": "CAST(o.o_orderkey // 3 AS BIGINT)"}),
        ("timestamp", {"spark": "CAST(o.o_orderdate AS TIMESTAMP)", "duckdb": "CAST(o.o_orderdate AS TIMESTAMP)"}),
        ("timestampType", "0"),
    ),
)

# ---------------------------------------------------------------------------
# 3.3 dead_letters: error events -> dead-letter topic rows
# ---------------------------------------------------------------------------
_ET = (
    "(CASE e.event_id % 6 WHEN 0 THEN 'ConnectionError' WHEN 1 THEN 'TimeoutError' WHEN 2 THEN 'CassandraWriteError' "
    "WHEN 3 THEN 'KafkaConnectionError' WHEN 4 THEN 'DataValidationError' ELSE 'TransformationError' END)"
)
# poison bodies (repeated keys, text after the object) only where the body is JSON text inside the letter
_BODY = (
    "(CASE WHEN e.event_id % 71 = 0 THEN '[1]' WHEN e.event_id % 2 = 1 AND e.event_id % 73 = 0 THEN '{\"a\":1,\"a\":2}' "
    "WHEN e.event_id % 2 = 1 AND e.event_id % 67 = 0 THEN '{\"a\":1} junk' ELSE e.props END)"
)
_TS_TEXT = {
    "spark": "(CASE WHEN e.event_id % 83 = 0 THEN 'bad' WHEN e.event_id % 59 = 0 THEN '12:30' WHEN e.event_id % 61 = 0 THEN '2024-01' WHEN e.event_id % 53 = 0 THEN '2024-01-31' ELSE date_format(e.ts, 'yyyy-MM-dd''T''HH:mm:ss.SSSSSS') || 'Z' END)",
    "duckdb": "(CASE WHEN e.event_id % 83 = 0 THEN 'bad' WHEN e.event_id % 59 = 0 THEN '12:30' WHEN e.event_id % 61 = 0 THEN '2024-01' WHEN e.event_id % 53 = 0 THEN '2024-01-31' ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END)",
}
_TOPIC = "(CASE WHEN e.event_id % 7 = 0 THEN '' ELSE 'user_data' END)"
_MSG = "'failed event ' || CAST(e.event_id AS STRING)"
_RC = (
    "(CASE WHEN e.event_id % 47 = 0 THEN '99999999999' WHEN e.event_id % 43 = 0 THEN '1e30' "
    "ELSE CAST(e.user_id % 5 AS STRING) END)"
)


def _dl_value(dialect: str) -> str:
    ts = _TS_TEXT[dialect]
    writer = (
        "'{\"original_message\":\"' || replace(" + _BODY + ", '\"', chr(92) || '\"') || '\",\"error_type\":\"' || "
        + _ET + " || '\",\"error_message\":\"' || " + _MSG + " || '\",\"timestamp\":\"' || " + ts
        + " || '\",\"retry_count\":' || " + _RC + " || ',\"source_topic\":\"' || " + _TOPIC + " || '\"}'"
    )
    reader = (
        "'{\"original_message\":' || " + _BODY + " || ',\"error_type\":\"' || " + _ET + " || '\",\"error\":\"' || "
        + _MSG + " || '\",\"timestamp\":\"' || " + ts + " || '\",\"retry_count\":' || " + _RC
        + " || ',\"topic\":\"' || " + _TOPIC + " || '\"}'"
    )
    return f"CASE WHEN e.event_id % 79 = 0 THEN 'not json' WHEN e.event_id % 2 = 1 THEN {writer} ELSE {reader} END"


DEAD_LETTERS = Fixture(
    "dead_letters",
    (("events", "e", ("event_id", "ts", "user_id", "event_type", "props"), None),),
    "e.event_type = 'error'",
    (
        ("value_text", {"spark": _dl_value("spark"), "duckdb": _dl_value("duckdb")}),
        ("topic", "'user_data_dlq'"),
        ("partition", "0"),
        ("offset", "e.event_id"),
        ("timestamp", "CAST(e.ts AS TIMESTAMP)"),
    ),
)

# ---------------------------------------------------------------------------
# 3.4 delivery_log: events -> sends, retries and dead letters with durations
# ---------------------------------------------------------------------------
DELIVERY_LOG = Fixture(
    "delivery_log",
    (("events", "e", ("event_id", "ts", "event_type", "value"), None),),
    None,
    (
        ("event_id", "e.event_id"),
        ("series", "CASE WHEN e.event_type = 'error' THEN 'dlq' WHEN e.event_type <> 'click' THEN 'sent' "
         "WHEN e.event_id % 19 = 0 THEN 'failed' ELSE 'retry' END"),
        ("ts", "e.ts"),
        ("batch_seconds", "CASE WHEN e.event_id % 17 <> 0 THEN e.value / 10 END"),
        ("send_seconds", "CASE WHEN e.event_id % 23 <> 0 THEN e.value / 100 END"),
    ),
)

# ---------------------------------------------------------------------------
# 3.5 fetch_log: events -> landed HTTP responses
# ---------------------------------------------------------------------------
FETCH_LOG = Fixture(
    "fetch_log",
    (("events", "e", ("event_id", "ts", "user_id", "props"), None),),
    None,
    (
        ("fetch_id", "e.event_id"),
        ("ts", "e.ts"),
        (
            "status",
            "CAST(CASE e.event_id % 10 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 WHEN 3 THEN 400 "
            "WHEN 4 THEN 404 WHEN 5 THEN NULL ELSE 200 END AS INT)",
        ),
        (
            "failure",
            "CASE WHEN e.event_id % 10 <> 5 THEN NULL WHEN e.event_id % 3 = 0 THEN 'timeout' "
            "WHEN e.event_id % 3 = 1 THEN 'connection' END",
        ),
        ("retry_after", "CAST(CASE WHEN e.event_id % 10 = 0 THEN 60 END AS INT)"),
        ("body", "CASE WHEN e.event_id % 10 = 5 THEN NULL WHEN e.event_id % 13 = 0 THEN substr(e.props, 1, 3) "
         "WHEN e.event_id % 14 = 0 THEN e.props || ' x' ELSE e.props END"),
        ("attempt", "CAST(e.user_id % 8 AS INT)"),
    ),
)

# ---------------------------------------------------------------------------
# 3.5b landed fetches of the raw responses, and what a second try gives (texts shared by Spark and DuckDB)
# ---------------------------------------------------------------------------
_FETCH_STATUS = (
    "CAST(CASE WHEN response_id % 12 = 0 THEN 429 WHEN response_id % 12 = 1 THEN 500 WHEN response_id % 12 = 2 THEN 503 "
    "WHEN response_id % 12 IN (3, 4, 5) THEN NULL WHEN response_id % 12 = 6 THEN 404 ELSE 200 END AS INT)"
)
LANDED_FETCH = {
    "fetch_id": "CAST(response_id AS BIGINT)",
    "ts": "CAST('2024-01-31 00:00:00' AS {ntz}) + response_id % 7200 * INTERVAL '1' SECOND",
    "status": _FETCH_STATUS,
    "failure": "CASE response_id % 12 WHEN 3 THEN 'timeout' WHEN 4 THEN 'connection' END",
    "retry_after": "CAST(CASE WHEN response_id % 24 = 0 THEN 60 END AS INT)",
    "body": "CASE WHEN response_id % 12 IN (3, 4, 5) THEN NULL WHEN response_id % 13 = 0 THEN substr(body, 1, 5) ELSE body END",
    "attempt": "CAST(0 AS INT)",
}


def fetched_again(now: str) -> dict[str, str]:
    """The answer to a later try, over (fetch_id, attempt, body)."""
    return {
        "fetch_id": "fetch_id",
        "ts": f"CAST('{now}' AS {{ntz}})",
        "status": "CAST(CASE WHEN (fetch_id + attempt) % 4 = 0 THEN 200 WHEN fetch_id % 7 = 0 THEN 429 ELSE 503 END AS INT)",
        "failure": "CAST(NULL AS STRING)",
        "retry_after": "CAST(CASE WHEN fetch_id % 7 = 0 THEN 5 END AS INT)",
        "body": "body",
        "attempt": "attempt",
    }


# ---------------------------------------------------------------------------
# 3.6 text_cells: documents -> padded whole texts, nulls and blanks
# ---------------------------------------------------------------------------
TEXT_CELLS = Fixture(
    "text_cells",
    (("documents", "d", ("doc_id", "text", "lang", "source"), None),),
    None,
    (
        ("doc_id", "d.doc_id"),
        (
            "cell",
            "CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 17 = 0 THEN '   ' ELSE '  ' || d.text || ' ' END",
        ),
        ("lang", "d.lang"),
        ("source", "d.source"),
    ),
)

FIXTURES = {f.name: f for f in (RAW_RESPONSES, USER_MESSAGES, DEAD_LETTERS, DELIVERY_LOG, FETCH_LOG, TEXT_CELLS)}



def build(spark: SparkSession, sf_dir: str, name: str, wanted: DataFrame | None = None) -> DataFrame:
    """The fixture as a Spark DataFrame.

    Tables are read with only the needed columns, joined with the DataFrame
    API (Catalyst picks broadcast or sort-merge from the table statistics),
    and the shared column texts are evaluated with ``F.expr``.  A table of a few
    MB is one task to Spark however many rows it holds, so with ``spread`` they
    are dealt out by hash, to as many tasks as a shuffle has: adaptive execution,
    which goes by bytes, doesn't lower a number that is given.

    ``wanted`` joins its rows to the first table's before the columns are built, by the first
    column of both, and its columns stay: wide bodies are neither built nor shuffled for other rows.
    """
    fx = FIXTURES[name]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df, kept = None, []
    for tname, alias, cols, on in fx.joins:
        t = table(spark, sf_dir, tname).select(*cols)
        if df is None and wanted is not None:
            kept = wanted.columns
            t = t.join(wanted, t[cols[0]] == wanted[kept[0]])
        if fx.spread and df is None:
            t = t.repartition(parts, *cols, *kept)
        t = t.alias(alias)
        df = t if df is None else df.join(t, F.expr(on), "inner")
    if fx.where:
        df = df.where(F.expr(fx.where))
    return df.select(*kept, *[F.expr(_pick(e, "spark")).alias(a) for a, e in fx.columns])


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "raw_responses")


def user_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka source shape: key, value (binary), topic, partition, offset, timestamp, timestampType."""
    df = build(spark, sf_dir, "user_messages")
    return df.select(
        "key", F.encode("value_text", "UTF-8").alias("value"), "topic", "partition", "offset", "timestamp", "timestampType"
    )


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = build(spark, sf_dir, "dead_letters")
    return df.select(F.encode("value_text", "UTF-8").alias("value"), "topic", "partition", "offset", "timestamp")


def delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "delivery_log")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "fetch_log")


def text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "text_cells")


def duckdb_cte(*names: str) -> str:
    """``WITH`` clause defining the named fixtures for the DuckDB oracle."""
    parts = [f"{n} AS (\n{FIXTURES[n].duckdb_sql()}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
