"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables through a fixture (FIXTURES.md 3) and
applies one operator family over the whole table.  The matching DuckDB
SQL lives in ``tollgate.plans.oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.functions import text as T
from tollgate.functions import variant as V
from tollgate.functions.address import build_address
from tollgate.functions.ids import stable_user_id
from tollgate.operators import contracts as C
from tollgate.operators import route as R
from tollgate.operators.users import flatten_user, unwrap_response
from tollgate.operators import deadletters as D
from tollgate.operators.fetches import RETRY_SCHEMA, RetryPolicy
from tollgate.operators import telemetry as TM
from tollgate.plans import fixtures as FX
from tollgate.session import fresh_dir
from tollgate.sources import due_queue as Q
from tollgate.sources import messages as M
from tollgate.sources import sinks as S
from tollgate.sources import user_state as US
from tollgate.streaming import pipeline as ST
from tollgate.streaming import progress as PG
from tollgate.streaming import rates as RT
from tollgate.streaming import replay as RP

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed run time for dead letters and ages, so reruns and the oracle agree.
RUN_NOW = "2024-02-01T00:00:00Z"
RUN_START = "2024-01-31T23:58:47.5Z"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def routed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.route(FX.raw_responses(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with a ``results[0]`` (envelope passed), user as VARIANT."""
    rr = V.with_parsed(FX.raw_responses(spark, sf_dir).select("response_id", "body"), "body", "p")
    rr = rr.where(C.envelope_errors(F.col("body"), F.col("p")).isNull())
    return rr.select("response_id", unwrap_response(F.col("p")).alias("u"))


# --------------------------------------------------------------------------- C7, E1
@query
def route_outcomes(spark, sf_dir):
    """Flagship: landed responses -> parse once -> C1 -> C2 -> B11 -> C3 -> C7,
    counted per (stage, first error)."""
    return R.route_outcomes(routed_responses(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    """Successes, failures and success rate of one routing run."""
    from tollgate.operators.telemetry import run_summary as summary

    return summary(routed_responses(spark, sf_dir), RUN_START, RUN_NOW)


@query
def route_outcomes_normalized(spark, sf_dir):
    """C7 with R1's other choice: genders normalised before contract 2."""
    return R.route_outcomes(R.route(FX.raw_responses(spark, sf_dir), normalize_first=True))


# --------------------------------------------------------------------------- C1-C3
@query
def envelope_errors(spark, sf_dir):
    rr = FX.raw_responses(spark, sf_dir).select("response_id", "body", V.parse_body("body").alias("p"))
    return rr.select("response_id", C.envelope_errors(F.col("body"), F.col("p")).alias("envelope_error"))


@query
def api_contract_errors(spark, sf_dir):
    checked = C.check_contract(_users(spark, sf_dir), "u", C.API_USER, out="e")
    return checked.select("response_id", F.size("e").alias("n_errors"), F.array_join("e", " | ").alias("errors"))


@query
def user_contract_errors(spark, sf_dir):
    """C3 on topic messages: every message value checked as JSON, unknown
    keys included."""
    from tollgate.sources.messages import message_text

    msgs = FX.user_messages(spark, sf_dir).select("partition", "offset", message_text().alias("t"))
    msgs = V.with_parsed(msgs, "t", "v").drop("t")
    checked = C.check_contract(msgs, "v", C.USER, out="e")
    return checked.select(
        "partition", "offset", F.size("e").alias("n_errors"), F.array_join("e", " | ").alias("errors")
    )


# --------------------------------------------------------------------------- B3-B11
@query
def unwrap_response_q(spark, sf_dir):
    u = F.col("u")
    return _users(spark, sf_dir).select(
        "response_id", V.python_type_name(u).alias("user_type"), V.py_text(V.get(u, "gender")).alias("gender_raw")
    )


@query
def nested_get(spark, sf_dir):
    """Present, missing, null parent, text parent and deep lookups."""
    p = V.parse_body(F.col("body"))
    rr = FX.raw_responses(spark, sf_dir).select("response_id", p.alias("p"))
    return rr.select(
        "response_id",
        V.nested(F.col("p"), "results", 0, "name", "first", default="Unknown").alias("first"),
        V.nested(F.col("p"), "results", 0, "location", "street", "number", default="").alias("street_number"),
        V.nested(F.col("p"), "results", 0, "name", "middle", default="").alias("middle"),
        V.nested(F.col("p"), "results", 0, "email", "domain", default="n/a").alias("through_text"),
        V.nested(F.col("p"), "info", "seed", default="none").alias("seed"),
    )


@query
def flatten_user_q(spark, sf_dir):
    return _users(spark, sf_dir).select("response_id", *flatten_user(F.col("u")))


@query
def stable_user_id_q(spark, sf_dir):
    u = F.col("u")
    email = V.py_text(V.get(u, "email"))
    reg = V.nested(u, "registered", "date", default="")
    return _users(spark, sf_dir).select("response_id", stable_user_id(email, reg).alias("id"))


@query
def build_address_q(spark, sf_dir):
    return _users(spark, sf_dir).select("response_id", build_address(V.get(F.col("u"), "location")).alias("address"))


@query
def normalize_gender_q(spark, sf_dir):
    g = V.py_text(V.get(F.col("u"), "gender"))
    return _users(spark, sf_dir).select("response_id", g.alias("gender_raw"), T.normalize_gender(g).alias("gender"))


@query
def postcode_text(spark, sf_dir):
    pc = F.coalesce(V.py_text(V.get(F.col("u"), "location", "postcode")), F.lit(""))
    return _users(spark, sf_dir).select("response_id", pc.alias("postcode"))


# --------------------------------------------------------------------------- B1, B2, A2, A4-A9
def _decoded(spark, sf_dir) -> DataFrame:
    return M.decode_messages(FX.user_messages(spark, sf_dir), keep=("partition", "offset", "timestamp"))


@query
def decode_messages(spark, sf_dir):
    return _decoded(spark, sf_dir).select("partition", "offset", *C.USER_COLUMNS)


@query
def malformed_messages(spark, sf_dir):
    bad = M.malformed_messages(_decoded(spark, sf_dir))
    reason = F.when(F.col(M.CORRUPT).isNotNull() | F.col("_no_data"), F.lit("undecodable")).otherwise(F.lit("no id"))
    return bad.select("partition", "offset", reason.alias("reason"))


@query
def message_json(spark, sf_dir):
    """Every decoded message as JSON text with nulls kept."""
    from tollgate.functions.jsonout import message_json as mj

    return _decoded(spark, sf_dir).select("partition", "offset", mj(*C.USER_COLUMNS).alias("json"))


@query
def is_uuid(spark, sf_dir):
    d = _decoded(spark, sf_dir)
    return d.select("partition", "offset", "id", T.is_uuid(F.col("id")).alias("is_uuid"))


def _accepted(spark, sf_dir) -> DataFrame:
    return R.accepted(routed_responses(spark, sf_dir))


@query
def publish_encode(spark, sf_dir):
    """A4: accepted users as topic messages (value = JSON, key = id)."""
    pub = S.publish_messages(_accepted(spark, sf_dir), "user_data", key="id")
    return pub.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic")


@query
def is_email(spark, sf_dir):
    u = routed_responses(spark, sf_dir).where(F.col("user").isNotNull())
    return u.select("response_id", F.col("user.email").alias("email"), T.is_email(F.col("user.email")).alias("is_email"))


def _good(spark, sf_dir) -> DataFrame:
    return S.with_order(M.wellformed_messages(_decoded(spark, sf_dir)))


@query
def upsert_latest(spark, sf_dir):
    """A5+A6: one batch upserted, then the latest row per id."""
    path = fresh_dir(spark, "users")
    S.upsert_users(_good(spark, sf_dir), 0, path)
    return S.current_users(spark, path)


def _three_batches(spark, sf_dir) -> str:
    """A change log of three batches, one per topic partition, written in one pass."""
    path = fresh_dir(spark, "users")
    best = S.latest_per_id(_good(spark, sf_dir).withColumn("batch_id", F.col("_partition")), key=("batch_id", "id"))
    best.write.partitionBy("batch_id").parquet(path)
    return path


@query
def current_users(spark, sf_dir):
    """A6 over a change log of three batches."""
    return S.current_users(spark, _three_batches(spark, sf_dir))


@query
def compacted_users(spark, sf_dir):
    """A6 with compaction: the state after three batches, and the first batch once more after it."""
    path, compacted = _three_batches(spark, sf_dir), fresh_dir(spark, "compacted")
    S.compact_users(spark, path, compacted)
    again = spark.read.parquet(f"{path}/batch_id=0")
    S.upsert_users(again, 3, path)
    return S.current_users(spark, path, compacted)


def _bucketed(spark, sf_dir) -> tuple[str, str]:
    """A change log of four batches, and a bucketed state brought up to date after the first and the third."""
    path, folder = fresh_dir(spark, "users"), fresh_dir(spark, "bucketed")
    order = _three_batches(spark, sf_dir)
    for n in range(3):
        S.upsert_users(spark.read.parquet(f"{order}/batch_id={n}"), n, path)
        if n != 1:
            US.compact(spark, path, folder, buckets=8)
    S.upsert_users(spark.read.parquet(f"{order}/batch_id=0"), 3, path)
    return path, folder


@query
def bucketed_users(spark, sf_dir):
    """A6 as a bucketed state: two compactions, the second a merge, and an old batch once more after them."""
    return US.users(spark, *_bucketed(spark, sf_dir), buckets=8)


@query
def users_looked_up(spark, sf_dir):
    """A6 by id: the smallest and the largest id of the table, each read from its own bucket."""
    path, folder = _bucketed(spark, sf_dir)
    ends = US.state(spark, folder, 8).agg(F.min("id"), F.max("id")).first()
    return US.lookup(spark, path, folder, list(ends), buckets=8)


@query
def replay_idempotent(spark, sf_dir):
    """batch 1 written twice (a replay) leaves the same table."""
    path = fresh_dir(spark, "users")
    S.upsert_users(_good(spark, sf_dir), 0, path)
    written = spark.read.parquet(f"{path}/batch_id=0")
    S.upsert_users(written, 1, path)
    S.upsert_users(written, 1, path)
    return S.current_users(spark, path)


@query
def users_table_schema(spark, sf_dir):
    """Create the user table if missing (twice: idempotent), fill it
    with the accepted users, read it back; the table goes, its files stay to be read."""
    import uuid as _uuid

    name = f"users_{_uuid.uuid4().hex[:12]}"
    loc = fresh_dir(spark, "users_table")
    S.ensure_users_table(spark, name, loc)
    S.ensure_users_table(spark, name, loc)
    _accepted(spark, sf_dir).select(*C.USER_COLUMNS).write.insertInto(name)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(loc)


@query
def to_dead_letters(spark, sf_dir):
    return D.to_dead_letters(routed_responses(spark, sf_dir), RUN_NOW)


def _letters_written(spark, sf_dir) -> str:
    path = fresh_dir(spark, "dead_letters")
    S.write_dead_letters(D.to_dead_letters(routed_responses(spark, sf_dir), RUN_NOW), "parquet", path)
    return path


@query
def dead_letters_written(spark, sf_dir):
    """Dead letters written to their topic; the messages' JSON read back."""
    schema = "original_message STRING, error_type STRING, error_message STRING, timestamp STRING, retry_count INT, source_topic STRING"
    rows = spark.read.parquet(_letters_written(spark, sf_dir))
    return rows.select(F.from_json(M.message_text(), schema).alias("m")).select("m.*")


@query
def dead_letters_roundtrip(spark, sf_dir):
    """A7 -> A8: the reader's view of the letters that the writer wrote."""
    read = M.read_dead_letters(spark.read.parquet(_letters_written(spark, sf_dir)))
    return read.drop("partition", "offset")


# --------------------------------------------------------------------------- D2-D7, A8, C9, C10
def _dl(spark, sf_dir) -> DataFrame:
    return M.read_dead_letters(FX.dead_letters(spark, sf_dir))


@query
def dlq_read_bounded(spark, sf_dir):
    """A2: the first 1000 messages of the dead-letter topic (bounded read)."""
    source = M.MessageSource(topic="user_data_dlq", path=_stage_files(spark, FX.dead_letters(spark, sf_dir), "topic_dlq"))
    return M.read_message_batch(spark, source, 1000).select("partition", "offset", M.message_text().alias("value"))


@query
def dlq_decode(spark, sf_dir):
    return _dl(spark, sf_dir)


@query
def dlq_age_hours(spark, sf_dir):
    d = _dl(spark, sf_dir).where("readable")
    return d.select("partition", "offset", "timestamp", D.age_hours(F.col("timestamp"), RUN_NOW).alias("age_hours"))


@query
def dlq_stats(spark, sf_dir):
    """D3 with the reference's default: the first 1000 readable letters."""
    return D.dead_letter_stats(_dl(spark, sf_dir), RUN_NOW, max_messages=1000)


@query
def dlq_stats_all(spark, sf_dir):
    """D3 over the whole dead-letter topic."""
    return D.dead_letter_stats(_dl(spark, sf_dir), RUN_NOW)


@query
def dlq_error_types_first_1000(spark, sf_dir):
    """D4 with the reference's default bound."""
    return D.error_type_counts(_dl(spark, sf_dir), 1000)


@query
def dlq_undecodable(spark, sf_dir):
    return D.undecodable_count(_dl(spark, sf_dir))


@query
def dlq_error_types(spark, sf_dir):
    return D.error_type_counts(_dl(spark, sf_dir))


@query
def replay_plan(spark, sf_dir):
    """D5 over the whole topic (every letter gets an outcome)."""
    return D.plan_replay(_dl(spark, sf_dir), max_messages=None)


@query
def replay_plan_first_100(spark, sf_dir):
    """D5 with the reference's default bound of 100 letters."""
    return D.plan_replay(_dl(spark, sf_dir), max_messages=100)


@query
def replay_published(spark, sf_dir):
    """D5 -> A4: the messages that a replay of the whole topic sends."""
    sent = D.replay_messages(D.plan_replay(_dl(spark, sf_dir)))
    path = fresh_dir(spark, "replayed")
    S.write_messages(sent, "parquet", path)
    return spark.read.parquet(path).select(M.message_text().alias("value"), "topic")


@query
def replay_ledger(spark, sf_dir):
    """D5 as a consumer group: three runs over a growing topic, the second of which can't send; what was sent, when."""
    topic, letters = fresh_dir(spark, "replayed"), _dl(spark, sf_dir)
    ledger, send = fresh_dir(spark, "ledger"), RP.to_topic(topic, now=RUN_NOW)

    def down(messages, run_id):
        raise ConnectionError("no broker")

    RP.replay(letters.where("offset % 3 = 0"), ledger, 0, send)
    try:
        RP.replay(letters, ledger, 1, down)
    except ConnectionError:
        RP.compact_ledger(spark, ledger)
    RP.replay(letters, ledger, 2, send)
    RP.replay(letters, ledger, 3, send)  # nothing is left
    plans = [spark.read.schema(RP.PLAN_SCHEMA).parquet(f"{ledger}/plan={n}").withColumn("run", F.lit(n)) for n in (0, 2, 3)]
    plan = plans[0].unionByName(plans[1]).unionByName(plans[2])
    sent = spark.read.parquet(topic).select(F.col("batch_id").cast("int").alias("run"), M.message_text().alias("value"), "topic")
    told = RP.sent_letters(spark, ledger).join(plan.where("outcome = 'retried'"), ["partition", "offset", "run"])
    told = told.select("partition", "offset", "run", F.col("target_topic").alias("topic"), F.col("body").alias("value"))
    counted = sent.groupBy("run", "value", "topic").agg(F.count(F.lit(1)).alias("n"))
    again = told.groupBy("run", "value", "topic").agg(F.count(F.lit(1)).alias("n"))
    matching = counted.intersect(again).drop("n")  # every message in the topic as often as the ledger has it
    return told.join(matching, ["run", "value", "topic"], "left_semi").select("partition", "offset", F.col("run").cast("int"), "topic", "value")


@query
def replay_summary(spark, sf_dir):
    return D.replay_summary(D.plan_replay(_dl(spark, sf_dir), max_messages=None))


@query
def dlq_sample(spark, sf_dir):
    return D.sample_dead_letters(_dl(spark, sf_dir), 5)


@query
def is_transient(spark, sf_dir):
    d = _dl(spark, sf_dir).where("readable")
    return d.select("partition", "offset", "error_type", R.is_transient(F.col("error_type")).alias("is_transient"))


@query
def is_replayable(spark, sf_dir):
    d = _dl(spark, sf_dir).where("readable")
    return d.select(
        "partition", "offset", "error_type", "retry_count",
        R.is_replayable(F.col("error_type"), F.col("retry_count")).alias("is_replayable"),
    )


# --------------------------------------------------------------------------- C8, C11, B13, E2
def _classified(spark, sf_dir) -> DataFrame:
    f = FX.fetch_log(spark, sf_dir)
    return f.select("fetch_id", "status", "attempt", "ts",
                    *R.classify_fetch(F.col("status"), F.col("body"), F.col("retry_after"), F.col("failure"), body_chars=500))


@query
def classify_fetch(spark, sf_dir):
    return _classified(spark, sf_dir).drop("ts", "attempt")


@query
def error_text(spark, sf_dir):
    c = _classified(spark, sf_dir).where(F.col("outcome") == "error")
    return c.select("fetch_id", T.error_text(F.col("error_message"), status=F.col("status_code")).alias("text"))


@query
def validation_error_text(spark, sf_dir):
    t = FX.text_cells(spark, sf_dir)
    return t.select("doc_id", T.error_text(F.lit("Validation failed"), field=F.lit("text"), value=F.col("cell"), value_chars=50).alias("text"))


@query
def backoff_schedule(spark, sf_dir):
    from tollgate.functions.backoff import backoff_delay

    c = _classified(spark, sf_dir).where(F.col("is_transient"))
    delay = backoff_delay(F.col("attempt"))
    nxt = F.col("ts") + F.make_dt_interval(secs=delay)
    return c.select("fetch_id", "attempt", delay.alias("delay_seconds"),
                    F.date_format(nxt, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("next_attempt_at"))


@query
def fetch_stats(spark, sf_dir):
    return TM.fetch_stats(_classified(spark, sf_dir))


@query
def responses_landed(spark, sf_dir):
    """A3: landed fetch rows written as JSON files and read back."""
    path = fresh_dir(spark, "landed")
    FX.fetch_log(spark, sf_dir).write.options(**M.LANDED_JSON_OPTIONS).json(path)
    return M.read_landed_responses(spark, path, "json")


# --------------------------------------------------------------------------- B5, B6, C4
def _cells(spark, sf_dir) -> DataFrame:
    return FX.text_cells(spark, sf_dir)


@query
def clean_string(spark, sf_dir):
    c = F.col("cell")
    cleaned = T.clean_string(c, "")
    return _cells(spark, sf_dir).select(
        "doc_id",
        F.length(cleaned).alias("cleaned_len"),
        F.md5(cleaned).alias("cleaned_md5"),
        T.clean_string(c, "N/A", max_length=100).alias("cut100"),
        F.md5(T.clean_string(c, "", strip=False)).alias("raw_md5"),
    )


@query
def clean_email(spark, sf_dir):
    e = T.clean_email(F.col("cell"))
    return _cells(spark, sf_dir).select("doc_id", F.length(e).alias("len"), F.md5(e).alias("email_md5"))


@query
def missing_fields(spark, sf_dir):
    m = C.missing_fields({"cell": F.col("cell"), "lang": F.col("lang"), "source": F.col("source")})
    return _cells(spark, sf_dir).select("doc_id", F.array_join(m, ",").alias("missing"))


# --------------------------------------------------------------------------- E2-E8
def _log(spark, sf_dir) -> DataFrame:
    return FX.delivery_log(spark, sf_dir)


@query
def delivery_stats(spark, sf_dir):
    return TM.delivery_stats(_log(spark, sf_dir))


@query
def counter_totals(spark, sf_dir):
    return TM.counter_totals(_log(spark, sf_dir))


@query
def rate_per_second(spark, sf_dir):
    return TM.rate_per_second(_log(spark, sf_dir))


@query
def rate_odd_slide(spark, sf_dir):
    """E4 with a slide that doesn't divide the window."""
    return TM.rate_per_second(_log(spark, sf_dir), "1 minute", "25 seconds")


@query
def rate_five_minutes(spark, sf_dir):
    """E4 over tumbling windows of another length."""
    return TM.rate_per_second(_log(spark, sf_dir), "5 minutes", None)


@query
def dead_letter_share(spark, sf_dir):
    return TM.dead_letter_share(_log(spark, sf_dir))


@query
def duration_histogram(spark, sf_dir):
    both = {"send": ("send_seconds", TM.SEND_BOUNDS), "batch": ("batch_seconds", TM.BATCH_BOUNDS)}
    out = TM.histograms(_log(spark, sf_dir), both)
    return out.withColumn("total_sum", F.round("total_sum", 4))


@query
def duration_quantiles(spark, sf_dir):
    out = TM.duration_quantiles(_log(spark, sf_dir))
    return out.withColumns({p: F.round(p, 9) for p in ("p50", "p99")})


@query
def sliding_quantiles(spark, sf_dir):
    """E7 over sliding windows, from two halves' bucket vectors added up."""
    log = _log(spark, sf_dir)
    halves = [TM.bucket_vectors(log.where(F.col("event_id") % 2 == k)) for k in range(2)]
    merged = TM.merged_vectors(halves[0].unionByName(halves[1]), len(TM.BATCH_BOUNDS), ("step",))
    out = TM.sliding_quantiles(merged)
    return out.withColumns({p: F.round(p, 9) for p in ("p50", "p99")})


def _scrapes(spark, sf_dir) -> DataFrame:
    """The delivery log's totals as a scraper sees them: a sample for each 15 seconds with events, a reset every six hours."""
    log = _log(spark, sf_dir).groupBy("series", F.window("ts", "15 seconds")["end"].alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    life = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 21_600_000_000)
    w = Window.partitionBy("series", life).orderBy("ts")
    return log.select("series", "ts", F.sum("n").over(w).alias("value"))


@query
def counter_increase(spark, sf_dir):
    """E3, E4 on scraped counters that now and then begin again at zero."""
    return TM.counter_increase(_scrapes(spark, sf_dir))


@query
def dlq_status(spark, sf_dir):
    return TM.dlq_status(_log(spark, sf_dir))


# --------------------------------------------------------------------------- F1-F5, A1, E9
def _stage_files(spark, df: DataFrame, name: str, fmt: str = "parquet") -> str:
    """Land a derived table at its own partitioning (the stream's input folder)."""
    path = fresh_dir(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def _stream_users(spark, sf_dir):
    src_path = _stage_files(spark, FX.user_messages(spark, sf_dir), "topic_user_data")
    paths = ST.StreamPaths(table=fresh_dir(spark, "users"), dead_letters=fresh_dir(spark, "dlq"),
                           checkpoint=fresh_dir(spark, "ckpt"), batch_log=fresh_dir(spark, "batch_log"))
    src = M.MessageSource(topic="user_data", format="parquet", path=src_path)
    ST.run_user_stream(spark, src, paths, available_now=True, now=RUN_NOW)
    return paths


@query
def stream_users(spark, sf_dir):
    """the topic streamed into the change log; the final table equals the batch result."""
    return S.current_users(spark, _stream_users(spark, sf_dir).table)


@query
def batch_telemetry(spark, sf_dir):
    """Batches and records of the user stream, from its batch log."""
    return ST.batch_totals(ST.batch_log(spark, _stream_users(spark, sf_dir).batch_log))


@query
def stream_read_messages(spark, sf_dir):
    """A1: the message stream read through a file source into a table."""
    src_path = _stage_files(spark, FX.user_messages(spark, sf_dir), "topic_user_data")
    out, ckpt = fresh_dir(spark, "raw_copy"), fresh_dir(spark, "ckpt")
    stream = M.read_message_stream(spark, M.MessageSource(topic="user_data", path=src_path))
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("partition", "offset", M.message_text().alias("value"))


def _ingest(spark, sf_dir) -> ST.StreamPaths:
    landed = _stage_files(spark, FX.raw_responses(spark, sf_dir), "landed_responses", fmt="json")
    paths = ST.StreamPaths(table=fresh_dir(spark, "topic"), dead_letters=fresh_dir(spark, "dlq"),
                           checkpoint=fresh_dir(spark, "ckpt"), batch_log=fresh_dir(spark, "batch_log"))
    ST.run_ingest_stream(spark, landed, paths, RUN_NOW)
    return paths


@query
def stream_route(spark, sf_dir):
    """landed responses streamed through routing into both topics;
    rows per outcome read back from them."""
    paths = _ingest(spark, sf_dir)
    acc = spark.read.parquet(paths.table).select(F.lit("accepted").alias("outcome"))
    dl = M.read_dead_letters(spark.read.parquet(paths.dead_letters)).select(F.col("error_type").alias("outcome"))
    return acc.unionByName(dl).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def ingest_to_table(spark, sf_dir):
    """F4 -> topic -> F1: landed responses end as the latest row per id."""
    topic = M.MessageSource(topic="user_data", path=_ingest(spark, sf_dir).table)
    paths = ST.StreamPaths(table=fresh_dir(spark, "users"), dead_letters=fresh_dir(spark, "dlq"), checkpoint=fresh_dir(spark, "ckpt"))
    ST.run_user_stream(spark, topic, paths, now=RUN_NOW)
    return S.current_users(spark, paths.table)


# When the queries' retry rounds run; the landed fetches are spread over the two hours before the second.
ROUNDS = ("2024-01-31 01:00:00", "2024-01-31 02:10:00", "2024-01-31 02:10:04", "2024-01-31 02:10:30")


def _landed_fetches(spark, sf_dir) -> DataFrame:
    """A3's rows with every kind of outcome: responses, broken bodies, error statuses and no response."""
    return FX.raw_responses(spark, sf_dir).select(*[F.expr(e.format(ntz="TIMESTAMP_NTZ")).alias(n) for n, e in FX.LANDED_FETCH.items()])


def _fetch_again(spark, sf_dir, now: str):
    """A stand-in for the client: the next answer follows from id and attempt."""

    def fetch(due: DataFrame) -> DataFrame:
        bodies = FX.build(spark, sf_dir, "raw_responses", wanted=due)
        return bodies.select(*[F.expr(e.format(ntz="TIMESTAMP_NTZ")).alias(n) for n, e in FX.fetched_again(now).items()])

    return fetch


def _ingest_fetches(spark, sf_dir, rounds: int = 0) -> ST.StreamPaths:
    landed = fresh_dir(spark, "landed")
    _landed_fetches(spark, sf_dir).write.options(**M.LANDED_JSON_OPTIONS).json(landed)
    paths = ST.StreamPaths(*[fresh_dir(spark, n) for n in ("topic", "dlq", "ckpt", "batch_log", "retries")])
    policy, claims = RetryPolicy(), fresh_dir(spark, "claims")
    ST.run_ingest_stream(spark, landed, paths, RUN_NOW, policy=policy)
    for k, now in enumerate(ROUNDS[:rounds]):
        ST.run_retry_round(spark, paths, claims, k, now, _fetch_again(spark, sf_dir, now), policy)
    return paths


def _sink_counts(spark, paths: ST.StreamPaths) -> DataFrame:
    accepted = spark.read.parquet(paths.table).select(F.lit("accepted").alias("sink"), F.lit(None).cast("string").alias("error_type"), F.lit(0).alias("attempt"))
    letters = M.read_dead_letters(spark.read.parquet(paths.dead_letters))
    letters = letters.select(F.lit("dead_letter").alias("sink"), "error_type", F.col("retry_count").cast("int").alias("attempt"))
    again = Q.queued(spark, paths.retries, RETRY_SCHEMA).select(F.lit("retry").alias("sink"), "error_type", "attempt")
    return accepted.unionByName(letters).unionByName(again).groupBy("sink", "error_type", "attempt").agg(F.count(F.lit(1)).alias("n"))


@query
def ingest_fetches(spark, sf_dir):
    """F4 on A3 with C8: landed fetches streamed into three sinks, counted there."""
    return _sink_counts(spark, _ingest_fetches(spark, sf_dir))


@query
def retry_rounds(spark, sf_dir):
    """Transient fetches come back in four rounds, until they succeed or have used up their tries."""
    return _sink_counts(spark, _ingest_fetches(spark, sf_dir, len(ROUNDS)))


@query
def retry_queue(spark, sf_dir):
    """Every row that the stream and four rounds of retries have put into the queue."""
    paths = _ingest_fetches(spark, sf_dir, len(ROUNDS))
    due = F.date_format("due", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("due")
    return Q.queued(spark, paths.retries, RETRY_SCHEMA).select("fetch_id", "attempt", "error_type", "status", due)


def _rate_stream(spark, sf_dir) -> str:
    """The delivery log streamed in four pieces, in order of time, the second of them delivered twice."""
    log = _log(spark, sf_dir).select("event_id", "series", "ts").persist()
    landed, out = fresh_dir(spark, "log"), fresh_dir(spark, "windows")
    try:
        cuts = log.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t")).agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
        t = F.unix_micros(F.col("ts").cast("timestamp"))
        step = (cuts["b"] - cuts["a"]) // 4 + 1
        for k, piece in enumerate((0, 1, 1, 2, 3)):
            rows = log.where((t >= cuts["a"] + piece * step) & (t < cuts["a"] + (piece + 1) * step))
            rows.coalesce(1).write.mode("append").parquet(f"{landed}/piece={k}")
    finally:
        log.unpersist()
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{landed}/piece=*")
    RT.run_rate_stream(stream, out, fresh_dir(spark, "ckpt"))
    return out


@query
def stream_rates(spark, sf_dir):
    """E4 as a running stream: the rates of all windows that the watermark has passed."""
    return RT.rates_now(spark, _rate_stream(spark, sf_dir))


@query
def stream_shares(spark, sf_dir):
    """E5 as a running stream."""
    return RT.shares_now(spark, _rate_stream(spark, sf_dir))


@query
def stream_progress(spark, sf_dir):
    """E9 from query progress: rows that F1, F4 and F5 report, batch by batch, added up."""
    path = fresh_dir(spark, "progress")
    with PG.watched(spark, path):
        _stream_users(spark, sf_dir)
        _ingest(spark, sf_dir)
        _dlq_stream(spark, sf_dir)
    return PG.progress(spark, path).groupBy("query").agg(F.sum("input_rows").alias("rows"), F.sum("late_rows").alias("late_rows"))


def _dlq_stream(spark, sf_dir) -> str:
    src_path = _stage_files(spark, FX.dead_letters(spark, sf_dir), "topic_dlq")
    out, ckpt = fresh_dir(spark, "dlq_stats"), fresh_dir(spark, "ckpt")
    ST.run_dlq_stats_stream(spark, M.MessageSource(topic="user_data_dlq", path=src_path), out, ckpt)
    return out


@query
def stream_dlq_stats(spark, sf_dir):
    """error-type counts kept by a streaming aggregation."""
    return ST.dlq_stats_now(spark, _dlq_stream(spark, sf_dir)).select("error_type", "n")


@query
def stream_dlq_totals(spark, sf_dir):
    """D3's totals from the streamed counts."""
    return ST.dlq_totals(ST.dlq_stats_now(spark, _dlq_stream(spark, sf_dir)), RUN_NOW)


def spark_entry_queries() -> dict[str, Query]:
    """Public names (``_q`` suffix only avoids clashing with imports)."""
    return {k[:-2] if k.endswith("_q") else k: v for k, v in QUERIES.items()}
