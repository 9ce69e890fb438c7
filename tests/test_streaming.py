"""Streaming: the streamed table equals the batch result; a replayed batch
changes nothing; a restart with the same checkpoint reads nothing twice."""

import json
import time

import pytest
from pyspark.sql import functions as F

from records import SF_SMALL, USER_RECORD, response, with_changes
from tollgate.operators import deadletters as D
from tollgate.operators import telemetry as TM
from tollgate.plans import fixtures as FX
from tollgate.session import fresh_dir
from tollgate.sources import messages as M
from tollgate.sources import sinks as S
from tollgate.streaming import pipeline as ST


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_restart(spark):
    src_path = fresh_dir(spark, "topic")
    FX.user_messages(spark, SF_SMALL).repartition(3).write.parquet(src_path)
    paths = ST.StreamPaths(table=fresh_dir(spark, "users"), dead_letters=fresh_dir(spark, "dlq"),
                           checkpoint=fresh_dir(spark, "ckpt"), batch_log=fresh_dir(spark, "log"))
    src = M.MessageSource(topic="user_data", path=src_path, max_per_trigger=1)
    ST.run_user_stream(spark, src, paths)
    streamed = S.current_users(spark, paths.table)

    batch_path = fresh_dir(spark, "users_batch")
    good = S.with_order(M.wellformed_messages(M.decode_messages(FX.user_messages(spark, SF_SMALL),
                                                                keep=("partition", "offset", "timestamp"))))
    S.upsert_users(good, 0, batch_path)
    assert _sorted(streamed) == _sorted(S.current_users(spark, batch_path))

    log = ST.batch_log(spark, paths.batch_log).collect()
    assert len(log) == 3
    total_in = FX.user_messages(spark, SF_SMALL).count()
    assert sum(r.rejected for r in log) == spark.read.parquet(paths.dead_letters).count()
    assert ST.batch_totals(ST.batch_log(spark, paths.batch_log)).first().batches == 3
    times = TM.histogram(ST.batch_log(spark, paths.batch_log), "seconds", TM.BATCH_BOUNDS, "batch").where("le = '+Inf'").first()
    assert times.total_count == 3 and times.total_sum > 0
    assert sum(r["rows"] for r in log) == total_in == 1500
    bad = spark.read.parquet(paths.dead_letters).count()
    assert bad == M.malformed_messages(M.decode_messages(FX.user_messages(spark, SF_SMALL))).count()
    assert bad < total_in

    # restart on the same checkpoint: nothing new, table unchanged
    ST.run_user_stream(spark, src, paths)
    assert len(ST.batch_log(spark, paths.batch_log).collect()) == 3
    assert _sorted(S.current_users(spark, paths.table)) == _sorted(streamed)


def test_replayed_batch_is_idempotent(spark):
    path = fresh_dir(spark, "users")
    good = S.with_order(M.wellformed_messages(M.decode_messages(FX.user_messages(spark, SF_SMALL),
                                                                keep=("partition", "offset", "timestamp"))))
    S.upsert_users(good, 7, path)
    once = _sorted(S.current_users(spark, path))
    rows_once = spark.read.parquet(path).count()
    S.upsert_users(good, 7, path)
    assert spark.read.parquet(path).count() == rows_once
    assert _sorted(S.current_users(spark, path)) == once


def test_latest_row_wins(spark):
    rows = [("a", "x1", 1, 0, 5), ("a", "x2", 2, 0, 1), ("a", "x3", 2, 1, 0), ("b", "y", 1, 0, 0)]
    df = spark.createDataFrame(rows, "id string, phone string, ts int, p int, o int")
    df = df.select("id", *[F.lit("v").alias(c) for c in ("first_name", "last_name", "gender", "address", "email",
                                                          "username", "dob", "registered_date", "picture")],
                   "phone", F.col("ts").alias("_ts"), F.col("p").alias("_partition"), F.col("o").alias("_offset"))
    got = {r.id: r.phone for r in S.latest_per_id(df).collect()}
    assert got == {"a": "x3", "b": "y"}


def topic(spark, values):
    """A topic folder with one file of messages, and its source."""
    path = fresh_dir(spark, "topic")
    rows = [(None, v.encode(), "user_data", 0, i, None, 0) for i, v in enumerate(values)]
    spark.createDataFrame(rows, M.KAFKA_SCHEMA).withColumn("timestamp", F.current_timestamp()).coalesce(1).write.parquet(path)
    return M.MessageSource(topic="user_data", path=path)


def stream_paths(spark):
    return ST.StreamPaths(*[fresh_dir(spark, n) for n in ("table", "letters", "ckpt", "log")])


def test_dead_letters_keep_the_message_and_the_time_of_their_batch(spark):
    said = ['{"first_name":"A","nickname":"zz"}', "", "not json", '{"first_name":"B","_retry_count":2}']
    paths = stream_paths(spark)
    before = ST._utc_now()
    ST.run_user_stream(spark, topic(spark, said), paths)
    got = M.read_dead_letters(spark.read.parquet(paths.dead_letters)).collect()
    assert sorted(r.original_message for r in got) == sorted(said)
    assert all(before <= r.timestamp <= ST._utc_now() for r in got)
    assert {r.original_message: r.retry_count for r in got}[said[3]] == 2
    assert (got[0].error_type, got[0].topic, got[0].readable) == ("DecodeError", "user_data", True)


def test_replays_count_up_until_the_limit(spark):
    letter = {"original_message": json.dumps({"first_name": "A"}), "error_type": "TimeoutError", "retry_count": 0, "source_topic": "user_data"}
    rounds = []
    for _ in range(4):
        letters = spark.createDataFrame([(json.dumps(letter).encode(), 0, 0)], "value binary, partition int, offset long")
        sent = D.replay_messages(D.plan_replay(M.read_dead_letters(letters))).collect()
        if not sent:
            break
        paths = stream_paths(spark)
        ST.run_user_stream(spark, topic(spark, [bytes(sent[0].value).decode()]), paths)
        back = M.read_dead_letters(spark.read.parquet(paths.dead_letters)).first()
        rounds.append(back.retry_count)
        letter |= {"original_message": back.original_message, "retry_count": back.retry_count}
    assert rounds == [1, 2, 3]


def test_ingest_to_topic_to_table(spark):
    bodies = [response(USER_RECORD), response(with_changes(phone="9")), "no json", response(with_changes(email="bad"))]
    landed = fresh_dir(spark, "landed")
    rows = list(enumerate(bodies))
    for piece in (rows[:2], rows[2:]):  # one file after another: a stream takes files by their time
        spark.createDataFrame(piece, "response_id long, body string").coalesce(1).write.mode("append").json(landed)
    first, then = stream_paths(spark), stream_paths(spark)
    ST.run_ingest_stream(spark, landed, first, max_files=1)
    log = ST.batch_log(spark, first.batch_log)
    assert log.count() >= 2  # the file limit
    t = ST.batch_totals(log).first()
    assert (t["rows"], t.written, t.rejected) == (4, 2, 2)
    letters = M.read_dead_letters(spark.read.parquet(first.dead_letters))
    assert D.dead_letter_stats(letters, ST._utc_now()).first().total_messages == 2
    assert {r.original_message for r in D.sample_dead_letters(letters, 5).collect()} == set(bodies[2:])
    ST.run_user_stream(spark, M.MessageSource(topic="user_data", path=first.table), then)
    assert [r.phone for r in S.current_users(spark, then.table).collect()] == ["9"]


def test_a_batch_that_fails_is_run_again(spark):
    source, paths = topic(spark, [json.dumps({"id": f"u{i % 3}", "phone": str(i)}) for i in range(9)] + ["bad"]), stream_paths(spark)

    def fail(batch, batch_id):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        ST.run_user_stream(spark, source, paths, on_batch=fail)
    ST.run_user_stream(spark, source, paths)
    assert sorted((r.id, r.phone) for r in S.current_users(spark, paths.table).collect()) == [("u0", "6"), ("u1", "7"), ("u2", "8")]
    assert spark.read.parquet(paths.dead_letters).count() == 1


def test_a_bounded_run_stops(spark):
    source, paths = topic(spark, [json.dumps({"id": "u"})]), stream_paths(spark)
    t0 = time.time()
    q = ST.run_user_stream(spark, source, paths, available_now=False, processing_time="1 second", timeout=8)
    assert not q.isActive and time.time() - t0 < 60
    assert S.current_users(spark, paths.table).count() == 1


def test_compaction_keeps_the_state_and_goes_on_from_it(spark):
    path, compacted = fresh_dir(spark, "users"), fresh_dir(spark, "compacted")

    def batch(n, rows):
        cols = [F.lit("v").alias(c) for c in M.USER_SCHEMA.fieldNames() if c not in ("id", "phone")]
        df = spark.createDataFrame(rows, "id string, phone string").select("id", "phone", *cols, F.lit(n).alias("_ts"), F.lit(0).alias("_partition"), F.lit(n).alias("_offset"))
        S.upsert_users(df, n, path)

    def now(**kw):
        return sorted((r.id, r.phone) for r in S.current_users(spark, path, **kw).collect())

    batch(0, [("a", "1"), ("b", "1")])
    assert now(compacted=compacted) == now()  # nothing compacted yet
    assert S.compact_users(spark, path, compacted) == 0
    batch(1, [("a", "2")])
    assert now(compacted=compacted) == now() == [("a", "2"), ("b", "1")]
    assert S.compact_users(spark, path, compacted) == 1 == S.compact_users(spark, path, compacted)
    assert now(compacted=compacted) == now()


def test_streamed_dead_letter_statistics_take_the_newest_complete_state(spark):
    out = fresh_dir(spark, "stats")
    assert ST.dlq_totals(ST.dlq_stats_now(spark, out), "2024-02-01T00:00:00Z").first().total_messages == 0
    path = fresh_dir(spark, "dlq")
    letters = [json.dumps({"error_type": t, "retry_count": r, "timestamp": "2024-01-31T22:00:00Z"}) for t, r in (("TimeoutError", 0), ("TimeoutError", 3), ("X", 0))]
    rows = [(None, v.encode(), "dlq", 0, i, None, 0) for i, v in enumerate(letters)]
    spark.createDataFrame(rows, M.KAFKA_SCHEMA).repartition(3).write.parquet(path)
    ST.run_dlq_stats_stream(spark, M.MessageSource(topic="dlq", path=path, max_per_trigger=1), out, fresh_dir(spark, "ckpt"))
    t = ST.dlq_totals(ST.dlq_stats_now(spark, out), "2024-02-01T00:00:00Z").first()
    assert (t.total_messages, t.retryable_count, t.non_retryable_count, t.oldest_message_hours) == (3, 1, 2, 2.0)
