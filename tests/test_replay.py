"""Replays that remember what they sent (D5 as a consumer group)."""

import json

import pytest

from tollgate.session import fresh_dir
from tollgate.sources import messages as M
from tollgate.sources import sinks as S
from tollgate.operators import deadletters as D
from tollgate.streaming import replay as RP

HUGE = 99999999999


def letters(spark, values):
    rows = [((v if isinstance(v, str) else json.dumps(v)).encode(), i % 2, i) for i, v in enumerate(values)]
    return M.read_dead_letters(spark.createDataFrame(rows, "value binary, partition int, offset long"))


def letter(body, kind="TimeoutError", n=0):
    return {"original_message": body, "error_type": kind, "retry_count": n, "timestamp": "2024-01-31T23:00:00Z"}


MIXED = [letter('{"a":1}'), letter('{"a":2}', "DataValidationError"), letter("[1]"), letter('{"a":1,"a":2}'), letter('{"a":1} junk'),
         "not json", letter('{"a":3}', n=HUGE), letter('{"a":4}', n=2)]


def test_poison_letters_fail_and_end_nothing(spark):
    plan = {r["offset"]: r for r in D.plan_replay(letters(spark, MIXED)).collect()}
    assert [plan[i]["outcome"] for i in range(8)] == ["retried", "skipped", "failed", "failed", "failed", "failed", "skipped", "retried"]
    assert json.loads(plan[7]["body"]) == {"a": 4, "_retry_count": 3}
    assert D.replay_summary(D.plan_replay(letters(spark, MIXED))).first().asDict() == {"retried": 2, "skipped": 2, "failed": 4}


def test_large_and_odd_retry_counts(spark):
    said = [letter("{}", n=x) for x in (HUGE, 1e30, -1e30, 2.0)]
    got = [r["retry_count"] for r in letters(spark, said).orderBy("offset").collect()]
    assert got == [HUGE, (1 << 63) - 1, 0, 2]
    texts = spark.createDataFrame([('{"_retry_count":99999999999}',), ('{"_retry_count":1e40}',), ("{}",), ('{"_retry_count":"x"}',), (None,)], "t string")
    assert [r[0] for r in texts.select(D.retries_so_far(texts["t"])).collect()] == [HUGE, (1 << 63) - 1, 0, 0, 0]


@pytest.mark.parametrize(("text", "hours"), [("12:30", 0.0), ("T12", 0.0), ("2024", 0.0), ("2024-01", 0.0), ("2024-01-31", 24.0), ("2024-01-31T23:00:00Z", 1.0),
                                             ("2024-01-31 22:00", 2.0), ("2024-01-31T23:00:00.5+01:00", 1.9998611111111112), ("", 0.0), (None, 0.0), ("2024-13-01", 0.0)])
def test_only_iso_times_have_an_age(spark, text, hours):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(D.age_hours(frame["t"], "2024-02-01T00:00:00Z")).first()[0] == pytest.approx(hours)


def summary(df):
    return tuple(df.first())


def test_replayed_twice_sent_once(spark):
    ledger, topic = fresh_dir(spark, "ledger"), fresh_dir(spark, "topic")
    send, frame = RP.to_topic(topic), letters(spark, MIXED)
    assert RP.open_letters(frame, ledger).count() == 8
    assert summary(RP.replay(frame, ledger, 0, send)) == (2, 2, 4)
    assert summary(RP.replay(frame, ledger, 1, send)) == (0, 2, 4)  # what was skipped or failed is told of again
    assert summary(RP.replay(frame, ledger, 0, send)) == (2, 2, 4)  # the same run again only reports
    assert spark.read.parquet(topic).count() == 2
    more = letters(spark, [*MIXED, letter('{"a":9}')])
    assert RP.compact_ledger(spark, ledger) == 1 == RP.compact_ledger(spark, ledger)
    assert summary(RP.replay(more, ledger, 2, send)) == (1, 2, 4)
    assert sorted((r["offset"], r["run"]) for r in RP.sent_letters(spark, ledger).collect()) == [(0, 0), (7, 0), (8, 2)]


def test_a_failed_send_stays_open(spark):
    ledger, topic = fresh_dir(spark, "ledger"), fresh_dir(spark, "topic")
    frame = letters(spark, MIXED)

    def half(messages, run_id):
        S.write_messages(messages.limit(1), "parquet", topic, run_id)
        raise ConnectionError("gone")

    with pytest.raises(ConnectionError):
        RP.replay(frame, ledger, 0, half)
    assert RP.sent_letters(spark, ledger).count() == 0
    assert summary(RP.replay(letters(spark, MIXED[:1]), ledger, 0, RP.to_topic(topic))) == (2, 2, 4)  # the plan of the failed run
    assert spark.read.parquet(topic).count() == 2  # its half is replaced, not added to


def test_bounds_take_the_first_open_letters(spark):
    ledger, topic = fresh_dir(spark, "ledger"), fresh_dir(spark, "topic")
    frame = letters(spark, [letter(json.dumps({"a": i})) for i in range(10)])
    for run in range(4):
        RP.replay(frame, ledger, run, RP.to_topic(topic), max_messages=4)
    assert [r["run"] for r in RP.sent_letters(spark, ledger).orderBy("partition", "offset").collect()] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert RP.open_letters(frame, ledger).count() == 0


def test_offsets_of_file_topics_are_unique_and_rise(spark):
    path = fresh_dir(spark, "topic")
    frame = spark.range(1000).repartition(7).selectExpr("cast(id % 9 as string) key", "cast(id as string) value")
    for batch in range(2):
        S.write_messages(S.publish_messages(frame, "t", "key"), "parquet", path, batch)
    got = spark.read.parquet(path)
    assert got.select("partition", "offset").distinct().count() == got.count() == 2000
    ends = {r["batch_id"]: (r["a"], r["b"]) for r in got.groupBy("batch_id").agg({"offset": "max"}).withColumnRenamed("max(offset)", "b").join(
        got.groupBy("batch_id").agg({"offset": "min"}).withColumnRenamed("min(offset)", "a"), "batch_id").collect()}
    assert ends[0][1] < ends[1][0]
    assert got.groupBy("key").agg({"partition": "count"}).count() == 9
    with pytest.raises(ValueError, match="bits"):
        S.topic_rows(S.publish_messages(frame, "t", "key"), 1 << 40)
