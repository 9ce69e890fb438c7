"""Dead letters: decode with both spellings, stats, replay plan."""

import json

from pyspark.sql import functions as F

from tollgate.operators import deadletters as D
from tollgate.sources import messages as M

NOW = "2024-02-01T00:00:00Z"


def letters(spark, values):
    rows = [(None if v is None else (v if isinstance(v, str) else json.dumps(v)).encode(), 0, i)
            for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "value binary, partition int, offset long")
    return M.read_dead_letters(df)


def test_decode_both_spellings_and_defaults(spark):
    vals = [
        {"original_message": '{"a": 1}', "error_type": "TimeoutError", "error_message": "boom",
         "timestamp": "2024-01-31T23:00:00Z", "retry_count": 1, "source_topic": "t1"},
        {"original_message": {"a": 2}, "error_type": "ConnectionError", "error": "bang", "topic": "t2"},
        {},
        "not json",
        {"retry_count": "x"},
    ]
    rows = letters(spark, vals).orderBy("offset").collect()
    r0, r1, r2, r3, r4 = rows
    assert (r0.original_message, r0.error_message, r0.topic, r0.retry_count) == ('{"a": 1}', "boom", "t1", 1)
    assert (r1.original_message, r1.error_message, r1.topic, r1.retry_count) == ('{"a":2}', "bang", "t2", 0)
    assert (r2.original_message, r2.error_message, r2.error_type, r2.timestamp, r2.topic) == (
        "{}", "Unknown error", "Unknown", "", "")
    assert (r3.readable, r4.readable) == (False, False)


def test_age_and_stats(spark):
    vals = [
        {"error_type": "TimeoutError", "timestamp": "2024-01-31T23:00:00Z", "retry_count": 0},
        {"error_type": "TimeoutError", "timestamp": "2024-01-31T22:00:00Z", "retry_count": 3},
        {"error_type": "DataValidationError", "timestamp": "bad", "retry_count": 0},
        "garbage",
        {"error_type": "KafkaConnectionError", "timestamp": "2024-02-02T00:00:00Z"},
    ]
    d = letters(spark, vals)
    st = D.dead_letter_stats(d, NOW, max_messages=1000).collect()[0]
    assert (st.total_messages, st.retryable_count, st.non_retryable_count) == (4, 2, 2)
    counts = {r.error_type: r.n for r in D.error_type_counts(d).collect()}
    assert counts == {"TimeoutError": 2, "DataValidationError": 1, "KafkaConnectionError": 1}
    assert st.oldest_message_hours == 2.0
    assert D.dead_letter_stats(d, NOW).collect()[0] == st  # no cap unless asked for
    # unreadable rows do not use up n
    st2 = D.dead_letter_stats(d, NOW, max_messages=3).collect()[0]
    assert st2.total_messages == 3
    assert D.undecodable_count(d).collect()[0][0] == 1
    empty = D.dead_letter_stats(d.where("false"), NOW).collect()[0]
    assert (empty.total_messages, empty.retryable_count, empty.oldest_message_hours) == (0, 0, 0.0)


def test_replay_plan(spark):
    vals = [
        {"original_message": {"k": 1}, "error_type": "TimeoutError", "retry_count": 0, "topic": ""},
        {"original_message": {"k": 2}, "error_type": "DataValidationError", "retry_count": 0},
        {"original_message": [1], "error_type": "TimeoutError", "retry_count": 0},
        "garbage",
        {"original_message": '{"k": 5, "_retry_count": 1}', "error_type": "ConnectionError",
         "retry_count": 1, "source_topic": "own"},
        {"original_message": {"k": 6}, "error_type": "ConnectionError", "retry_count": 3},
    ]
    plan = D.plan_replay(letters(spark, vals), max_messages=None).orderBy("offset").collect()
    assert [p.outcome for p in plan] == ["retried", "skipped", "failed", "failed", "retried", "skipped"]
    assert (plan[0].target_topic, json.loads(plan[0].body)) == ("user_data", {"k": 1, "_retry_count": 1})
    assert (plan[4].target_topic, json.loads(plan[4].body)) == ("own", {"k": 5, "_retry_count": 2})
    s = D.replay_summary(D.plan_replay(letters(spark, vals), max_messages=None)).collect()[0]
    assert (s.retried, s.skipped, s.failed) == (2, 2, 2)
    first3 = D.plan_replay(letters(spark, vals), max_messages=3)
    assert first3.count() == 3
    forced = D.plan_replay(letters(spark, vals), target_topic="x", only_replayable=False, max_messages=None)
    assert {r.outcome for r in forced.collect()} == {"retried", "failed"}


def test_sample_is_first_readable(spark):
    vals = ["garbage", {"error_type": "A"}, {"error_type": "B"}, {"error_type": "C"}]
    got = [r.error_type for r in D.sample_dead_letters(letters(spark, vals), 2).collect()]
    assert got == ["A", "B"]
