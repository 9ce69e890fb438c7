"""Fetches into three sinks, and the queue of those that are due again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from records import USER_RECORD, response, with_changes
from tollgate.operators.fetches import RETRY_SCHEMA, RetryPolicy, fetch_letters, route_fetches
from tollgate.session import fresh_dir
from tollgate.sources import due_queue as Q
from tollgate.sources import messages as M
from tollgate.streaming import pipeline as ST

T0 = dt.datetime(2024, 1, 31, 10, 59, 50)
GOOD = response(USER_RECORD)
NOW = "2024-02-01T00:00:00Z"


def fetches(spark, rows):
    """Landed fetches from (id, status, failure, retry_after, body, attempt) rows, all at T0."""
    return spark.createDataFrame([(i, T0, s, f, r, b, a) for i, s, f, r, b, a in rows], M.LANDED_SCHEMA)


MIXED = [
    (0, 200, None, None, GOOD, 0),
    (1, 500, None, None, "oops", 0),
    (2, None, "timeout", None, None, 1),
    (3, 200, None, None, "{not json", 0),
    (4, 429, None, 60, None, 0),
    (5, 404, None, None, "gone", 0),
    (6, 503, None, None, None, 3),  # its tries are used up
    (7, 200, None, None, response(with_changes(email="bad")), 0),
    (8, None, None, None, None, None),
    (9, None, "connection", None, None, None),
    (10, 200, None, None, None, 0),
]


def test_every_fetch_goes_to_one_sink(spark):
    got = {r["fetch_id"]: r for r in route_fetches(fetches(spark, MIXED)).collect()}
    assert len(got) == len(MIXED)
    assert {i: r["sink"] for i, r in got.items()} == {
        0: "accepted", 1: "retry", 2: "retry", 3: "dead_letter", 4: "retry", 5: "dead_letter", 6: "dead_letter", 7: "dead_letter",
        8: "dead_letter", 9: "retry", 10: "dead_letter",
    }
    wait = {i: (r["due"] - T0).total_seconds() for i, r in got.items() if r["due"]}
    assert wait == {1: 1.0, 2: 2.0, 4: 60.0, 9: 1.0}
    letters = {r["original_message"]: r for r in fetch_letters(route_fetches(fetches(spark, MIXED)), NOW).collect()}
    assert (letters["gone"]["error_type"], letters["gone"]["error_message"]) == ("APIError", "Client error: 404 [HTTP 404]")
    assert letters["{not json"]["error_message"] == "Invalid JSON response"
    assert letters[MIXED[7][4]]["error_type"] == "DataValidationError"
    last = [r for r in fetch_letters(route_fetches(fetches(spark, MIXED[6:7])), NOW).collect()]
    assert [(r["error_type"], r["retry_count"], r["original_message"]) for r in last] == [("APIConnectionError", 3, "{}")]


def test_policy_and_odd_rows(spark):
    policy = RetryPolicy(retries=10, base=2.0, max_delay=7.0, heed_retry_after=False)
    rows = [(i, 429, None, 60, None, i) for i in range(5)]
    got = {r["fetch_id"]: (r["due"] - T0).total_seconds() for r in route_fetches(fetches(spark, rows), policy).collect()}
    assert got == {0: 2.0, 1: 4.0, 2: 7.0, 3: 7.0, 4: 7.0}
    jitter = route_fetches(fetches(spark, rows * 2), RetryPolicy(retries=10, jitter=True, heed_retry_after=False)).select("fetch_id", "due").distinct()
    assert jitter.count() == 5  # the same fetch waits as long whenever it is routed
    late = fetches(spark, [(1, 500, None, None, None, 0)]).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert route_fetches(late).first()["due"].year == 1970
    assert route_fetches(fetches(spark, [])).collect() == []


def paths(spark):
    return ST.StreamPaths(*[fresh_dir(spark, n) for n in ("topic", "letters", "ckpt", "log", "retries")])


def ingest(spark, rows):
    landed, p = fresh_dir(spark, "landed"), paths(spark)
    fetches(spark, rows).repartition(2).write.options(**M.LANDED_JSON_OPTIONS).json(landed)
    ST.run_ingest_stream(spark, landed, p, NOW, policy=RetryPolicy(), max_files=1)
    return p


def test_stream_rows_in_are_rows_out(spark):
    p = ingest(spark, MIXED)
    topic, letters = spark.read.parquet(p.table), spark.read.parquet(p.dead_letters)
    again = Q.queued(spark, p.retries, RETRY_SCHEMA)
    assert (topic.count(), letters.count(), again.count()) == (1, 6, 4)
    assert again.select("due_hour").distinct().count() == 2  # the rate-limited one waits into the next hour or beyond
    t = ST.batch_totals(ST.batch_log(spark, p.batch_log)).first()
    assert (t["rows"], t["written"], t["rejected"], t["batches"]) == (11, 1, 6, 2)
    for frame in (topic, letters):
        assert frame.select("partition", "offset").distinct().count() == frame.count()


def test_rounds_bring_fetches_back_until_they_succeed_or_give_up(spark):
    p, claims = ingest(spark, [(i, 503, None, None, None, 0) for i in range(6)]), fresh_dir(spark, "claims")
    asked = []

    def fetch(due):
        rows = sorted((r["fetch_id"], r["attempt"]) for r in due.collect())
        asked.append(rows)
        return fetches(spark, [(i, 200 if (i, n) in {(0, 1), (1, 2)} else 503, None, None, GOOD, n) for i, n in rows])

    def go(k, seconds):
        return ST.run_retry_round(spark, p, claims, k, str(T0 + dt.timedelta(seconds=seconds)), fetch)

    assert go(0, 0) == (0, 0, 0) and asked[-1] == []  # nothing is due yet
    assert go(1, 1) == (1, 0, 5)
    assert go(2, 30) == (1, 0, 4)  # due at T0 + 2 s
    assert go(3, 60) == (0, 4, 0) and asked[-1] == [(i, 3) for i in (2, 3, 4, 5)]
    assert go(4, 7200) == (0, 0, 0)
    letters = M.read_dead_letters(spark.read.parquet(p.dead_letters)).collect()
    assert [(r["error_type"], r["retry_count"]) for r in letters] == [("APIConnectionError", 3)] * 4
    assert spark.read.parquet(p.table).count() == 2


def test_a_failed_round_takes_the_same_rows_again(spark):
    p, claims = ingest(spark, [(i, 503, None, None, None, 0) for i in range(4)]), fresh_dir(spark, "claims")
    now = str(T0 + dt.timedelta(seconds=5))
    seen = []

    def fetch(due, fail=False):
        seen.append(sorted(r["fetch_id"] for r in due.collect()))
        if fail:
            raise RuntimeError("lost")
        return fetches(spark, [(i, 200 if i % 2 else 503, None, None, GOOD, 1) for i in seen[-1]])

    with pytest.raises(RuntimeError, match="lost"):
        ST.run_retry_round(spark, p, claims, 0, now, lambda d: fetch(d, True))
    Q.enqueue(fetches(spark, []).selectExpr("fetch_id", "attempt", "failure error_type", "status", "ts due"), p.retries, 50)
    late = spark.createDataFrame([(99, 0, "x", 503, T0)], RETRY_SCHEMA)
    Q.enqueue(late, p.retries, 51)  # comes while the round is open: waits for the next one
    assert ST.run_retry_round(spark, p, claims, 0, now, fetch) == (2, 0, 2)
    assert seen == [[0, 1, 2, 3]] * 2
    assert ST.run_retry_round(spark, p, claims, 0, now, fetch) == (2, 0, 2)  # a settled round, run again, replaces itself
    assert spark.read.parquet(p.table).count() == 2
    ST.run_retry_round(spark, p, claims, 1, now, fetch)
    assert seen[-1] == [0, 2, 99]  # what round 0 has put back is due 2 s after T0, and by now


def test_claims_prune_hours_and_taken_partitions_can_go(spark):
    path, claims = fresh_dir(spark, "queue"), fresh_dir(spark, "claims")
    assert Q.claim(spark, path, claims, 0, "2024-01-01 00:00:00", RETRY_SCHEMA).collect() == []
    rows = [(i, 0, "x", 503, dt.datetime(2024, 1, 1, i % 24, 30)) for i in range(48)]
    Q.enqueue(spark.createDataFrame(rows, RETRY_SCHEMA), path, 0)
    first = Q.claim(spark, path, claims, 1, "2024-01-01 05:29:59", RETRY_SCHEMA)
    assert sorted(r["fetch_id"] for r in first.collect()) == [0, 1, 2, 3, 4, 24, 25, 26, 27, 28]
    plan = first._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "due_hour" in plan.split("PartitionFilters")[1][:200]
    Q.settle(spark, claims, 1)
    second = Q.claim(spark, path, claims, 2, "2024-01-01 05:30:00", RETRY_SCHEMA)
    assert sorted(r["fetch_id"] for r in second.collect()) == [5, 29]
    Q.settle(spark, claims, 2)
    assert Q.drop_taken(spark, path, claims) == 5  # hours 0 to 4 were over for the claim before the newest
    assert Q.queued(spark, path, RETRY_SCHEMA).count() == 38
    third = Q.claim(spark, path, claims, 3, "2024-01-02 00:00:00", RETRY_SCHEMA)
    assert third.count() == 36
