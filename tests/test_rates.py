"""Rates as a stream, progress of every stream, redelivery, counters with resets, mergeable histograms."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tollgate.operators import telemetry as TM
from tollgate.session import fresh_dir
from tollgate.sources import messages as M
from tollgate.streaming import pipeline as ST
from tollgate.streaming import progress as PG
from tollgate.streaming import rates as RT

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, series string, ts timestamp_ntz"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def stream(spark, *pieces):
    """A stream of files, one for each piece, in their order."""
    path = fresh_dir(spark, "log")
    for k, rows in enumerate(pieces):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/piece={k}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/piece=*")


def test_stream_equals_batch_on_ordered_input_and_late_rows_are_told(spark):
    rng = random.Random(2)
    rows = sorted(((i, rng.choice(["sent", "dlq", "retry"]), at(rng.randrange(3600))) for i in range(400)), key=lambda r: r[2])
    late = [(1000 + i, "sent", at(60 + i)) for i in range(7)]
    out, log = fresh_dir(spark, "windows"), fresh_dir(spark, "progress")
    with PG.watched(spark, log):
        RT.run_rate_stream(stream(spark, rows[:200], rows[150:300], rows[300:], late), out, fresh_dir(spark, "ckpt"), delay="2 minutes")
    passed = max(r[2] for r in rows) - dt.timedelta(minutes=2)
    batch = spark.createDataFrame(rows, SCHEMA)
    end = F.to_timestamp_ntz("window_start") + F.expr("INTERVAL 1 MINUTE")
    for got, want in ((RT.rates_now(spark, out), TM.rate_per_second(batch)), (RT.shares_now(spark, out), TM.dead_letter_share(batch))):
        want = want.where(end <= F.lit(passed))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and want.count() > 100
    totals = PG.progress_totals(PG.progress(spark, log)).first()
    assert totals["rows"] == 400 + 50 + 7 and totals["late_rows"] == 7  # those delivered twice were known by their keys


def test_windows_come_once_and_a_restart_reads_nothing_twice(spark):
    rows = [(i, "sent", at(10 * i)) for i in range(100)]
    source, out, ckpt = stream(spark, rows[:50], rows[50:]), fresh_dir(spark, "windows"), fresh_dir(spark, "ckpt")
    for _ in range(2):
        RT.run_rate_stream(source, out, ckpt, slide=None, delay="1 minute")
    got = RT.rates_now(spark, out).collect()
    assert len(got) == len({r["window_start"] for r in got}) == 15 and all((r["n"], r["rate"]) == (6, 0.1) for r in got)


def test_progress_rows_of_reports():
    report = {"timestamp": "t", "numInputRows": 3, "inputRowsPerSecond": 1.5, "durationMs": {"addBatch": 4, "triggerExecution": 9},
              "eventTime": {"watermark": "w"}, "stateOperators": [{"numRowsDroppedByWatermark": 2, "numRowsTotal": 5}, {}],
              "sources": [{"description": "d", "startOffset": None, "endOffset": {"b": 1, "a": 2}}]}
    row = PG.progress_row(report)
    assert row == ("t", 3, 1.5, 0.0, "w", 2, 5, {"addBatch": 4, "triggerExecution": 9}, [("d", None, '{"a": 2, "b": 1}')])
    assert PG.progress_row({})[1:] == (0, 0.0, 0.0, None, 0, 0, {}, [])


def topic(spark, values, times=2):
    """A topic whose file of messages is delivered ``times`` times."""
    path = fresh_dir(spark, "topic")
    rows = [(None, v.encode(), "user_data", 0, i, T0 + dt.timedelta(seconds=i), 0) for i, v in enumerate(values)]
    for k in range(times):
        spark.createDataFrame(rows, M.KAFKA_SCHEMA).coalesce(1).write.parquet(f"{path}/copy={k}")
    return M.MessageSource(topic="user_data", path=f"{path}/copy=*", max_per_trigger=1)


@pytest.mark.parametrize(("redelivery", "rows", "rejected"), [("1 hour", 9, 3), (None, 18, 6)])
def test_redelivered_messages_count_once_if_asked_for(spark, redelivery, rows, rejected):
    values = [json.dumps({"id": f"u{i % 3}", "phone": str(i)}) if i % 3 else "bad" for i in range(9)]
    paths = ST.StreamPaths(*[fresh_dir(spark, n) for n in ("table", "letters", "ckpt", "log")])
    ST.run_user_stream(spark, topic(spark, values), paths, redelivery=redelivery)
    t = ST.batch_totals(ST.batch_log(spark, paths.batch_log)).first()
    assert (t["rows"], t["rejected"]) == (rows, rejected)
    assert spark.read.parquet(paths.dead_letters).count() == rejected


def test_any_window_and_slide_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["sent", "dlq"]), at(rng.randrange(400))) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for window, slide in ((60, 25), (60, 15), (90, 60), (300, 7)):
        want = {}
        for _, series, ts in rows:
            t = int((ts - T0).total_seconds()) + int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
            start = t - t % slide
            while start > t - window:
                key = (series, str(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=start)))
                want[key] = want.get(key, 0) + 1
                start -= slide
        got = TM.rate_per_second(frame, f"{window} seconds", f"{slide} seconds").collect()
        assert {(r["series"], r["window_start"]): r["n"] for r in got} == want
        assert all(r["rate"] == pytest.approx(r["n"] / window) for r in got)
    assert TM.interval_micros("1 hour 30 seconds") == 3_630_000_000 and TM.interval_micros("5 Minutes") == 300_000_000
    with pytest.raises(ValueError, match="length of time"):
        TM.interval_micros("soon")


def test_counters_grow_across_resets(spark):
    rows = [("a", at(0), 5.0), ("a", at(15), 8.0), ("a", at(30), 2.0), ("a", at(45), 2.0), ("a", at(70), 7.0), ("b", at(10), 1.0), ("b", at(20), None), (None, at(5), 3.0)]
    got = {(r["series"], r["window_start"][-5:]): (r["increase"], r["resets"], r["rate"]) for r in TM.counter_increase(spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")).collect()}
    assert got == {("a", "00:00"): (5.0, 1, 5 / 60), ("a", "01:00"): (5.0, 0, 5 / 60), ("b", "00:00"): (0.0, 0, 0.0), (None, "00:00"): (0.0, 0, 0.0)}


def test_merged_vectors_equal_the_direct_histogram_and_nulls_are_no_observations(spark):
    rng = random.Random(4)
    rows = [(at(rng.randrange(1500)), rng.choice([None, 0.05, 0.2, 3.0, 40.0])) for _ in range(300)] + [(at(2000), None)] * 3
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, batch_seconds double")
    parts = [TM.bucket_vectors(p) for p in frame.randomSplit([1.0, 2.0, 1.0], 1)]
    merged = TM.merged_vectors(parts[0].unionByName(parts[1]).unionByName(parts[2]), len(TM.BATCH_BOUNDS), ("step",))
    direct = {r["step"]: (r["buckets"], r["cnt"]) for r in TM.bucket_vectors(frame).collect()}
    assert {r["step"]: (r["buckets"], r["cnt"]) for r in merged.collect()} == direct
    tumbling = {r["window_start"]: (r["cnt"], r["p50"], r["p99"]) for r in TM.duration_quantiles(frame).collect()}
    slid = {r["window_start"]: (r["cnt"], r["p50"], r["p99"]) for r in TM.sliding_quantiles(merged).collect()}
    assert all(slid[k] == v for k, v in tumbling.items()) and len(slid) > len(tumbling)
    assert tumbling["2024-01-01 00:30:00"] == (0, None, None)
    h = {r["le"]: r["bucket_count"] for r in TM.histogram(frame, "batch_seconds", TM.BATCH_BOUNDS, "b").collect()}
    assert h["+Inf"] == sum(v is not None for _, v in rows)
    with pytest.raises(ValueError, match="divide"):
        TM.sliding_quantiles(merged, slide="90 seconds")
