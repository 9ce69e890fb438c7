"""Telemetry: histogram buckets and PromQL-style quantiles against brute force."""

import datetime as dt
import random

import pytest

from tollgate.operators import telemetry as TM
from tollgate.operators.route import classify_fetch
from pyspark.sql import functions as F


def brute_quantile(q, values, bounds):
    cum = [sum(v <= b for v in values) for b in bounds]
    total = len(values)
    if total == 0:
        return None
    rank = q * total
    for i, b in enumerate(bounds):
        if cum[i] >= rank:
            lo = 0.0 if i == 0 else bounds[i - 1]
            below = 0 if i == 0 else cum[i - 1]
            return lo + (b - lo) * ((rank - below) / (cum[i] - below))
    return bounds[-1]


def test_quantiles_and_histogram(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=rnd.randint(0, 1200)), rnd.choice(["sent", "dlq", "retry"]),
             round(rnd.expovariate(0.3), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, series string, batch_seconds double")
    got = {r.window_start: (r.p50, r.p99) for r in TM.duration_quantiles(df).collect()}
    windows = {}
    for ts, _, v in rows:
        start = ts.replace(minute=ts.minute - ts.minute % 5, second=0)
        windows.setdefault(start.strftime("%Y-%m-%d %H:%M:%S"), []).append(v)
    assert set(got) == set(windows)
    for k, vals in windows.items():
        want = (brute_quantile(0.5, vals, TM.BATCH_BOUNDS), brute_quantile(0.99, vals, TM.BATCH_BOUNDS))
        assert got[k] == pytest.approx(want, rel=1e-12)
    h = {r.le: r.bucket_count for r in TM.histogram(df, "batch_seconds", TM.BATCH_BOUNDS, "batch").collect()}
    counts = [h[repr(float(b))] for b in TM.BATCH_BOUNDS] + [h["+Inf"]]
    assert counts == sorted(counts) and counts[-1] == 400


def test_rates_share_and_status(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base, "sent"), (base + dt.timedelta(seconds=20), "dlq"), (base + dt.timedelta(seconds=70), "retry")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, series string")
    share = {r.window_start: r.dlq_percent for r in TM.dead_letter_share(df).collect()}
    assert share["2024-01-01 00:00:00"] == 50.0
    assert share["2024-01-01 00:00:30"] is None  # only a retry in [00:30, 01:30)
    assert TM.dlq_status(df).collect()[0].status == "red"
    assert TM.dlq_status(df.where("series <> 'dlq'")).collect()[0].status == "green"
    running = {(r.series, r.hour): r.running_total for r in TM.counter_totals(df).collect()}
    assert running[("sent", "2024-01-01 00:00:00")] == 1


def test_histogram_sum_keeps_small_values_and_quantile_bounds(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base, 0.00004)] * 3, "ts timestamp_ntz, v double")
    assert TM.histogram(df, "v", TM.SEND_BOUNDS, "send").first().total_sum == pytest.approx(0.00012)
    late = spark.createDataFrame([(base, 7.0)] * 3, "ts timestamp_ntz, batch_seconds double")
    got = TM.duration_quantiles(late, qs=(0.0, 1.0)).first()
    assert (got.p0, got.p100) == (0.0, 10.0)
    got = TM.duration_quantiles(late, qs=(-0.1, 1.1)).first()
    assert (got["p-10"], got["p110"]) == (float("-inf"), float("inf"))


def test_run_summary_with_duration(spark):
    df = spark.createDataFrame([("accepted",), ("contract",), ("accepted",)], "stage string")
    got = TM.run_summary(df, "2024-01-01T00:00:00Z", "2024-01-01T00:01:30.25Z").first()
    assert (got.success_count, got.failure_count, got.duration_seconds) == (2, 1, 90.25)
    assert "duration_seconds" not in TM.run_summary(df).columns


def test_streamed_rates_come_out_behind_the_watermark(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), k) for s, k in ((0, "sent"), (20, "dlq"), (70, "sent"), (600, "sent"))]
    spark.createDataFrame(rows, "ts timestamp, series string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, series string").parquet(f"{tmp_path}/in").withWatermark("ts", "1 minute")
    for fn, name in ((TM.rate_per_second, "rates"), (TM.dead_letter_share, "shares")):
        q = fn(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        batch = fn(spark.read.parquet(f"{tmp_path}/in")).where("window_start < '2024-01-01 00:08:00'")
        got = sorted(tuple(r) for r in spark.table(name).select(batch.columns).collect())
        assert got == sorted(tuple(r) for r in batch.collect()) and got


def test_classify_fetch_without_a_response(spark):
    df = spark.createDataFrame([(None, None, "timeout"), (None, None, "connection"), (None, None, None), (200, "{} x", None), (500, "b", None)], "status int, body string, failure string")
    df = df.select("status", *classify_fetch(F.col("status"), F.col("body"), None, F.col("failure")))
    out = df.collect()
    assert [r.error_type for r in out] == ["APITimeoutError", "APIConnectionError", "APIError", "APIError", "APIConnectionError"]
    assert [r.is_transient for r in out] == [True, True, False, False, True]
    s = TM.fetch_stats(df).first()
    assert (s.requests, s.successes, s.retries, s.failures) == (5, 0, 3, 2)


def test_classify_fetch(spark):
    rows = [(429, '{"a":1}', 60), (500, "x" * 600, None), (503, "{}", None), (400, "{}", None), (404, "{}", None),
            (200, "{bad", None), (200, '{"ok": true}', None)]
    df = spark.createDataFrame(rows, "status int, body string, retry_after int")
    out = df.select(*classify_fetch(F.col("status"), F.col("body"), F.col("retry_after"), body_chars=500)).collect()
    whole = df.select(*classify_fetch(F.col("status"), F.col("body"))).collect()
    assert len(whole[1].response_body) == 600
    assert [r.error_type for r in out] == ["APIRateLimitError", "APIConnectionError", "APIConnectionError",
                                           "APIError", "APIError", "APIError", None]
    assert [r.is_transient for r in out] == [True, True, True, False, False, False, False]
    assert out[0].retry_after == 60 and len(out[1].response_body) == 500
    assert out[5].error_message == "Invalid JSON response" and out[6].outcome == "ok"
