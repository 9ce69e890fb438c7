"""Run statistics and telemetry (E1-E8) as aggregate queries.

The reference keeps process counters and histograms and lets a dashboard
compute rates, shares and quantiles.  Here the same numbers come from a
delivery log (one row per send / retry / dead letter with its time and
duration) through ordinary aggregations: partial aggregation before each
shuffle, and window functions only over pre-aggregated rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Histogram bucket bounds (seconds) of the send and the
# micro-batch duration histograms.
SEND_BOUNDS = (0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
BATCH_BOUNDS = (0.1, 0.5, 1.0, 5.0, 10.0, 30.0)
# Dead-letter panel thresholds: green below 1, red from 1.
DLQ_RED_FROM = 1

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def run_summary(routed: DataFrame, started: str | None = None, ended: str | None = None) -> DataFrame:
    """Success / failure counts and rate = s / (s + f), 0 when empty.

    With the run's ``started`` and ``ended`` times (ISO text) also its duration in seconds.
    """
    ok = F.count_if(F.col("stage") == "accepted")
    bad = F.count_if(F.col("stage") != "accepted")
    out = routed.agg(
        ok.alias("success_count"),
        bad.alias("failure_count"),
        F.coalesce(F.try_divide(ok, ok + bad), F.lit(0.0)).alias("success_rate"),
    )
    if started is None or ended is None:
        return out
    first, last = (F.unix_micros(F.to_timestamp(F.lit(t))) for t in (started, ended))
    return out.withColumn("duration_seconds", (last - first).cast("double") / 1_000_000)


def delivery_stats(log: DataFrame) -> DataFrame:
    """E2 (producer side): sent, send retries, failed for good, sent to dead letters."""
    s = F.col("series")
    return log.agg(
        F.count_if(s == "sent").alias("messages_sent"),
        F.count_if(s == "retry").alias("send_retries"),
        F.count_if(s == "failed").alias("messages_failed"),
        F.count_if(s == "dlq").alias("sent_to_dlq"),
    )


def fetch_stats(classified: DataFrame) -> DataFrame:
    """E2 (client side): requests, successes, retries (5xx, or no response for a
    transient reason), failures (the rest); they add up to the requests."""
    ok = F.col("outcome") == "ok"
    again = F.coalesce(F.col("status") >= 500, F.col("is_transient"))
    return classified.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(ok).alias("successes"),
        F.count_if(~ok & again).alias("retries"),
        F.count_if(~ok & ~again).alias("failures"),
    )


def counter_totals(log: DataFrame, ts: str = "ts") -> DataFrame:
    """Per series and hour the count and the running total.

    Counts per (series, hour) first; the running sum then orders only
    those few rows per series.
    """
    hourly = log.groupBy("series", F.date_trunc("hour", F.col(ts)).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("series").orderBy("_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hourly.select(
        "series",
        F.date_format("_h", TS_FORMAT).alias("hour"),
        "n",
        F.sum("n").over(w).alias("running_total"),
    )


def _windowed(log: DataFrame, ts: str, window: str, slide: str | None) -> DataFrame:
    w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    return log.select("*", w.alias("_w"))


# Microseconds of the units that window lengths are given in.
_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def interval_micros(text: str) -> int:
    """The length of an interval such as ``5 minutes`` or ``1 hour 30 seconds``."""
    words = text.lower().removeprefix("interval ").split()
    if not words or len(words) % 2 or any(u.rstrip("s") not in _UNITS for u in words[1::2]):
        raise ValueError(f"not a length of time: {text!r}")
    return sum(int(n) * _UNITS[u.rstrip("s")] for n, u in zip(words[::2], words[1::2], strict=True))


def _per_window(log: DataFrame, ts: str, window: str, slide: str | None, keys: tuple[str, ...], counts: dict[str, Column]) -> DataFrame:
    """Counts by (sliding) window and ``keys``.

    Rows are counted first by the longest step that divides window and slide, so that every step lies
    wholly inside or outside a window; only those counts, one row per step and key, are copied
    into the windows.  A stream has no second aggregation in the same pass, so there each row is copied itself.
    """
    if slide is None or log.isStreaming:
        return _windowed(log, ts, window, slide).groupBy(*keys, "_w").agg(*[c.alias(n) for n, c in counts.items()])
    step = f"{math.gcd(interval_micros(window), interval_micros(slide))} microseconds"
    tumbling = _windowed(log, ts, step, None).groupBy(*keys, "_w").agg(*[c.alias(n) for n, c in counts.items()])
    tumbling = tumbling.withColumn("_t", F.col("_w.start")).drop("_w")
    return _windowed(tumbling, "_t", window, slide).groupBy(*keys, "_w").agg(*[F.sum(n).alias(n) for n in counts])


def rate_per_second(log: DataFrame, window: str = "1 minute", slide: str | None = "15 seconds", ts: str = "ts") -> DataFrame:
    """Events per second per series in each (sliding) window.

    A plain count / window length; PromQL's edge extrapolation is not copied.
    On a stream, give ``log`` a watermark on ``ts``; windows come out once it
    has passed their end (``streaming.rates`` does so).
    """
    g = _per_window(log, ts, window, slide, ("series",), {"n": F.count(F.lit(1))})
    return g.select(
        "series",
        F.date_format("_w.start", TS_FORMAT).alias("window_start"),
        "n",
        (F.col("n") / F.lit(interval_micros(window) / 1_000_000)).alias("rate"),
    )


def dead_letter_share(log: DataFrame, window: str = "1 minute", slide: str | None = "15 seconds", ts: str = "ts") -> DataFrame:
    """E5: dlq / (sent + dlq) * 100 per window; null when neither occurred.  Streams as in E4."""
    s = F.col("series")
    g = _per_window(log, ts, window, slide, (), {"dlq": F.count_if(s == "dlq"), "sent": F.count_if(s == "sent")})
    return g.select(F.date_format("_w.start", TS_FORMAT).alias("window_start"), "dlq", "sent", dead_letter_percent().alias("dlq_percent"))


def dead_letter_percent() -> Column:
    """dlq / (sent + dlq) * 100 of the columns ``dlq`` and ``sent``; null without either."""
    return F.try_divide(F.col("dlq").cast("double"), (F.col("sent") + F.col("dlq")).cast("double")) * F.lit(100.0)


def counter_increase(samples: DataFrame, window: str = "1 minute", ts: str = "ts") -> DataFrame:
    """E3, E4 on scraped counters: growth and rate per series and tumbling window, across resets.

    ``samples`` holds a counter's ``value`` by ``series`` and time.  A value below the one before is a counter
    that began again at zero, so all of it is growth; a series' first sample only sets the start.  Growth
    belongs to the window of the later sample.  The window function orders each series by itself: scrapes are
    one row per series and interval, already counts.
    """
    order = Window.partitionBy("series").orderBy(ts, "value")
    before = F.lag("value").over(order)
    grown = F.when(before.isNull(), F.lit(0.0)).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    rows = samples.where(F.col("value").isNotNull() & F.col(ts).isNotNull()).select(
        "series", ts, grown.cast("double").alias("_grown"), (F.col("value") < before).alias("_reset")
    )
    g = _windowed(rows, ts, window, None).groupBy("series", "_w").agg(F.sum("_grown").alias("increase"), F.count_if("_reset").alias("resets"))
    return g.select(
        "series",
        F.date_format("_w.start", TS_FORMAT).alias("window_start"),
        "increase",
        "resets",
        (F.col("increase") / F.lit(interval_micros(window) / 1_000_000)).alias("rate"),
    )


def bucket_vectors(log: DataFrame, value: str = "batch_seconds", bounds: tuple[float, ...] = BATCH_BOUNDS, step: str = "1 minute",
                   ts: str = "ts") -> DataFrame:
    """E6 in a form that merges: per step of time the cumulative bucket counts, number and sum of ``value``.

    Vectors of different inputs, or of streamed batches, add up (``merged_vectors``); nulls are no observations.
    """
    v = F.col(value)
    counts = [F.count_if(v <= F.lit(b)) for b in bounds]
    return _windowed(log, ts, step, None).groupBy(F.col("_w.start").alias("step")).agg(
        F.array(*counts).alias("buckets"), F.count(v).alias("cnt"), F.coalesce(F.sum(v).cast("double"), F.lit(0.0)).alias("total")
    )


def merged_vectors(vectors: DataFrame, buckets: int, by: tuple[Column | str, ...]) -> DataFrame:
    """The sums of bucket vectors of one length by ``by``."""
    parts = [F.sum(F.col("buckets")[i]) for i in range(buckets)]
    return vectors.groupBy(*by).agg(F.array(*parts).alias("buckets"), F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))


def sliding_quantiles(vectors: DataFrame, bounds: tuple[float, ...] = BATCH_BOUNDS, window: str = "5 minutes", slide: str = "1 minute",
                      step: str = "1 minute", qs: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """E7 over sliding windows, from ``bucket_vectors`` whose ``step`` divides window and slide."""
    if interval_micros(window) % interval_micros(step) or interval_micros(slide) % interval_micros(step):
        raise ValueError("the vectors' step must divide window and slide")
    g = merged_vectors(_windowed(vectors, "step", window, slide), len(bounds), ("_w",))
    cum = [F.col("buckets")[i] for i in range(len(bounds))]
    return g.select(
        F.date_format("_w.start", TS_FORMAT).alias("window_start"),
        "cnt",
        *[quantile_from_buckets(q, cum, F.col("cnt"), bounds).alias(f"p{int(round(q * 100))}") for q in qs],
    )


def _le(b: float) -> str:
    return repr(float(b))


def histograms(log: DataFrame, of: dict[str, tuple[str, tuple[float, ...]]]) -> DataFrame:
    """Cumulative ``le`` bucket counts plus ``+Inf``, sum and count of each
    named (column, bounds).

    One pass for all: a ``count_if`` per bound (partial aggregation), then the
    single row is unpivoted into one row per bucket.  A null is no observation.
    """
    aggs, rows = [], []
    for h, (name, (value, bounds)) in enumerate(of.items()):
        v = F.col(value)
        aggs += [F.count_if(v <= F.lit(b)).alias(f"h{h}b{i}") for i, b in enumerate(bounds)]
        aggs.append(F.count(v).alias(f"h{h}c"))
        aggs.append(F.coalesce(F.sum(v).cast("double"), F.lit(0.0)).alias(f"h{h}s"))
        buckets = [(_le(b), f"h{h}b{i}") for i, b in enumerate(bounds)] + [("+Inf", f"h{h}c")]
        rows += [f"'{name}', '{le}', {n}, h{h}c, h{h}s" for le, n in buckets]
    stack = f"stack({len(rows)}, {', '.join(rows)}) AS (histogram, le, bucket_count, total_count, total_sum)"
    return log.agg(*aggs).select(F.expr(stack))


def histogram(log: DataFrame, value: str, bounds: tuple[float, ...], name: str) -> DataFrame:
    """E6 for one column."""
    return histograms(log, {name: (value, bounds)})


def quantile_from_buckets(q: float, cum: list[Column], total: Column, bounds: tuple[float, ...]) -> Column:
    """PromQL ``histogram_quantile`` on cumulative counts (linear inside the
    bucket; first bucket starts at 0; rank in +Inf -> last finite bound;
    no observations -> null; q below 0 or above 1 -> minus or plus infinity;
    q = 0 -> 0, the start of the first bucket)."""
    if not 0 <= q <= 1:
        return F.when(total > 0, F.lit(float("-inf" if q < 0 else "inf")))
    rank = F.lit(float(q)) * total.cast("double")
    expr = None
    for i, b in enumerate(bounds):
        lo = 0.0 if i == 0 else bounds[i - 1]
        below = F.lit(0.0) if i == 0 else cum[i - 1].cast("double")
        inside = F.coalesce(F.try_divide(rank - below, cum[i].cast("double") - below), F.lit(0.0))
        val = F.lit(lo) + F.lit(b - lo) * inside
        cond = cum[i].cast("double") >= rank
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    expr = expr.otherwise(F.lit(float(bounds[-1])))
    return F.when(total > 0, expr)


def duration_quantiles(log: DataFrame, value: str = "batch_seconds", bounds: tuple[float, ...] = BATCH_BOUNDS,
                       window: str = "5 minutes", qs: tuple[float, ...] = (0.5, 0.99), ts: str = "ts") -> DataFrame:
    """p50 / p99 of durations per tumbling window, from bucket counts.  A null is no
    observation; a window of nulls only has none and no quantiles."""
    v = F.col(value)
    g = _windowed(log, ts, window, None).groupBy("_w").agg(
        *[F.count_if(v <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)], F.count(v).alias("cnt")
    )
    cum = [F.col(f"b{i}") for i in range(len(bounds))]
    return g.select(
        F.date_format("_w.start", TS_FORMAT).alias("window_start"),
        "cnt",
        *[quantile_from_buckets(q, cum, F.col("cnt"), bounds).alias(f"p{int(round(q * 100))}") for q in qs],
    )


def threshold_status(total: Column, red_from: int = DLQ_RED_FROM) -> Column:
    """Panel colour of the dead-letter total."""
    return F.when(total >= red_from, F.lit("red")).otherwise(F.lit("green"))


def dlq_status(log: DataFrame) -> DataFrame:
    tot = F.count_if(F.col("series") == "dlq")
    return log.agg(tot.alias("dlq_total")).select("dlq_total", threshold_status(F.col("dlq_total")).alias("status"))
