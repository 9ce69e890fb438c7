"""Retry delay schedule, ``min(base * factor^attempt, max) * (1 + jitter)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def backoff_delay(attempt: Column, base: float = 1.0, max_delay: float = 30.0, factor: float = 2.0,
                  jitter: bool = False, jitter_key: Column | None = None) -> Column:
    """Seconds to wait before retry ``attempt`` (0-based).

    Jitter is a 0-50 % increase; instead of a random draw it is derived from
    ``xxhash64(jitter_key)`` so reruns and replays compute the same delay.
    """
    delay = F.least(F.lit(float(base)) * F.pow(F.lit(float(factor)), attempt.cast("double")), F.lit(float(max_delay)))
    if jitter:
        key = jitter_key if jitter_key is not None else attempt
        u = F.pmod(F.xxhash64(key), F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)
        delay = delay * (F.lit(1.0) + F.lit(0.5) * u)
    return delay
