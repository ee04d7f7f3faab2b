"""Delay minutes and on-time status."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from aerocast.functions.exact import half_up_ratio


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delay_minutes(actual, scheduled) -> Column:
    """round((actual − scheduled) in minutes, 2) as DECIMAL(18,2); NULL if
    either side is NULL.  Computed from whole microseconds, so exact."""
    micros = F.timestamp_diff("MICROSECOND", _c(scheduled), _c(actual))
    # minutes with 2 decimals = micros / 600000 hundredths, rounded once
    return half_up_ratio(micros, F.lit(600_000), 2).cast("decimal(18,2)")


# Fixed thresholds of the status rule: NULL → unknown, ≤ 0 → on_time,
# ≤ 15 → minor_delay, otherwise delayed.
ON_TIME_MAX = 0
MINOR_DELAY_MAX = 15


def delay_status(delay) -> Column:
    d = _c(delay)
    return (F.when(d.isNull(), "unknown")
            .when(d <= ON_TIME_MAX, "on_time")
            .when(d <= MINOR_DELAY_MAX, "minor_delay")
            .otherwise("delayed"))
