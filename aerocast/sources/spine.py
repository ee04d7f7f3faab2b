"""Request windows and default date ranges as DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

WINDOW_HOURS = 12   # each day is requested as 00:00–12:00 and 12:00–24:00


def request_windows(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Each row's [start, end] day range → half-day request windows
    (``from_local``/``to_local`` as ``yyyy-MM-ddTHH:mm`` text).  Rows with
    end < start are rejected by raising, as the reference validates."""
    bad = bounds.filter(F.col(end) < F.col(start)).limit(1).collect()
    if bad:
        raise ValueError(f"end date before start date: {bad[0].asDict()}")
    s = F.col(start).cast("timestamp_ntz")
    last = F.col(end).cast("timestamp_ntz") + F.expr(f"INTERVAL {24 - WINDOW_HOURS} HOURS")
    w = bounds.select("*", F.explode(F.sequence(s, last, F.expr(f"INTERVAL {WINDOW_HOURS} HOURS"))).alias("_w"))
    fmt = "yyyy-MM-dd'T'HH:mm"
    return w.select(*bounds.columns, F.date_format("_w", fmt).alias("from_local"),
                    F.date_format(F.col("_w") + F.expr(f"INTERVAL {WINDOW_HOURS} HOURS"), fmt).alias("to_local")
                    ).drop("_w")


def default_range(lookback_days: int = 30, end: Column | None = None) -> tuple[Column, Column]:
    """(start, end) = (end − lookback, end), end defaulting to today (UTC)."""
    e = end if end is not None else F.current_date()
    return F.date_sub(e, lookback_days), e


def default_dates(start: str | None = None, end: str | None = None, lookback_days: int = 30
                  ) -> tuple[dt.date, dt.date]:
    """Python form for job parameters: missing end → today (UTC), missing
    start → end − lookback."""
    e = dt.date.fromisoformat(end) if end else dt.datetime.now(dt.timezone.utc).date()
    s = dt.date.fromisoformat(start) if start else e - dt.timedelta(days=lookback_days)
    return s, e
