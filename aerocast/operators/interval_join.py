"""Interval (±window) joins and nearest-match selection.

A theta predicate such as ``p >= c - 30 min AND p < c + 30 min`` has no
equi key, so Spark would plan a broadcast nested-loop join.  Here both
sides get an integer *bucket* — the point its own bucket, the interval
every bucket it overlaps — and the join runs as an equi-join on the
bucket (sort-merge or broadcast-hash, AQE decides) with the exact
predicate as a residual.  With the bucket width equal to the window
width and the bucket origin shifted by ``before``, an interval centred on
a bucket boundary (hour-aligned weather, half-open bounds) covers exactly
one bucket; closed bounds add the next one.  No pair is lost or invented:
every matching pair shares exactly one bucket (the point's).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_US = 1_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c) -> Column:
    """Microseconds since epoch of a naive (UTC) or zoned timestamp."""
    return F.unix_micros(_c(c).cast("timestamp"))


def _window_predicate(p: Column, c: Column, before_s: int, after_s: int, closed: str) -> Column:
    lo = c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(before_s))
    hi = c + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(after_s))
    if closed == "both":
        return (p >= lo) & (p <= hi)
    if closed == "left":
        return (p >= lo) & (p < hi)
    raise ValueError("closed must be 'left' (half-open) or 'both'")


def interval_join(points: DataFrame, intervals: DataFrame, point_ts: str, center_ts: str,
                  before: int = 1800, after: int = 1800, closed: str = "left",
                  how: str = "inner", interval_key: str | None = None,
                  bucket_seconds: int | None = None) -> DataFrame:
    """Join each point to every interval ``[center-before, center+after)``
    (``closed='left'``) or ``[…, …]`` (``closed='both'``) containing it.

    ``how``: ``inner``; ``left`` keeps unmatched points (one row, interval
    columns NULL); ``right`` keeps unmatched intervals once each, which
    needs ``interval_key`` (unique per interval row).  Column names of the
    two sides must not overlap.
    """
    width = bucket_seconds or (before + after)
    if width <= 0:
        raise ValueError("window width must be positive")
    bw = F.lit(width * _US)
    shift = F.lit(before * _US)
    pb = "_ij_bucket"
    pts = points.withColumn(pb, F.floor((epoch_micros(point_ts) + shift) / bw))
    cm = epoch_micros(center_ts)
    lo_b = F.floor((cm - F.lit(before * _US) + shift) / bw)
    hi_us = cm + F.lit(after * _US) + shift
    hi_b = F.floor((hi_us if closed == "both" else hi_us - 1) / bw)
    ivs = intervals.withColumn(pb, F.explode(F.sequence(lo_b, hi_b)))

    cond = [pts[pb] == ivs[pb],
            _window_predicate(pts[point_ts], ivs[center_ts], before, after, closed)]
    if how in ("inner", "left"):
        out = pts.join(ivs, on=cond, how=how)
        return out.drop(pts[pb]).drop(ivs[pb])
    if how == "right":
        if interval_key is None:
            raise ValueError("how='right' needs interval_key")
        inner = pts.join(ivs, on=cond, how="inner").drop(pts[pb]).drop(ivs[pb])
        matched = inner.select(interval_key).distinct()
        unmatched = intervals.join(matched, interval_key, "left_anti")
        return inner.unionByName(unmatched, allowMissingColumns=True)
    raise ValueError(f"unsupported how={how!r}")


def naive_interval_join(points: DataFrame, intervals: DataFrame, point_ts: str, center_ts: str,
                        before: int = 1800, after: int = 1800, closed: str = "left",
                        how: str = "inner") -> DataFrame:
    """Reference form of the same join (theta predicate only) — plans as a
    nested-loop join; kept for equivalence tests on small inputs."""
    return points.join(intervals, _window_predicate(points[point_ts], intervals[center_ts],
                                                     before, after, closed), how)


def nearest_match(joined: DataFrame, point_key: str, point_ts: str, center_ts: str,
                  keep_cols: list[str] | None = None) -> DataFrame:
    """Keep one interval per point: smallest |point − center|, ties to the
    earlier center; points without any match keep their single row.

    Implemented as ``min_by`` aggregation per point key, so map-side
    partial aggregation bounds the work of any hot key.  Adds
    ``time_diff_seconds`` (DOUBLE, NULL when unmatched).
    """
    cols = keep_cols or [c for c in joined.columns if c != point_key]
    diff = F.abs(F.timestamp_diff("MICROSECOND", F.col(center_ts), F.col(point_ts)))
    rank = F.struct(F.coalesce(diff, F.lit(2**62)).alias("d"),
                    F.coalesce(epoch_micros(center_ts), F.lit(2**62)).alias("c"))
    row = F.struct(*[F.col(c) for c in cols], (diff / F.lit(float(_US))).alias("time_diff_seconds"))
    return (joined.groupBy(point_key)
            .agg(F.min_by(row, rank).alias("_m"))
            .select(point_key, "_m.*"))
