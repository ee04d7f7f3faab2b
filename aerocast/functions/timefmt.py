"""Time parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed formats of the flight feed: ``2026-06-30 17:00Z`` (UTC, no
# seconds) and ``2026-07-01 00:00+07:00`` (local with offset).  A plain
# cast rejects both, so they are parsed with optional seconds.
UTC_TEXT_FORMAT = "yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS]'Z'"
ZONED_TEXT_FORMAT = "yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS]XXX"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


NO_ZONE_FORMAT = "yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS]"


def _clean(c) -> Column:
    # replace passes over a text without a T, translate builds each anew
    return F.replace(F.trim(_c(c)), F.lit("T"), F.lit(" "))


def _has_offset(s: Column) -> Column:
    return F.substring(s, -6, 1).isin("+", "-") & (F.substring(s, -3, 1) == ":")


def parse_utc_text(c) -> Column:
    """``'2026-06-30 17:00Z'`` → TIMESTAMP_NTZ holding UTC; also accepts a
    ``T`` separator, seconds and a missing ``Z``.  The format is chosen
    from the text (a failed parse is costly), unparseable text → NULL."""
    s = _clean(c)
    return (F.when(s.endswith("Z"), F.try_to_timestamp(s, F.lit(UTC_TEXT_FORMAT)))
            .otherwise(F.try_to_timestamp(s, F.lit(NO_ZONE_FORMAT)))).cast("timestamp_ntz")


def parse_zoned_text(c) -> Column:
    """``'2026-07-01 00:00+07:00'`` → TIMESTAMP (an instant); ``Z`` or no
    zone (session time zone, UTC) are accepted too."""
    s = _clean(c)
    return (F.when(_has_offset(s), F.try_to_timestamp(s, F.lit(ZONED_TEXT_FORMAT)))
            .when(s.endswith("Z"), F.try_to_timestamp(s, F.lit(UTC_TEXT_FORMAT)))
            .otherwise(F.try_to_timestamp(s, F.lit(NO_ZONE_FORMAT))))


def weekday_name(c, padded: bool = True) -> Column:
    """English weekday; padded to 9 characters like ``to_char(ts,'Day')``."""
    name = F.date_format(_c(c), "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def date_of(c) -> Column:
    return F.to_date(_c(c))


def hour_of(c) -> Column:
    return F.hour(_c(c))


def plus_minutes(c, minutes: int) -> Column:
    return _c(c) + F.expr(f"INTERVAL {int(minutes)} MINUTES")


def minus_minutes(c, minutes: int) -> Column:
    return _c(c) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def abs_diff_micros(a, b) -> Column:
    """|a − b| in microseconds (BIGINT)."""
    return F.abs(F.timestamp_diff("MICROSECOND", _c(b), _c(a)))


def batch_id_now() -> Column:
    """Load batch id ``yyyyMMddHHmmss`` (UTC); constant within a query."""
    return F.date_format(F.current_timestamp(), "yyyyMMddHHmmss")
