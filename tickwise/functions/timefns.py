"""Time column helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_us(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ (wall clock as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts).cast("timestamp_ntz"))


def epoch_ms(ts) -> Column:
    """Whole milliseconds since the epoch (floor of the microseconds)."""
    return F.floor(epoch_us(ts) / F.lit(1000)).cast("long")


def parse_event_time(s, fmt: str = "yyyy-MM-dd HH:mm:ss", source_tz: str | None = None) -> Column:
    """String -> event time; malformed strings become null (ANSI-safe).

    With ``source_tz`` the wall-clock string is read in that zone and
    converted to UTC, so ticks stamped in exchange-local time line up
    with ticks stamped in UTC.
    """
    t = F.try_to_timestamp(_c(s), F.lit(fmt))
    if source_tz:
        t = F.to_utc_timestamp(t, source_tz)
    return t.cast("timestamp_ntz")


def event_date(ts) -> Column:
    return F.to_date(_c(ts))


def utc_instant(ts) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP instant, whatever
    the session time zone (used for watermarks and event-time windows)."""
    return F.timestamp_micros(epoch_us(ts))


def ntz_from_instant(ts) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in UTC (inverse of
    :func:`utc_instant`)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.expr(_EPOCH_NTZ))
