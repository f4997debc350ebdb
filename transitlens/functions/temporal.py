"""Timestamp helpers (all native expressions, session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlens.constants import TS_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_minutes(ts, minutes) -> Column:
    return F.timestamp_add("MINUTE", _c(minutes), _c(ts))


def add_hours(ts, hours) -> Column:
    """Promised delivery = booking + SLA hours."""
    return F.timestamp_add("HOUR", _c(hours), _c(ts))


def seconds_between(a, b) -> Column:
    """Whole seconds from a to b (b - a); null if either is null."""
    return F.unix_timestamp(_c(b)) - F.unix_timestamp(_c(a))


def hour_boundary_diff(a, b) -> Column:
    """Number of hour boundaries crossed from a to b.

    This is the warehouse TIMESTAMPDIFF('HOUR', a, b): 13:59 -> 14:01 is 1,
    14:00 -> 14:59 is 0. Spark's own timestampdiff counts elapsed hours, so
    both ends are truncated to the hour first.
    """
    ha = F.unix_timestamp(F.date_trunc("hour", _c(a)))
    hb = F.unix_timestamp(F.date_trunc("hour", _c(b)))
    return F.call_function("div", hb - ha, F.lit(3600))


def ts_text(ts) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text (the raw-file format)."""
    return F.date_format(_c(ts), TS_FORMAT)


def parse_ts(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> timestamp; malformed -> null."""
    return F.try_to_timestamp(_c(text), F.lit(TS_FORMAT))


def day_name(d) -> Column:
    """Three-letter English day name: 'Mon' .. 'Sun'."""
    return F.date_format(_c(d), "EEE")
