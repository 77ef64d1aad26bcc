"""Time conversions and date-dimension parts.

Every function maps Column -> Column with Spark built-ins, so it stays inside
whole-stage codegen. Timestamps are interpreted in the session zone, which
``starweave.use_utc`` pins to UTC.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The SAS calendar starts at 1960-01-01; a converted day number
# must land in the proleptic range 0001-01-01 .. 9999-12-31, i.e. offsets
# -715510 .. 2936549 days (anything else is "bad input" and becomes null).
SAS_EPOCH = _dt.date(1960, 1, 1)
SAS_MIN_DAYS = -715510
SAS_MAX_DAYS = 2936549

# Weekday numberings found in the three back ends of the reference.
WEEKDAY_BASES = ("mon0", "sun0", "sun1")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_epoch_millis(ts: Column | str) -> Column:
    """Timestamp (zoned or not) -> BIGINT epoch milliseconds, truncating."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def millis_to_timestamp(ms: Column | str, ntz: bool = True) -> Column:
    """Epoch milliseconds -> timestamp with millisecond precision."""
    out = F.timestamp_millis(_c(ms))
    return out.cast("timestamp_ntz") if ntz else out


def millis_to_second(ms: Column | str, ntz: bool = True) -> Column:
    """``TIMESTAMP 'epoch' + (ts / 1000) * interval '1 second'``.

    The division is on integers, so it truncates towards zero; the result has
    whole seconds.
    """
    secs = F.call_function("div", _c(ms), F.lit(1000))
    out = F.timestamp_seconds(secs)
    return out.cast("timestamp_ntz") if ntz else out


def millis_to_date(ms: Column | str) -> Column:
    """Epoch milliseconds -> date (time of day dropped)."""
    return F.to_date(F.timestamp_millis(_c(ms)))


def start_time(ms: Column | str, precision: str = "millisecond") -> Column:
    """Start time of a play at the chosen precision: millisecond|second|day."""
    if precision == "millisecond":
        return millis_to_timestamp(ms)
    if precision == "second":
        return millis_to_second(ms)
    if precision == "day":
        return millis_to_date(ms)
    raise ValueError(f"unknown precision {precision!r}")


def sas_to_date(days: Column | str) -> Column:
    """SAS day number (days since 1960-01-01, double) -> date.

    The number is truncated towards zero like Python's ``int``; NaN, null,
    unparsable or out-of-calendar values give null instead of failing.
    """
    n = _c(days).try_cast("int")
    ok = n.between(SAS_MIN_DAYS, SAS_MAX_DAYS)
    return F.when(ok, F.date_add(F.lit(SAS_EPOCH), n))


def weekday(ts: Column | str, base: str = "mon0") -> Column:
    """E10 in its three numberings.

    ``mon0``: Monday = 0 (pandas); ``sun0``: Sunday = 0 (Redshift DOW);
    ``sun1``: Sunday = 1 (Spark ``dayofweek``).
    """
    ts = _c(ts)
    if base == "mon0":
        return F.weekday(ts)
    if base == "sun0":
        return F.dayofweek(ts) - 1
    if base == "sun1":
        return F.dayofweek(ts)
    raise ValueError(f"weekday base must be one of {WEEKDAY_BASES}")


def time_parts(ts: Column | str, weekday_base: str = "mon0") -> list[Column]:
    """Hour, day, week (ISO), month, year, weekday as int columns."""
    ts = _c(ts)
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday(ts, weekday_base).cast("int").alias("weekday"),
    ]


def date_from_parts(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """``to_date(concat_ws('-', y, m, d))``; invalid parts -> null.

    ``concat_ws`` skips null parts, and the ANSI-safe ``try_to_date`` turns
    impossible dates (month 0, day 32) into null rather than an error.
    """
    return F.try_to_date(F.concat_ws("-", _c(year), _c(month), _c(day)))
