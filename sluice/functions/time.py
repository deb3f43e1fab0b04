"""Time helpers that stay correct whatever the session time zone is.

The fixtures store ``timestamp[us]`` without zone, which Spark reads as
TIMESTAMP_NTZ. Arithmetic on NTZ values is done with zone-free functions so a
driver session in a non-UTC zone gives the same answers as DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _day_seconds(ts: Column) -> Column:
    """Whole seconds from 1970-01-01 to the start of the minute of ``ts``,
    from calendar fields only (no time zone is consulted, so wall-clock
    times inside a DST gap are not shifted)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts).cast("long") * 3600 + F.minute(ts).cast("long") * 60


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ wall-clock value
    (floor), the same number ``unix_timestamp`` gives in a UTC session."""
    return _day_seconds(ts) + F.second(ts).cast("long")


def epoch_micros(ts: Column) -> Column:
    frac = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return _day_seconds(ts) * 1_000_000 + frac


def seconds_between(start: Column, end: Column) -> Column:
    """``unix_timestamp(end) - unix_timestamp(start)``: each side floored to
    the second, then subtracted (the reference rule's semantics)."""
    return epoch_seconds(end) - epoch_seconds(start)


def add_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def add_hours(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(hours)} HOURS")


def floor_day(ts: Column) -> Column:
    return F.to_date(ts)


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the tumbling ``minutes`` bucket (aligned to the epoch), same
    as ``window(ts, 'N minutes').start`` in a UTC session and DuckDB
    ``time_bucket``; computed on the wall clock, so zone-free."""
    width = int(minutes) * 60_000_000
    start = F.floor(epoch_micros(ts) / F.lit(width)).cast("long") * width
    return instant_to_ntz(F.timestamp_micros(start))


def minute_stamp(ts: Column) -> Column:
    """``yyyyMMdd'T'HHmm`` stamp used in flush file names."""
    return F.format_string("%04d%02d%02dT%02d%02d", F.year(ts), F.month(ts), F.dayofmonth(ts),
                           F.hour(ts), F.minute(ts))


def ntz_to_instant(ts: Column) -> Column:
    """Read an NTZ wall-clock as a UTC instant (TIMESTAMP), zone-free.
    Watermarks reject NTZ, so streams convert with this first."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts: Column) -> Column:
    """Inverse of :func:`ntz_to_instant`: the instant's UTC wall clock."""
    us = F.unix_micros(ts)
    day_us = F.lit(86_400_000_000)
    days = F.floor(us / day_us).cast("long")
    rem = us - days * day_us
    d = F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))
    secs = ((rem % 60_000_000) / F.lit(1_000_000)).cast("decimal(16,6)")
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                (rem / 3_600_000_000).cast("int"),
                                ((rem / 60_000_000) % 60).cast("int"), secs)


def iso_timestamp(ts: Column) -> Column:
    """Engine-neutral text ``yyyy-MM-dd HH:mm:ss.ffffff`` used when results
    are compared across engines (built from calendar fields: zone-free)."""
    micros = F.pmod(epoch_micros(ts), F.lit(1_000_000))
    return F.format_string("%04d-%02d-%02d %02d:%02d:%02d.%06d", F.year(ts), F.month(ts),
                           F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts), micros)


def iso_timestamp_sql(name: str) -> str:
    """SQL-text form of :func:`iso_timestamp` for ``selectExpr``."""
    c = f"`{name}`"
    return (f"format_string('%04d-%02d-%02d %02d:%02d:%02d.%06d', year({c}), month({c}), "
            f"day({c}), hour({c}), minute({c}), second({c}), "
            f"CAST(date_part('SECOND', {c}) * 1000000 AS BIGINT) % 1000000)")


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")
