"""Time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERVALS = ("minute", "hour", "day")


def epoch_year(seconds: Column, zone: str = "UTC") -> Column:
    """Calendar year of epoch seconds in `zone`, whatever the session zone is."""
    nothing = F.lit(0)
    since_epoch = F.make_dt_interval(nothing, nothing, nothing, seconds.cast("decimal(18,6)"))
    utc = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + since_epoch
    return F.year(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def bucket(interval: str, at: Column) -> Column:
    """Start of the minute, hour or day. Spark turns an unknown unit into NULL,
    so other units are refused here."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {', '.join(INTERVALS)}, not {interval!r}")
    return F.date_trunc(interval, at)


def epoch_seconds(at: Column) -> Column:
    """Timestamp as epoch seconds with its fraction."""
    return F.unix_micros(at) / F.lit(1e6)
