"""Times: statement time, epoch buckets, windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: Column | datetime | str | None) -> Column:
    """A timestamp column; None means the statement's own time."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp")


def day(value: Column | date | str | None) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def time_bucket(ts: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide slot since the epoch that holds ``ts``."""
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000))


def bucket_start(bucket: Column, seconds: int) -> Column:
    return F.timestamp_seconds(bucket * F.lit(seconds))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def ratio(part: Column, whole: Column) -> Column:
    """NULL where the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
