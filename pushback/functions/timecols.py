"""Column expressions on timestamp_ntz values (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(start, end) -> Column:
    """Fractional seconds ``end - start`` as double; NULL if either is NULL.

    ``timestampdiff(SECOND, …)`` truncates and ``unix_micros`` rejects NTZ,
    so the difference is taken in microseconds.
    """
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1e6)


def whole_seconds_between(start, end) -> Column:
    """Seconds ``end - start`` floored to a whole number, as double."""
    return F.floor(seconds_between(start, end)).cast("double")


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", _col(seconds).cast("bigint"), _col(ts))


def minute_of_day_bin(ts, width_minutes: int = 10) -> Column:
    """``(hour*60 + minute) // width``: the time-of-day bin used as a feature."""
    t = _col(ts)
    return F.floor((F.hour(t) * 60 + F.minute(t)) / F.lit(width_minutes)).cast("int")


def hour_bin(ts) -> Column:
    return F.hour(_col(ts))
