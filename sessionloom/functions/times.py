"""Column helpers for instants, local wall-clock values and calendar partitions.

Instants enter as ``timestamp``, ``timestamp_ntz`` (read as UTC), text or epoch
milliseconds and are normalised to a UTC ``timestamp_ntz``. Local wall-clock
values are ``timestamp_ntz`` as well, so no session time zone can shift them
again. The session time zone has to be UTC (see ``session.require_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def whole_seconds(c: Column) -> Column:
    """Epoch seconds, fractions floored away: gap tests work on whole seconds."""
    return F.unix_seconds(c.cast("timestamp"))


def exact_seconds(c: Column) -> Column:
    """Epoch seconds with the fraction kept."""
    return c.cast("timestamp").cast("double")


def shift_seconds(c: Column, seconds: int) -> Column:
    """Move a timestamp by a fixed number of seconds."""
    return c + F.make_dt_interval(secs=F.lit(seconds))


def utc_time(c: Column, dtype: T.DataType, encoding: str = "time") -> Column:
    """Normalise one time column to a UTC ``timestamp_ntz``; unreadable values give null."""
    if encoding == "epoch_ms":
        return F.timestamp_millis(epoch_ms(c, dtype)).cast("timestamp_ntz")
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.timestamp_seconds(c).cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def epoch_ms(c: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds as a long; a long column is left bare so that filters on it push down."""
    if isinstance(dtype, T.LongType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_millis(c.cast("timestamp"))
    return c.try_cast("bigint")


def local_time(c: Column, zone: str) -> Column:
    """UTC ``timestamp_ntz`` to the wall clock of ``zone``.

    With the session zone at UTC the casts keep the digits; a constant zone is resolved
    once here, while ``convert_timezone`` looks both zones up again for every row.
    """
    return F.from_utc_timestamp(c.cast("timestamp"), zone).cast("timestamp_ntz")


def local_day_bounds(day: str, next_day: str, zone: str) -> tuple[Column, Column]:
    """Half-open UTC bounds of the local days ``[day, next_day)`` as foldable literals."""
    lo, hi = (
        F.convert_timezone(F.lit(zone), F.lit("UTC"), F.lit(d).cast("timestamp_ntz"))
        for d in (day, next_day)
    )
    return lo, hi


def ymd(date: Column) -> dict[str, Column]:
    """Partition columns of a date: integer year, zero-padded month and day."""
    return {
        "year": F.year(date),
        "month": F.format_string("%02d", F.month(date)),
        "day": F.format_string("%02d", F.dayofmonth(date)),
    }
