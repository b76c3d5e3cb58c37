"""Time expressions: wall clock to UTC, epoch numbers, buckets, ISO text."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MS = 1_000
MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND
UNIT_MICROS = {
    "Second": MICROS_PER_SECOND,
    "Minute": 60 * MICROS_PER_SECOND,
    "Day": MICROS_PER_DAY,
}
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z")
_EPOCH = datetime(1970, 1, 1)


def to_utc(local: Column, tz: str | Column) -> Column:
    """Wall-clock time in ``tz`` to the UTC instant."""
    if isinstance(tz, str) and tz in UTC_NAMES:
        return local.cast("timestamp")
    return F.to_utc_timestamp(local.cast("timestamp"), tz)


def epoch_ms(instant: Column) -> Column:
    """Milliseconds since 1970, rounded down."""
    return F.unix_millis(instant)


def epoch_ns(instant: Column) -> Column:
    return F.unix_micros(instant) * F.lit(1000).cast("bigint")


def iso(instant: Column) -> Column:
    """Round-trip ISO text in UTC with seven fraction digits."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'")


def bucket_start(micros: Column, width: int, offset: int = 0) -> Column:
    """Start of the ``width`` bucket that holds ``micros``; exact in 64-bit integers."""
    return micros - F.pmod(micros - F.lit(offset).cast("bigint"), F.lit(width).cast("bigint"))


def naive_utc(value: datetime | str) -> datetime:
    """An instant as a naive UTC datetime; text without an offset is taken as UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def micros_of(value: datetime | str) -> int:
    return (naive_utc(value) - _EPOCH) // timedelta(microseconds=1)


def instant(value: datetime | str) -> Column:
    """A TIMESTAMP literal that does not depend on any session zone."""
    return F.timestamp_micros(F.lit(micros_of(value)).cast("bigint"))


def wall_clock(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal for comparing with source-local times."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
