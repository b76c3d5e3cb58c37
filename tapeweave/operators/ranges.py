"""Requested date ranges, inclusive filters, chunks and pages."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.functions.time import (MICROS_PER_DAY, MICROS_PER_MS, UTC_NAMES, instant, micros_of,
                                      naive_utc, wall_clock)
from tapeweave.schema import EARLIEST, check_period

# Longest span one fetch may ask for, in days.
FETCH_LIMIT_DAYS = {"Tick": 1, "Second": 1, "Minute": 31, "Day": 365 * 50}
FETCH_LIMIT_HOURLY_DAYS = 365 * 5
# Chunk lengths of the export scan and of the back-fill, in days.
EXPORT_CHUNK_DAYS = {"Tick": 1, "Second": 30, "Minute": 30, "Day": 365 * 50}
BACKFILL_CHUNK_DAYS = {"Tick": 1, "Second": 1, "Minute": 7, "Day": 365}
BACKFILL_CHUNK_HOURLY_DAYS = 30


@dataclass(frozen=True)
class DateRange:
    """A request in source-local time. ``end`` is inclusive only when open-ended."""

    start: datetime
    end: datetime
    open_ended: bool

    @property
    def from_date(self) -> date:
        return self.start.date()

    @property
    def to_date(self) -> date:
        """The last day asked for."""
        return self.end.date() if self.open_ended else (self.end - timedelta(days=1)).date()

    @property
    def covered_to(self) -> date:
        """The last day a finished run may claim: an unfinished day is not covered."""
        return self.to_date - timedelta(days=1) if self.open_ended else self.to_date

    def instants(self, tz: str) -> tuple[datetime, datetime]:
        """Both ends as inclusive UTC instants."""
        end = self.end if self.open_ended else self.end - timedelta(microseconds=1)
        zone = ZoneInfo(tz)
        return self.start.replace(tzinfo=zone), end.replace(tzinfo=zone)


def local_now(now: datetime, tz: str = "UTC") -> datetime:
    """``now`` on the source's wall clock; a value without a zone is taken as UTC."""
    return naive_utc(now) if tz in UTC_NAMES else \
        naive_utc(now).replace(tzinfo=timezone.utc).astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def resolve_range(frm: date | None, to: date | None, now: datetime, tz: str = "UTC") -> DateRange:
    """Whole local days when both ends are given; from 1990 and up to ``now`` otherwise.

    An open end is the instant ``now`` in ``tz``. There a value without a zone
    could be meant either way, so it is refused unless ``tz`` is UTC.
    """
    if frm and to and to < frm:
        raise ValueError("the to date must be on or after the from date")
    if to is None:
        if now.tzinfo is None and tz not in UTC_NAMES:
            raise ValueError(f"an open-ended request in {tz} needs a now with a time zone")
        now = local_now(now, tz)
    start = datetime.combine(frm or date.fromisoformat(EARLIEST), datetime.min.time())
    if to is None:
        return DateRange(start, now, True)
    return DateRange(start, datetime.combine(to, datetime.min.time()) + timedelta(days=1), False)


def in_request(time: Column, request: DateRange) -> Column:
    """Source-local times inside the request, both ends included.

    The end of a closed day is written as "before the next midnight".
    """
    upper = time <= wall_clock(request.end) if request.open_ended else time < wall_clock(request.end)
    return (time >= wall_clock(request.start)) & upper


def filter_range(df: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Instants with ``start <= timestamp <= end``.

    The millisecond key is bounded as well: it is part of the store's window
    key, so that bound moves below the window and down to the file scan.
    """
    low, high = micros_of(start), micros_of(end)
    by_key = F.col("unix_ms").between(F.lit(low // MICROS_PER_MS).cast("bigint"),
                                      F.lit(high // MICROS_PER_MS).cast("bigint"))
    return df.filter(by_key).filter(F.col("timestamp").between(instant(start), instant(end)))


def fetch_limit_days(period_type: str, value: int = 1) -> int:
    check_period(period_type, value)
    if period_type == "Minute" and value >= 60:
        return FETCH_LIMIT_HOURLY_DAYS
    return FETCH_LIMIT_DAYS[period_type]


def backfill_chunk_days(period_type: str, value: int = 1) -> int:
    check_period(period_type, value)
    if period_type == "Minute" and value >= 60:
        return BACKFILL_CHUNK_HOURLY_DAYS
    return BACKFILL_CHUNK_DAYS[period_type]


def export_chunk_days(period_type: str) -> int:
    check_period(period_type)
    return EXPORT_CHUNK_DAYS[period_type]


def chunk_count(start: datetime | str, end: datetime | str, days: int) -> int:
    """How many ``days`` steps cover ``[start, end]``; depends on the request alone."""
    if days < 1:
        raise ValueError("chunk length must be at least one day")
    span = micros_of(end) - micros_of(start)
    if span <= 0:
        raise ValueError("the end must be after the start")
    return -(-span // (days * MICROS_PER_DAY))


def with_chunks(df: DataFrame, start: datetime | str, end: datetime | str, days: int) -> DataFrame:
    """Repeat each row per chunk: ``chunk_idx``, ``chunk_from``, ``chunk_to``.

    The last chunk is clipped to ``end``.
    """
    n = chunk_count(start, end, days)
    first, last = micros_of(start), micros_of(end)
    width = F.lit(days * MICROS_PER_DAY).cast("bigint")
    chunk_from = F.lit(first).cast("bigint") + F.col("chunk_idx") * width
    return (df.withColumn("chunk_idx", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                            F.lit(n - 1).cast("bigint"))))
            .withColumn("chunk_from", F.timestamp_micros(chunk_from))
            .withColumn("chunk_to", F.timestamp_micros(
                F.least(chunk_from + width, F.lit(last).cast("bigint")))))


def chunk_index(time: Column, start: datetime | str, end: datetime | str, days: int) -> Column:
    """The chunk a bar belongs to: half-open chunks, the last one closed."""
    n = chunk_count(start, end, days)
    elapsed = F.unix_micros(time) - F.lit(micros_of(start)).cast("bigint")
    width = F.lit(days * MICROS_PER_DAY).cast("bigint")
    idx = ((elapsed - F.pmod(elapsed, width)) / width).cast("bigint")
    return F.least(idx, F.lit(n - 1).cast("bigint"))


def chunk_ranges(spark: SparkSession, start: datetime | str, end: datetime | str, days: int) -> DataFrame:
    return with_chunks(spark.range(1).select(), start, end, days)


def page_windows(start: datetime | str, end: datetime | str, days: int) -> list[tuple[datetime, datetime]]:
    """Half-open pages a caller walks to stay under the fetch limit; the last one is closed."""
    first, last = naive_utc(start), naive_utc(end)
    n = chunk_count(start, end, days)
    step = timedelta(days=days)
    return [(first + i * step, min(first + (i + 1) * step, last)) for i in range(n)]
