"""Normalising, validating, ranges and stream selection."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, ms, rows_of
from tapeweave.operators import bars as ob
from tapeweave.operators import ranges as rg
from tapeweave.schema import (check_market_data_type, check_period, check_timeframe, resolve_streams)
from tapeweave.session import require_utc

RAW = ("symbol string, contract string, price_type string, time timestamp_ntz, open double, high double, "
       "low double, close double, volume double")


def raw(spark, *times, volume=1.0, symbol="ES", price=1.0):
    return spark.createDataFrame([(symbol, "ES H4", "last", datetime.fromisoformat(t), price, 2.0, 0.5, 1.5, volume)
                                  for t in times], RAW)


def test_normalize_truncates_volume_and_sub_millisecond_key(spark):
    row = ob.normalize(raw(spark, "2024-01-05 00:00:00.000999", volume=2.7)).first()
    assert row["volume"] == 2
    assert row["unix_ms"] == ms("2024-01-05 00:00:00")
    assert row["timestamp"] == datetime(2024, 1, 5, 0, 0, 0, 999)


def test_normalize_before_1970_rounds_down(spark):
    assert ob.normalize(raw(spark, "1969-12-31 23:59:59.999500")).first()["unix_ms"] == -1


@pytest.mark.parametrize("local, utc", [
    ("2024-03-10 01:30:00", "2024-03-10 06:30:00"),
    ("2024-03-10 02:30:00", "2024-03-10 07:30:00"),   # inside the spring gap
    ("2024-03-10 03:30:00", "2024-03-10 07:30:00"),
    ("2024-11-03 01:30:00", "2024-11-03 05:30:00"),   # ambiguous: the earlier instant
    ("2024-11-03 02:30:00", "2024-11-03 07:30:00"),
])
def test_normalize_daylight_saving(spark, local, utc):
    assert ob.normalize(raw(spark, local), "America/New_York").first()["unix_ms"] == ms(utc)


def test_session_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_validate_splits_null_and_blank(spark):
    df = ob.normalize(raw(spark, "2024-01-05").unionAll(raw(spark, "2024-01-06", symbol=" "))
                      .unionAll(raw(spark, "2024-01-07", price=None))
                      .unionAll(raw(spark, "2024-01-08", symbol=None, volume=None))
                      .unionAll(raw(spark, "2024-01-09", price=float("nan"))))
    good, rejected = ob.validate_bars(df)
    assert good.count() == 2
    assert [r[0] for r in rejected.select("reject_reason").orderBy("unix_ms").collect()] == [
        "blank symbol", "null: open", "null: symbol,volume"]


def test_request_days_are_local_and_inclusive(spark):
    request = rg.resolve_range(date(2024, 1, 5), date(2024, 1, 6), datetime(2024, 2, 1, 12))
    df = raw(spark, "2024-01-04 23:59:59.999999", "2024-01-05 00:00:00", "2024-01-06 23:59:59.999999",
             "2024-01-07 00:00:00")
    assert ob.in_range(df, request).count() == 2
    assert request.to_date == request.covered_to == date(2024, 1, 6)


def test_open_ended_request_does_not_cover_today(spark):
    now = datetime(2024, 2, 1, 12)
    request = rg.resolve_range(date(2024, 1, 5), None, now)
    assert (request.end, request.to_date, request.covered_to) == (now, date(2024, 2, 1), date(2024, 1, 31))
    assert ob.in_range(raw(spark, "2024-02-01 12:00:00", "2024-02-01 12:00:00.000001"), request).count() == 1


def test_request_without_dates_starts_in_1990():
    now = datetime(2024, 2, 1)
    assert rg.resolve_range(None, None, now).start == datetime(1990, 1, 1)
    assert rg.resolve_range(None, date(2024, 1, 1), now).end == datetime(2024, 1, 2)
    with pytest.raises(ValueError):
        rg.resolve_range(date(2024, 1, 2), date(2024, 1, 1), now)


def test_filter_range_keeps_both_ends_at_microseconds(spark):
    df = frame(spark, [bar(t) for t in ("2024-01-05 00:00:00.000499", "2024-01-05 00:00:00.000500",
                                        "2024-01-06 00:00:00.000500", "2024-01-06 00:00:00.000501")])
    assert rg.filter_range(df, "2024-01-05 00:00:00.000500", "2024-01-06 00:00:00.000500").count() == 2


def test_streams():
    assert resolve_streams(None) == resolve_streams(" ALL ") == ["last", "bid", "ask"]
    assert resolve_streams("Bid") == ["bid"]
    with pytest.raises(ValueError):
        resolve_streams("trades")


@pytest.mark.parametrize("call", [lambda: check_period("minute"), lambda: check_period("Minute", 0),
                                  lambda: check_market_data_type("last"), lambda: check_timeframe("hours")])
def test_vocabulary_is_checked(call):
    with pytest.raises(ValueError):
        call()


def test_fetch_and_chunk_limits():
    assert [rg.fetch_limit_days(*p) for p in (("Tick", 1), ("Second", 5), ("Minute", 1), ("Minute", 60), ("Day", 1))] \
        == [1, 1, 31, 1825, 18250]
    assert [rg.backfill_chunk_days(*p) for p in (("Tick", 1), ("Second", 1), ("Minute", 5), ("Minute", 60), ("Day", 1))] \
        == [1, 1, 7, 30, 365]
    assert [rg.export_chunk_days(p) for p in ("Tick", "Minute")] == [1, 30]


def test_chunks_clip_the_last(spark):
    got = rg.chunk_ranges(spark, "2024-01-01", "2024-01-10 06:00:00", 4).orderBy("chunk_idx").collect()
    assert [(r["chunk_from"].day, r["chunk_to"].day) for r in got] == [(1, 5), (5, 9), (9, 10)]
    assert got[-1]["chunk_to"] == datetime(2024, 1, 10, 6)
    with pytest.raises(ValueError):
        rg.chunk_count("2024-01-02", "2024-01-02", 1)


def test_chunk_edges_belong_to_one_chunk(spark):
    df = frame(spark, [bar(t) for t in ("2024-01-01", "2024-01-04 23:59:59.999999", "2024-01-05", "2024-01-09")])
    idx = rg.chunk_index(F.col("timestamp"), "2024-01-01", "2024-01-09", 4)
    assert [r[0] for r in df.orderBy("timestamp").select(idx).collect()] == [0, 0, 1, 1]


def test_pages_meet_without_overlap():
    pages = rg.page_windows("2024-01-01", "2024-01-04 12:00:00", 1)
    assert pages[0][0] == datetime(2024, 1, 1) and pages[-1][1] == datetime(2024, 1, 4, 12)
    assert all(a[1] == b[0] for a, b in zip(pages, pages[1:])) and len(pages) == 4


def test_union_fills_missing_columns(spark):
    a = frame(spark, [bar("2024-01-01")]).select("symbol", "price_type", "open")
    b = frame(spark, [bar("2024-01-02", symbol="NQ")]).select("open", "symbol")
    out = ob.union_sources(a, b)
    assert rows_of(out.filter("symbol = 'NQ'"), "symbol", "price_type") == [("NQ", None)]
