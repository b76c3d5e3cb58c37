"""Sessions in exchange time: daylight saving, weekends, holidays, unknown symbols, many symbols."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators import sessions as ses
from tapeweave.session import workspace

CHICAGO = [("cme", "America/Chicago", "17:00:00", 1)]


def listed(spark, calendars=CHICAGO, holidays=(), first=date(2024, 3, 1), last=date(2024, 3, 31), **more):
    return ses.sessions(spark.createDataFrame(calendars, ses.CALENDARS), spark.createDataFrame(list(holidays), ses.HOLIDAYS), first, last, **more)


def opening(df, day):
    return df.filter(F.col("session_date") == F.lit(day).cast("date")).first()["opens_at"]


def test_openings_move_with_daylight_saving(spark):
    df = listed(spark)
    assert opening(df, "2024-03-08") == datetime(2024, 3, 7, 23)   # standard time
    assert opening(df, "2024-03-11") == datetime(2024, 3, 10, 22)  # the clocks went forward that Sunday
    assert df.filter("dayofweek(session_date) IN (1, 7)").isEmpty()


def test_sessions_leave_no_gap(spark):
    df = listed(spark, holidays=[(None, date(2024, 3, 29)), ("cme", date(2024, 3, 20)), ("other", date(2024, 3, 21))]).orderBy("session_date").collect()
    assert all(a["next_at"] == b["opens_at"] for a, b in zip(df, df[1:]))
    days = {r["session_date"] for r in df}
    assert date(2024, 3, 29) not in days and date(2024, 3, 20) not in days and date(2024, 3, 21) in days


def test_an_opening_the_clock_skips(spark):
    df = listed(spark, [("early", "America/New_York", "02:30:00", 0)], weekdays=(1, 2, 3, 4, 5, 6, 7))
    assert opening(df, "2024-03-10") == datetime(2024, 3, 10, 7, 30)  # 03:30 there, an hour later by the clock
    assert opening(df, "2024-03-11") == datetime(2024, 3, 11, 6, 30)


def of_symbol(spark, *pairs):
    return spark.createDataFrame(list(pairs), "symbol string, calendar string")


def test_bars_by_session(spark):
    rows = [bar("2024-03-08 21:59:59", 1, seq=1), bar("2024-03-08 23:30:00", 2, seq=2), bar("2024-03-09 12:00:00", 3, seq=3),
            bar("2024-03-10 21:59:59", 4, seq=4), bar("2024-03-10 22:00:00", 5, seq=5), bar("2024-03-11 21:59:59", 6, seq=6),
            bar("2024-03-11 22:00:00", 7, seq=7), bar("2024-03-11 05:00:00", 9, symbol="XX", seq=8)]
    out = ses.session_bars(frame(spark, rows), listed(spark), of_symbol(spark, ("ES", "cme")))
    assert rows_of(out.filter("symbol = 'ES'"), "session_date", "volume", "n") == [
        (date(2024, 3, 8), 10, 4), (date(2024, 3, 11), 11, 2), (date(2024, 3, 12), 7, 1)]
    other = out.filter("symbol = 'XX'").first()
    assert (other["session_date"], other["timestamp"], other["n"]) == (None, datetime(2024, 3, 11), 1)
    assert out.agg(F.sum("n")).first()[0] == len(rows)


def test_bars_outside_the_listed_days_are_kept(spark):
    rows = [bar("2020-01-01 10:00:00", 1, seq=1), bar("2024-03-08 10:00:00", 2, seq=2)]
    out = ses.session_bars(frame(spark, rows), listed(spark), of_symbol(spark, ("ES", "cme")))
    assert rows_of(out.withColumn("known", F.col("session_date").isNotNull()), "known", "volume") == [(False, 1), (True, 2)]


def test_clashing_columns_are_replaced(spark):
    rows = frame(spark, [bar("2024-03-08 10:00:00", 2)]).withColumn("calendar", F.lit("x")).withColumn("session_date", F.lit(1))
    out = ses.with_session(rows, listed(spark), of_symbol(spark, ("ES", "cme")))
    assert out.first()["session_date"] == date(2024, 3, 8) and out.columns.count("session_date") == 1


@pytest.mark.parametrize("rows", [0, 10**9])
def test_large_calendars_are_joined_by_a_shuffle(spark, monkeypatch, rows):
    import tapeweave.session as s
    monkeypatch.setattr(s, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(s, "BROADCAST_BYTES", rows)
    ticks = [bar(f"2024-03-{d:02d} {h:02d}:00:00", 1, symbol=sym, seq=d * 24 + h) for sym in ("ES", "NQ") for d in range(4, 16) for h in range(24)]
    many = listed(spark, [*CHICAGO, ("xetra", "Europe/Berlin", "09:00:00", 0)])
    out = ses.session_bars(frame(spark, ticks), many, of_symbol(spark, ("ES", "cme"), ("NQ", "xetra")))
    path = workspace(spark, "sessions")
    out.write.parquet(path)
    back = spark.read.parquet(path)
    assert back.agg(F.sum("n")).first()[0] == len(ticks)
    assert back.filter("symbol = 'ES' AND session_date = DATE '2024-03-12'").first()["n"] == 24
    assert back.filter("symbol = 'NQ' AND session_date = DATE '2024-03-08'").first()["n"] == 72
