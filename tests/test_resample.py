"""Time bars and tick-count bars."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.resample import resample


def test_first_and_last_follow_sequence_at_equal_times(spark):
    df = frame(spark, [bar("2024-01-05 10:00:01", price=p, seq=s) for p, s in ((5.0, 2), (7.0, 1), (6.0, 3))]
               + [bar("2024-01-05 10:00:59.999999", price=4.0, seq=-1)])
    row = resample(df, "Minute", 1).first()
    assert (row["open"], row["high"], row["low"], row["close"], row["volume"], row["n"]) == (7.0, 8.0, 3.0, 4.0, 4, 4)
    assert row["timestamp"] == datetime(2024, 1, 5, 10, 0)


def test_negative_sequence_sorts_first(spark):
    df = frame(spark, [bar("2024-01-05 10:00:01", price=1.0, seq=2**62), bar("2024-01-05 10:00:01", price=2.0, seq=-2**62),
                       bar("2024-01-05 10:00:01.000001", price=3.0, seq=-2**63)])
    row = resample(df, "Second", 1).first()
    assert (row["open"], row["close"]) == (2.0, 3.0)


def test_buckets_before_1970(spark):
    assert resample(frame(spark, [bar("1969-12-31 23:59:30")]), "Minute", 1).first()["timestamp"] == datetime(1969, 12, 31, 23, 59)


def test_session_day_starts_the_evening_before(spark):
    df = frame(spark, [bar("2024-01-05 21:59:59"), bar("2024-01-05 22:00:00"), bar("2024-01-06 21:00:00")])
    assert rows_of(resample(df, "Day", 1, session_offset_hours=22), "timestamp", "n") == [
        (datetime(2024, 1, 4, 22), 1), (datetime(2024, 1, 5, 22), 2)]


def test_bars_to_bars_equals_ticks_to_bars(spark):
    rng = random.Random(1)
    start = datetime(2024, 1, 5)
    df = frame(spark, [bar((start + timedelta(seconds=rng.randrange(86_400))).isoformat(), rng.randrange(9), price=rng.random(),
                           seq=i) for i in range(500)])
    df = df.withColumn("high", F.col("open")).withColumn("low", F.col("open"))
    cols = ["timestamp", "open", "high", "low", "close", "volume"]
    assert rows_of(resample(resample(df, "Minute", 5), "Minute", 60), *cols) == rows_of(resample(df, "Minute", 60), *cols)


def test_high_and_low_bound_the_bar(spark, sf_dir):
    from tapeweave import fixtures as fx
    out = resample(fx.ticks(spark, sf_dir), "Minute", 60)
    assert out.filter("high < greatest(open, close) OR low > least(open, close)").isEmpty()


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_tick_bars_against_a_plain_walk(spark, n):
    """One series holds most rows, and most of those share one instant."""
    rng = random.Random(n)
    rows = [bar("2024-01-05 10:00:00", 1, price=float(rng.randrange(100)), seq=i) for i in range(900)]
    rows += [bar(f"2024-01-05 09:{i % 60:02d}:00", 1, "ES M4", price=float(i), seq=i) for i in range(120)]
    rng.shuffle(rows)
    want = []
    for contract in ("ES H4", "ES M4"):
        walk = sorted((r for r in rows if r[1] == contract), key=lambda r: (r[3], r[10]))
        for i in range(0, len(walk), n):
            part = walk[i:i + n]
            want.append((contract, i, part[0][4], max(r[5] for r in part), min(r[6] for r in part), part[-1][7], len(part)))
    got = rows_of(resample(frame(spark, rows).repartition(5), "Tick", n),
                  "contract", "first_tick", "open", "high", "low", "close", "volume")
    assert got == sorted(want)


def test_hash_aggregate_with_a_partial_step(spark, sf_dir):
    from tapeweave import fixtures as fx
    plan = resample(fx.ticks(spark, sf_dir), "Minute", 60)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
