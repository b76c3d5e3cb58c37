"""Dedup, stitch, arrival upserts."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.stitch import dedup, latest_wins, stitch, unpack_winner, winner
from tapeweave.schema import KEY

T0, T1, T2 = "2024-01-05 10:00:00", "2024-01-05 10:01:00", "2024-01-05 10:02:00"
FRONT, BACK = date(2024, 3, 15), date(2024, 6, 21)


def two_contracts(spark):
    return frame(spark, [
        bar(T0, 5, "ES H4", expiry=FRONT), bar(T0, 9, "ES M4", expiry=BACK, price=20.0),   # back month wins
        bar(T1, 7, "ES H4", expiry=FRONT), bar(T1, 7, "ES M4", expiry=BACK, price=20.0),   # tie: earlier expiry
        bar(T2, 1, "ES M4", expiry=BACK, price=20.0),                                      # only the back month
        bar(T1, 1, "ES H4", "bid", expiry=FRONT)])


def test_volume_rule(spark):
    out = rows_of(stitch(two_contracts(spark)), "price_type", "unix_ms", "contract", "volume", "open")
    assert [(p, c, v, o) for p, _, c, v, o in out] == [
        ("bid", "ES H4", 1, 10.0), ("last", "ES M4", 9, 20.0), ("last", "ES H4", 7, 10.0), ("last", "ES M4", 1, 20.0)]


def test_expiry_comes_from_the_catalog(spark):
    bars = two_contracts(spark).drop("expiry")
    catalog = spark.createDataFrame([("ES", "ES H4", BACK), ("ES", "ES M4", FRONT)],
                                    "symbol string, contract string, expiry date")
    out = dict((u, c) for p, u, c in rows_of(stitch(bars, catalog), "price_type", "unix_ms", "contract") if p == "last")
    assert sorted(out.values()) == ["ES M4", "ES M4", "ES M4"]


def test_contract_missing_in_catalog_loses_ties(spark):
    bars = two_contracts(spark).drop("expiry")
    catalog = spark.createDataFrame([("ES", "ES M4", BACK)], "symbol string, contract string, expiry date")
    tie = stitch(bars, catalog).filter("price_type = 'last' AND volume = 7")
    assert tie.first()["contract"] == "ES M4"


def test_dedup_stays_within_the_contract(spark):
    df = frame(spark, [bar(T0, 1), bar(T0, 3, price=11.0), bar(T0, 3, price=12.0), bar(T0, 2, "ES M4")])
    assert rows_of(dedup(df), "contract", "volume", "close") == [("ES H4", 3, 12.0), ("ES M4", 2, 10.0)]


def test_ticks_of_one_millisecond(spark):
    df = frame(spark, [bar("2024-01-05 10:00:00.000100", 1, seq=1), bar("2024-01-05 10:00:00.000200", 4, seq=2)])
    assert rows_of(stitch(df), "volume") == [(4,)]
    assert rows_of(stitch(df, keep_all_ticks=True), "volume") == [(1,), (4,)]


def sequential_upserts(rows):
    """Contracts in expiry order, each reduced to one bar per key, strictly higher volume replaces."""
    store = {}
    for expiry, contract in sorted({(r[9], r[1]) for r in rows}):
        staged = {}
        for r in (r for r in rows if r[1] == contract):
            key = (r[0], r[2], r[3])
            if key not in staged or (r[8], r[4]) > (staged[key][8], staged[key][4]):
                staged[key] = r
        for key, r in staged.items():
            if key not in store or r[8] > store[key][8]:
                store[key] = r
    return sorted((k[0], k[1], r[1], r[8], r[4]) for k, r in store.items())


@pytest.mark.parametrize("seed", range(3))
def test_equals_sequential_upserts(spark, seed):
    rng = random.Random(seed)
    months = [("ES H4", FRONT), ("ES M4", BACK), ("ES U4", date(2024, 9, 20))]
    rows = []
    for _ in range(400):
        contract, expiry = rng.choice(months)
        rows.append(bar(f"2024-01-05 10:{rng.randrange(30):02d}:00", rng.randrange(4), contract,
                        rng.choice(["last", "bid"]), float(rng.randrange(50)), expiry=expiry))
    got = rows_of(stitch(frame(spark, rows)), "symbol", "price_type", "contract", "volume", "open")
    assert got == sequential_upserts(rows)


def test_winner_aggregate_equals_the_window(spark):
    rng = random.Random(9)
    rows = [bar(f"2024-01-05 10:00:{rng.randrange(20):02d}", rng.randrange(3), rng.choice(["ES H4", "ES M4"]),
                price=float(rng.randrange(5)), expiry=rng.choice([FRONT, None])) for _ in range(300)]
    df = frame(spark, rows)
    cols = [*KEY, "contract", "open", "high", "low", "close", "volume", "timestamp"]
    assert rows_of(unpack_winner(df.groupBy(*KEY).agg(winner().alias("w"))), *cols) == rows_of(stitch(df), *cols)


def test_latest_arrival_wins_even_with_less_volume(spark):
    df = frame(spark, [bar(T0, 9, seq=1), bar(T0, 1, seq=2), bar(T0, 5, "ES M4", seq=0)])
    rows = df.select(F.col("timestamp").alias("ts_event"), F.col("contract").alias("symbol"), "price_type", "volume", "seq")
    assert rows_of(latest_wins(rows, [F.col("seq")]), "symbol", "volume") == [("ES H4", 1), ("ES M4", 5)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most of the rows leaves at most one row per map task."""
    df = (spark.range(0, 200_000, numPartitions=8)
          .select(F.lit("ES").alias("symbol"), F.lit("ES H4").alias("contract"), F.lit("last").alias("price_type"),
                  F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("bigint").alias("unix_ms"),
                  F.timestamp_millis("id").alias("timestamp"), *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")],
                  F.col("id").alias("volume"), F.lit(None).cast("date").alias("expiry")))
    out = stitch(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert out.count() == df.select("unix_ms").distinct().count()
