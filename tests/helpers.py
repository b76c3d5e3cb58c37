"""Small frames for the operator tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
COLUMNS = ("symbol string, contract string, price_type string, ts timestamp_ntz, open double, high double, "
           "low double, close double, volume bigint, expiry date, seq bigint")


def ms(value: str) -> int:
    return (datetime.fromisoformat(value) - EPOCH) // timedelta(milliseconds=1)


def bar(ts, volume=1, contract="ES H4", price_type="last", price=10.0, symbol="ES", expiry=date(2024, 3, 15), seq=0):
    return (symbol, contract, price_type, datetime.fromisoformat(ts), price, price + 1, price - 1, price, volume,
            expiry, seq)


def frame(spark, rows):
    """Stored-bar columns plus expiry and seq."""
    df = spark.createDataFrame(rows, COLUMNS).withColumn("timestamp", F.col("ts").cast("timestamp"))
    return df.withColumn("unix_ms", F.unix_millis("timestamp")).drop("ts")


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
