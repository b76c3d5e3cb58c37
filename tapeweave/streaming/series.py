"""Continuous series and time bars as streaming aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.functions.time import UNIT_MICROS, epoch_ms
from tapeweave.operators.resample import ohlcv, order_key
from tapeweave.operators.stitch import unpack_winner, winner
from tapeweave.schema import KEY, OHLC, SERIES, check_period


def stitch_stream(bars: DataFrame, lateness: str | None = None) -> DataFrame:
    """The winning bar per key, updated as bars arrive; equals the batch ``stitch``.

    ``bars`` carry ``expiry``. Without ``lateness`` state holds one entry per
    key and nothing is dropped. With it, keys older than the watermark are
    forgotten and later bars for them are ignored: bounded state for
    completeness. Use the RocksDB state store for large key counts.
    """
    keys = list(KEY)
    if lateness:
        bars = bars.withWatermark("timestamp", lateness).withColumn("event_time", F.window("timestamp", "1 day"))
        keys.append("event_time")
    best = bars.groupBy(*keys).agg(winner().alias("w"))
    return unpack_winner(best).select(*KEY, "contract", "timestamp", *OHLC, "volume")


def bar_stream(ticks: DataFrame, unit: str, value: int, lateness: str) -> DataFrame:
    """Time bars of ``unit`` x ``value`` from a tick stream.

    Ticks later than ``lateness`` behind the newest are dropped by the
    watermark: choose it as wide as the source may be late. In update mode
    every open bar is reported; append mode reports closed bars only.
    """
    check_period(unit, value)
    if unit == "Tick":
        raise ValueError("tick-count bars need the whole series: use the batch resample")
    seconds = UNIT_MICROS[unit] * value // 1_000_000
    out = (ticks.withColumn("_order", order_key(ticks)).withWatermark("timestamp", lateness)
           .groupBy(*SERIES, F.window("timestamp", f"{seconds} seconds").alias("span"))
           .agg(*ohlcv(F.col("_order"))))
    start = F.col("span.start")
    return out.select(*SERIES, epoch_ms(start).alias("unix_ms"), start.alias("timestamp"), *OHLC, "volume", "n")
