"""Ticks or bars to larger bars, by time or by number of ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeweave.functions.time import UNIT_MICROS, bucket_start, epoch_ms
from tapeweave.schema import OHLC, SERIES, check_period
from tapeweave.session import join_dim, workspace, written

# One 38-digit number orders rows by (instant, seq). A fixed-width buffer lets
# the aggregate run as a hash aggregate; a struct would force sorts.
_SEQ_SPACE = "20000000000000000000"


def order_key(df: DataFrame) -> Column:
    micros = F.unix_micros("timestamp")
    if "seq" not in df.columns:
        return micros
    return ((micros.cast("decimal(19,0)") * F.lit(_SEQ_SPACE).cast("decimal(20,0)")).cast("decimal(38,0)")
            + F.col("seq").cast("bigint").cast("decimal(19,0)")).cast("decimal(38,0)")


def ohlcv(order: Column) -> list[Column]:
    """First open, highest high, lowest low, last close, summed volume."""
    return [F.min_by("open", order).alias("open"), F.max("high").alias("high"),
            F.min("low").alias("low"), F.max_by("close", order).alias("close"),
            F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n")]


def resample(bars: DataFrame, unit: str, value: int = 1, session_offset_hours: float = 0,
             series: list[str] = SERIES) -> DataFrame:
    """Bars of ``unit`` x ``value`` per series, labelled by bucket start in UTC.

    Input rows need ``timestamp``, open, high, low, close and volume, and are
    ordered by (timestamp, seq); without ``seq`` a series must not repeat an
    instant. ``session_offset_hours`` moves the start of day bars.
    """
    check_period(unit, value)
    if unit == "Tick":
        return tick_bars(bars, value, series)
    width = UNIT_MICROS[unit] * value
    offset = int(session_offset_hours * 3_600_000_000) if unit == "Day" else 0
    start = bucket_start(F.unix_micros("timestamp"), width, offset)
    out = (bars.withColumn("_start", start).withColumn("_order", order_key(bars))
           .groupBy(*series, "_start").agg(*ohlcv(F.col("_order"))))
    return _shape(out, F.timestamp_micros("_start"), series)


def tick_bars(bars: DataFrame, value: int, series: list[str] = SERIES) -> DataFrame:
    """Bars of ``value`` consecutive ticks, labelled by their first tick.

    The tick's place in its series is found without putting a series, or a
    day of one, into one task: a range shuffle on (series, time, seq) splits
    any hot stretch, rows are numbered inside each range, and the number of
    rows in earlier ranges is added. Ranges are written once, so the numbers
    and the counts come from the same rows even after a lost executor. Series
    columns must be filled, as ``validate_bars`` ensures.
    """
    check_period("Tick", value)
    numbered, _ = placed(bars, series)
    bar = F.col("_place") - F.pmod("_place", F.lit(value).cast("bigint"))
    out = (numbered.withColumn("_bar", bar).groupBy(*series, "_bar")
           .agg(F.min("timestamp").alias("_start"), *ohlcv(F.col("_place"))))
    return _shape(out, F.col("_start"), series)


def placed(bars: DataFrame, series: list[str] = SERIES, keep: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """Rows with ``_place``, their number in the series by (timestamp, seq) from 0, and the folder of the written ranges."""
    seq = ["seq"] if "seq" in bars.columns else []
    rows = bars.select(*series, "timestamp", *seq, *OHLC, "volume", *keep)
    # The hash leads so that sorts compare one integer before any text.
    order = ["_hash", *series, "timestamp", *seq]
    row_bits = 33
    path = workspace(bars.sparkSession, "tick-ranges")
    ranged = (rows.withColumn("_hash", F.xxhash64(*series))
              .repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash")
              .withColumn("_id", F.monotonically_increasing_id()))
    ranged.write.parquet(path)
    numbered = bars.sparkSession.read.schema(ranged.schema).parquet(path).withColumn("_range", F.shiftright("_id", row_bits))

    before = Window.partitionBy(*series).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per series and range: at most (series + ranges) rows in all, and
    # at most one row per range for any one series. Written, so that measuring
    # it and joining it don't read the ticks again.
    offsets = written(numbered.groupBy(*series, "_range")
                      .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
                      .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
                      .select(*series, "_range", (F.col("_before") - F.col("_first")).alias("_shift")), "tick-offsets")
    return (join_dim(numbered, offsets, [*series, "_range"])
            .withColumn("_place", F.col("_id") + F.col("_shift")).drop("_id", "_range", "_shift")), path


def _shape(out: DataFrame, start: Column, series: list[str]) -> DataFrame:
    extra = ["_bar"] if "_bar" in out.columns else []
    named = out.withColumn("timestamp", start)
    cols = [*series, epoch_ms(F.col("timestamp")).alias("unix_ms"), "timestamp", *OHLC, "volume", "n"]
    return named.select(*cols, *[F.col(c).alias("first_tick") for c in extra])
