"""Row-level bar operators: normalise, validate, select streams, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeweave.functions.time import epoch_ms, to_utc
from tapeweave.operators.ranges import DateRange, in_request
from tapeweave.schema import BAR_COLUMNS, BARS, OHLC, resolve_streams
from tapeweave.session import require_utc


def normalize(raw: DataFrame, tz: str | Column = "UTC", keep: tuple[str, ...] = ()) -> DataFrame:
    """Source bars to store rows.

    Local time becomes the UTC instant, the key is its millisecond rounded
    down, a fractional volume loses its fraction. ``keep`` carries extra
    columns such as a sequence number.
    """
    require_utc(raw.sparkSession)
    utc = to_utc(F.col("time"), tz)
    return raw.select(
        "symbol", F.coalesce(F.col("contract"), F.lit("")).alias("contract"), "price_type",
        epoch_ms(utc).alias("unix_ms"), utc.alias("timestamp"),
        *OHLC, F.col("volume").cast("bigint").alias("volume"), *keep)


def ticks_as_bars(ticks: DataFrame) -> DataFrame:
    """A trade or quote is a bar whose four prices are equal."""
    rest = [c for c in ticks.columns if c != "price"]
    return ticks.select(*rest, *[F.col("price").alias(c) for c in OHLC])


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Add ``reject_reason``: why the store refuses a row, null for the rows that it accepts.

    All columns but ``contract`` must be filled, and a symbol may not be blank.
    """
    needed = [f.name for f in BARS.fields if f.name != "contract" and f.name in df.columns]
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    return df.withColumn("reject_reason", F.when(~filled, F.concat(F.lit("null: "), missing))
                         .when(F.trim("symbol") == "", "blank symbol"))


def validate_bars(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into rows the store accepts and rejected rows with the reason."""
    tagged = with_reject_reason(df)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


def select_streams(df: DataFrame, which: str | None = "all") -> DataFrame:
    return df.filter(F.col("price_type").isin(resolve_streams(which)))


def in_range(raw: DataFrame, request: DateRange, time: str = "time") -> DataFrame:
    """Source bars inside the request; compares source-local wall-clock times."""
    return raw.filter(in_request(F.col(time), request))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack exported or stored frames by column name; absent columns become NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bar_columns(df: DataFrame) -> DataFrame:
    return df.select(*BAR_COLUMNS)
