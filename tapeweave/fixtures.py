"""The bundled test tables read as ticks, day bars, instruments and a ledger."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.operators.bars import normalize, ticks_as_bars
from tapeweave.session import pin_utc

# Fixed values of the fixture: contract suffix -> expiry.
EXPIRIES = {0: "2023-12-05", 1: "2024-02-20", 2: "2024-04-25", 3: "2024-07-20", 9: "2024-03-15"}
_STREAM = "CASE {0} % 3 WHEN 0 THEN 'last' WHEN 1 THEN 'bid' ELSE 'ask' END"


def tick_columns(events: DataFrame) -> DataFrame:
    """Events as source ticks with local time and a sequence number."""
    return events.select(
        F.upper("event_type").alias("symbol"),
        F.concat(F.upper("event_type"), F.lit(" C"), (F.col("user_id") % 4).cast("string")).alias("contract"),
        F.expr(_STREAM.format("event_id")).alias("price_type"),
        F.col("ts").alias("time"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("event_id").alias("seq"))


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_as_bars(tick_columns(pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(raw_ticks(spark, sf_dir), keep=("seq",))


def day_columns(lineitem: DataFrame) -> DataFrame:
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    rank = (F.col("l_suppkey") % 8).cast("int")
    return lineitem.select(
        F.col("l_returnflag").alias("symbol"),
        F.concat(F.col("l_returnflag"), F.lit(" C"), rank.cast("string")).alias("contract"),
        F.expr(_STREAM.format("l_linenumber")).alias("price_type"),
        F.col("l_shipdate").alias("time"), price.alias("open"), (price + qty).alias("high"),
        (price - qty).alias("low"), price.alias("close"), qty.alias("volume"),
        F.add_months(F.lit("1995-03-01").cast("date"), rank * 3).alias("expiry"),
        (F.col("l_orderkey") % 3).alias("part"), F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_no"))


def day_bars(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("expiry",)) -> DataFrame:
    return normalize(day_columns(pin_utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")), keep=keep)


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five futures per symbol (k = 9 has no bars) and one stock row each."""
    rows = F.array(*[F.struct(F.lit(f" C{k}").alias("suffix"), F.lit("Future").alias("instrument_type"),
                              F.lit(day).cast("date").alias("expiry")) for k, day in EXPIRIES.items()],
                   F.struct(F.lit(" SPOT").alias("suffix"), F.lit("Stock").alias("instrument_type"),
                            F.lit("2024-03-15").cast("date").alias("expiry")))
    symbols = (pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
               .select(F.upper("event_type").alias("symbol")).distinct())
    return (symbols.select("symbol", F.inline(rows))
            .select("symbol", F.concat("symbol", "suffix").alias("contract"), "instrument_type", "expiry",
                    F.lit("SIM").alias("exchange")))


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that grows with the data: a future per supplier and month of shipping, and a stock per supplier.

    A contract expires on the last day something was shipped in its month.
    """
    symbol, month = F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), F.date_format("l_shipdate", "yyyy-MM")
    lines = pin_utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    futures = (lines.groupBy(symbol.alias("symbol"), month.alias("month")).agg(F.max("l_shipdate").cast("date").alias("expiry"))
               .select("symbol", F.concat_ws(" ", "symbol", "month").alias("contract"), F.lit("Future").alias("instrument_type"), "expiry"))
    stocks = lines.groupBy(symbol.alias("symbol")).agg(F.max("l_shipdate").cast("date").alias("expiry")).select(
        "symbol", F.concat("symbol", F.lit(" SPOT")).alias("contract"), F.lit("Stock").alias("instrument_type"), "expiry")
    return futures.unionByName(stocks).withColumn("exchange", F.lit("SIM"))


# Fixed values of the fixture: each symbol's exchange clock, opening time and days before the trading day; and holidays of all.
CALENDARS = [("A", "America/Chicago", "17:00:00", 1), ("N", "Europe/Berlin", "01:10:00", 0), ("R", "America/New_York", "09:30:00", 0)]
HOLIDAYS = [(1, 1), (7, 4), (12, 25)]


def spread_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticks spread over the day, one contract per symbol."""
    lines = pin_utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    second = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 61) % 86_400
    at = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + second * 1_000_000)
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    return lines.select(
        F.col("l_returnflag").alias("symbol"), F.concat(F.col("l_returnflag"), F.lit(" C0")).alias("contract"),
        F.expr(_STREAM.format("l_linenumber")).alias("price_type"), at.alias("timestamp"), F.unix_millis(at).alias("unix_ms"),
        price.alias("open"), (price + qty).alias("high"), (price - qty).alias("low"), price.alias("close"),
        qty.cast("bigint").alias("volume"), ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 10_000_000 + F.col("l_partkey")).cast("bigint").alias("seq"))


def calendars(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calendars, holidays of 1990 to 2003, and the calendar of each symbol."""
    rows = spark.createDataFrame([(f"cal {s}", *rest) for s, *rest in CALENDARS], "calendar string, zone string, opens string, opens_before int")
    days = spark.createDataFrame([(None, date(y, m, d)) for y in range(1990, 2004) for m, d in HOLIDAYS], "calendar string, day date")
    return rows, days, spark.createDataFrame([(s, f"cal {s}") for s, *_ in CALENDARS], "symbol string, calendar string")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks per contract: covered, two adjoining halves, too narrow, covered with nothing, none.

    Every mark is written twice with different times, so the later one must win.
    """
    spans = [(0, "2024-01-01", "2024-01-31"), (1, "2024-01-01", "2024-01-14"), (1, "2024-01-15", "2024-01-31"),
             (2, "2024-01-10", "2024-01-20"), (9, "2024-01-01", "2024-01-31")]
    marks = F.array(*[F.struct(F.lit(f" C{k}").alias("suffix"), F.lit(a).cast("date").alias("from_date"),
                               F.lit(b).cast("date").alias("to_date")) for k, a, b in spans])
    bars = ticks(spark, sf_dir)
    frame = (bars.select("symbol").distinct().select("symbol", F.inline(marks))
             .select("symbol", F.concat("symbol", "suffix").alias("contract"), "from_date", "to_date"))
    daily = (bars.groupBy("symbol", "contract", F.to_date("timestamp").alias("day"))
             .agg(F.count(F.lit(1)).alias("n")))
    counted = (frame.join(daily, ["symbol", "contract"], "left")
               .groupBy("symbol", "contract", "from_date", "to_date")
               .agg(F.sum(F.when(F.col("day").between(F.col("from_date"), F.col("to_date")), F.col("n"))
                          .otherwise(0)).alias("bars_count")))
    twice = F.array(*[F.struct(F.lit(t).cast("timestamp").alias("completed_at"), F.lit(extra).alias("extra"))
                      for t, extra in (("2024-02-01 00:00:00", 1000), ("2024-02-02 00:00:00", 0))])
    return (counted.select("*", F.inline(twice))
            .select("symbol", "contract", F.lit("ticks").alias("table_name"), "from_date", "to_date",
                    (F.col("bars_count") + F.col("extra")).cast("bigint").alias("bars_count"), "completed_at"))
