"""Questions about stored or source bars: counts, ranges, inventory, audits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.functions.time import instant, iso, naive_utc
from tapeweave.operators.catalog import for_root
from tapeweave.operators.ranges import fetch_limit_days, filter_range
from tapeweave.schema import OHLC, TIMEFRAMES, check_market_data_type, check_period
from tapeweave.session import join_dim



def store_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Bars and time range per symbol, timeframe and stream; absent timeframes count 0."""
    frames = [df.select(F.lit(name).alias("timeframe"), "symbol", "price_type", "timestamp")
              for name, df in tables.items()]
    spark = frames[0].sparkSession
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    found = (rows.groupBy("timeframe", "symbol", "price_type")
             .agg(F.count(F.lit(1)).alias("bar_count"), F.min("timestamp").alias("min_date"),
                  F.max("timestamp").alias("max_date")))
    names = spark.createDataFrame([(t,) for t in TIMEFRAMES], "timeframe string")
    return (names.join(found, "timeframe", "left")
            .withColumn("bar_count", F.coalesce("bar_count", F.lit(0).cast("bigint")))
            .orderBy("timeframe", "symbol", "price_type"))


def stream_counts(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", "price_type").agg(F.count(F.lit(1)).alias("bar_count"))


def date_range(bars: DataFrame) -> DataFrame:
    """First and last instant per symbol over all streams."""
    return bars.groupBy("symbol").agg(F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))


def roll_audit(bars: DataFrame, symbol: str | None = None, start: datetime | str | None = None,
               end: datetime | str | None = None) -> DataFrame:
    """Which contract supplied how many bars, and when; contracts in time order."""
    rows = bars if symbol is None else bars.filter(F.col("symbol") == symbol)
    if start is not None and end is not None:
        rows = filter_range(rows, start, end)
    return (rows.groupBy("symbol", "contract")
            .agg(F.count(F.lit(1)).alias("bars"), F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))
            .orderBy("symbol", "min_ts", "contract"))


def inventory(bars: DataFrame, catalog: DataFrame, root: str | None = None, stream: str = "Last") -> DataFrame:
    """Every futures contract of the root with its bar count and first and last bar.

    Bars are counted per contract first; only those few rows meet the catalog.
    """
    name = check_market_data_type(stream)
    counted = (bars.filter(F.col("price_type") == name)
               .groupBy("symbol", "contract")
               .agg(F.count(F.lit(1)).alias("bar_count"), F.min("timestamp").alias("first"),
                    F.max("timestamp").alias("last")))
    return (catalog.filter(for_root(root)).join(counted, ["symbol", "contract"], "left")
            .select("symbol", F.col("contract").alias("full_name"),
                    F.date_format("expiry", "yyyy-MM-dd").alias("expiry_iso"),
                    F.coalesce("bar_count", F.lit(0).cast("bigint")).alias("bar_count"),
                    iso(F.col("first")).alias("first_bar_iso"), iso(F.col("last")).alias("last_bar_iso"))
            .orderBy("symbol", "expiry_iso", "full_name"))


def fetch_bars(bars: DataFrame, contract: str, period_type: str, value: int, start: datetime | str,
               end: datetime | str, stream: str = "Last", max_days: float | None = None) -> DataFrame:
    """Bars of one contract and stream with ``start <= time <= end``, in time order.

    Spans above the period's limit are refused: walk ``page_windows`` instead.
    ``max_days`` overrides the limit; results stay distributed either way.
    """
    check_period(period_type, value)
    name = check_market_data_type(stream)
    span = naive_utc(end) - naive_utc(start)
    if span.total_seconds() <= 0:
        raise ValueError("the end must be after the start")
    limit = fetch_limit_days(period_type, value) if max_days is None else max_days
    if span.total_seconds() > limit * 86_400:
        raise ValueError(f"{span.total_seconds() / 86_400:.1f} days asked for, the limit for "
                         f"{period_type} is {limit}: fetch page by page")
    rows = bars.filter((F.col("contract") == contract) & (F.col("price_type") == name))
    return (filter_range(rows, start, end)
            .select(iso(F.col("timestamp")).alias("timestamp_iso"), *OHLC, "volume")
            .orderBy("timestamp_iso"))


def range_diagnostics(bars: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Per contract and stream: bars scanned, kept and out of range.

    ``reported`` marks scans of which more than 10 % or more than 1000 bars fell outside.
    """
    inside = F.col("timestamp").between(instant(start), instant(end))
    filtered = F.col("total_bars") - F.col("kept_bars")
    return (bars.groupBy("symbol", "contract", "price_type")
            .agg(F.count(F.lit(1)).alias("total_bars"), F.count_if(inside).alias("kept_bars"),
                 F.min("timestamp").alias("raw_first"), F.max("timestamp").alias("raw_last"))
            .withColumn("filtered_bars", filtered)
            .withColumn("reported", (filtered > 0) & ((filtered * 100.0 / F.col("total_bars") > 10)
                                                      | (filtered > 1000))))


def run_summary(staged: DataFrame, final: DataFrame) -> DataFrame:
    """Per symbol and stream: rows staged, rows in the series, contracts, time range."""
    return with_final(staged.groupBy("symbol", "price_type").agg(F.count(F.lit(1)).alias("staged_rows")), final)


def with_final(before: DataFrame, final: DataFrame) -> DataFrame:
    """``run_summary`` of staged rows that are counted already."""
    after = (final.groupBy("symbol", "price_type")
             .agg(F.count(F.lit(1)).alias("final_rows"), F.count_distinct("contract").alias("contracts"),
                  F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")))
    return (before.join(after, ["symbol", "price_type"], "full")
            .fillna(0, ["staged_rows", "final_rows", "contracts"]))


def contract_steps(contracts: DataFrame, pending: DataFrame) -> DataFrame:
    """How many contracts of each root a run works on and how many it skips."""
    todo = pending.select("symbol", "contract", F.lit(True).alias("_todo"))
    marked = join_dim(contracts, todo, ["symbol", "contract"], "left")
    return (marked.groupBy("symbol")
            .agg(F.count_if(F.col("_todo").isNotNull()).alias("contracts_processed"),
                 F.count_if(F.col("_todo").isNull()).alias("contracts_skipped")))
