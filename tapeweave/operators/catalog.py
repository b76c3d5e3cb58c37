"""Instrument catalog: listing, expiry pruning, and the join to bars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeweave.schema import FUTURE
from tapeweave.session import join_dim


def for_root(root: str | None) -> Column:
    """Futures of one exact root symbol; None takes every root."""
    futures = F.col("instrument_type") == FUTURE
    return futures if root is None else (F.col("symbol") == root) & futures


def list_instruments(catalog: DataFrame, root: str | None = None) -> DataFrame:
    """Contracts of a root in expiry order."""
    return (catalog.filter(for_root(root))
            .select("symbol", F.col("contract").alias("full_name"),
                    F.date_format("expiry", "yyyy-MM-dd").alias("expiry_iso"), "exchange")
            .orderBy("symbol", "expiry_iso", "full_name"))


def overlap(catalog: DataFrame, start: date, end: date, back: int = 1, fwd: int = 3) -> DataFrame:
    """Mark contracts whose expiry lies in [start - back months, end + fwd months], both ends kept."""
    low = F.add_months(F.lit(start.isoformat()).cast("date"), -back)
    high = F.add_months(F.lit(end.isoformat()).cast("date"), fwd)
    return catalog.withColumn("kept", F.col("expiry").between(low, high))


def prune_contracts(catalog: DataFrame, start: date, end: date,
                    back: int = 1, fwd: int = 3) -> DataFrame:
    return overlap(catalog, start, end, back, fwd).filter("kept").drop("kept")


def prune_report(catalog: DataFrame, start: date, end: date,
                 back: int = 1, fwd: int = 3) -> DataFrame:
    """How many contracts of each root stay and go."""
    return (overlap(catalog, start, end, back, fwd).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("contracts_total"),
                 F.count_if("kept").alias("contracts_kept"),
                 F.count_if(~F.col("kept")).alias("contracts_dropped")))


def bars_of_contracts(bars: DataFrame, contracts: DataFrame) -> DataFrame:
    """Bars of the given contracts, in one pass over all of them.

    ``contracts`` has one row per (symbol, contract); every column it adds is kept.
    """
    return join_dim(bars, contracts, ["symbol", "contract"], "inner",
                    spread=["price_type", "unix_ms"] if "unix_ms" in bars.columns else ["price_type", "time"])
