"""The back-fill request: which chunks hold bars and where the walk stops."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.operators.coverage import backfill_plan, chunk_coverage
from tapeweave.operators.ranges import backfill_chunk_days
from tapeweave.schema import check_market_data_type


def backfill(bars: DataFrame, contracts: DataFrame, period_type: str, value: int, start: datetime | str,
             end: datetime | str, stream: str = "Last", max_empty: int = 3) -> DataFrame:
    """One row per contract: chunks done of all, bars, first and last data, status."""
    name = check_market_data_type(stream)
    series = contracts.select("symbol", "contract", F.lit(name).alias("price_type"))
    chunks = chunk_coverage(bars.filter(F.col("price_type") == name), series, start, end,
                            backfill_chunk_days(period_type, value))
    return backfill_plan(chunks, max_empty)
