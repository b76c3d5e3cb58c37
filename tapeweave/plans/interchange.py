"""The interchange request: bars of one contract as files plus their manifest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.operators.bars import select_streams
from tapeweave.operators.ranges import filter_range
from tapeweave.sources.sinks import export_interchange, export_manifest, to_interchange


def export_contract(bars: DataFrame, contract: str, start: datetime | str, end: datetime | str, out: str,
                    streams: str | None = "all", fmt: str = "parquet", compression: str | None = None,
                    sequence: str | None = None) -> DataFrame:
    """Write the contract's bars and return the manifest; status ``no_data`` when there are none.

    ``bars`` are normalised bars per contract; ``sequence`` names their arrival
    order, which settles a repeated (price_type, ts_event) in Parquet and is
    needed for it. The manifest counts rows before that, and what is left of them.
    """
    picked = filter_range(select_streams(bars.filter(F.col("contract") == contract), streams), start, end)
    rows = to_interchange(picked, keep=(sequence,) if sequence else ())
    return export_manifest(bars.sparkSession, out, export_interchange(rows, out, fmt, sequence, compression), fmt)
