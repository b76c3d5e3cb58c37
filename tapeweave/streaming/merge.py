"""Streamed bars into the keyed store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tapeweave.sources.store import BarStore


def merge_stream(bars: DataFrame, store: BarStore, timeframe: str, checkpoint: str,
                 name: str, catalog: DataFrame | None = None) -> DataStreamWriter:
    """Merge every micro-batch of bars; arrival order does not matter but for ties.

    No watermark: a late bar of higher volume still replaces. ``name`` and the
    micro-batch number are the commit key, so a repeated micro-batch is
    merged once; rows the store may not hold end in ``store.rejects``. A stream
    with a new checkpoint needs a new ``name``. Streamed commits claim no date coverage. Micro-batches
    add up to many store batches: call ``store.compact`` now and then.
    """
    def merge(batch: DataFrame, epoch: int) -> None:
        store.merge(batch, timeframe, catalog, commit_key=f"{name}-{epoch}")

    return bars.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
