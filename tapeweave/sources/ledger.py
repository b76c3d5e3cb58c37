"""The progress ledger: what is covered, what is pending, what is live."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeweave.operators.stitch import top_one
from tapeweave.schema import LEDGER_KEY
from tapeweave.session import join_dim


def ledger_latest(ledger: DataFrame) -> DataFrame:
    """The current row per (symbol, contract, table, from, to): a later mark replaces an earlier one."""
    tie = [F.col("batch_id").desc()] if "batch_id" in ledger.columns else [F.col("bars_count").desc()]
    return top_one(ledger, LEDGER_KEY, [F.col("completed_at").desc(), *tie])


def contains(frm: date, to: date) -> Column:
    """One ledger row must hold the whole request; adjoining rows do not add up."""
    return ((F.col("from_date") <= F.lit(frm.isoformat()).cast("date"))
            & (F.col("to_date") >= F.lit(to.isoformat()).cast("date")))


def coverage(ledger: DataFrame, table_name: str, frm: date, to: date) -> DataFrame:
    """Per contract with a containing row: how many such rows, and their bars summed.

    A row of 0 bars covers as well: that contract was read and had nothing.
    """
    rows = ledger_latest(ledger.filter((F.col("table_name") == table_name) & contains(frm, to)))
    return (rows.groupBy("symbol", "contract")
            .agg(F.coalesce(F.sum("bars_count"), F.lit(0).cast("bigint")).alias("prior_bars"),
                 F.count(F.lit(1)).alias("ledger_rows")))


def covered_ends(ledger: DataFrame, table_name: str, frm: date) -> DataFrame:
    """Per contract the last day up to which one ledger row covers everything from ``frm`` on: ``covered_end``."""
    rows = ledger.filter((F.col("table_name") == table_name) & F.col("to_date").isNotNull()
                         & (F.col("from_date") <= F.lit(frm.isoformat()).cast("date")))
    return rows.groupBy("symbol", "contract").agg(F.max("to_date").alias("covered_end"))


def unfinished(contracts: DataFrame, ledger: DataFrame, table_name: str, frm: date) -> DataFrame:
    """What an open-ended request still has to load: contracts with ``covered_end`` (null: nothing is covered).

    A contract that expired by then is finished. The others need the days after it.
    """
    known = join_dim(contracts, covered_ends(ledger, table_name, frm), ["symbol", "contract"], "left")
    return known.filter(F.col("covered_end").isNull() | F.col("expiry").isNull()
                        | (F.col("expiry") > F.col("covered_end")))


def pending(contracts: DataFrame, ledger: DataFrame, table_name: str, frm: date, to: date) -> DataFrame:
    """Contracts no single ledger row covers for the request."""
    return join_dim(contracts, coverage(ledger, table_name, frm, to).select("symbol", "contract"),
                    ["symbol", "contract"], "left_anti")


def live_rows(ledger: DataFrame) -> DataFrame:
    """Rows of the highest generation per (symbol, table)."""
    top = ledger.groupBy("symbol", "table_name").agg(F.max("generation").alias("generation"))
    return ledger.join(top, ["symbol", "table_name", "generation"], "left_semi")


def live_batches(ledger: DataFrame) -> DataFrame:
    """Committed batches a reader may see, with their order.

    Taken from all live rows, not from the latest per key: a key marked again
    must not hide its earlier batch.
    """
    return (live_rows(ledger).select(F.col("table_name").alias("timeframe"), "symbol", "batch", "batch_id")
            .distinct())
