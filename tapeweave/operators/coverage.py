"""Chunk coverage, the empty-chunk stop rule, and the look-back probe."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeweave.functions.time import MICROS_PER_MS, UNIT_MICROS, bucket_start, instant, iso, micros_of, naive_utc
from tapeweave.operators.ranges import chunk_index, filter_range, with_chunks
from tapeweave.schema import SERIES

# Look-back rungs of the availability probe (label, days).
LOOKBACKS = (("1d", 1), ("1wk", 7), ("1mo", 30), ("3mo", 90), ("6mo", 180),
             ("1yr", 365), ("2yr", 365 * 2), ("5yr", 365 * 5), ("10yr", 365 * 10))
# Granularity -> (period type, store table, window, deepest rung in days).
GRANULARITIES = {
    "Day1": ("Day", "days", timedelta(days=1), None),
    "Minute1": ("Minute", "minutes", timedelta(days=1), None),
    "Tick1": ("Tick", "ticks", timedelta(hours=4), 365 * 2),
}


def chunk_coverage(bars: DataFrame, series: DataFrame, start: datetime | str, end: datetime | str,
                   days: int) -> DataFrame:
    """Bars, first and last instant of every chunk of every series, empty chunks included.

    A bar's chunk follows from its time by arithmetic, so the bars are
    aggregated first and meet the chunk list by equality.
    """
    counted = (filter_range(bars, start, end)
               .withColumn("chunk_idx", chunk_index(F.col("timestamp"), start, end, days))
               .groupBy(*SERIES, "chunk_idx")
               .agg(F.count(F.lit(1)).alias("bars"), F.min("timestamp").alias("first_ts"),
                    F.max("timestamp").alias("last_ts")))
    return (with_chunks(series.select(*SERIES), start, end, days)
            .join(counted, [*SERIES, "chunk_idx"], "left")
            .withColumn("bars", F.coalesce("bars", F.lit(0).cast("bigint"))))


def with_stop(coverage: DataFrame, max_empty: int = 3) -> DataFrame:
    """Walk the chunks in time order and mark those attempted before the stop.

    ``empty_run`` counts consecutive empty chunks; the walk stops at the first
    chunk where it reaches ``max_empty``. A series has as many rows here as
    the request has chunks, which does not grow with the data.
    """
    limit = max(1, max_empty)
    walk = Window.partitionBy(*SERIES).orderBy("chunk_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = Window.partitionBy(*SERIES, "_island").orderBy("chunk_idx").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    empty = (F.col("bars") == 0).cast("bigint")
    return (coverage.withColumn("_island", F.sum(1 - empty).over(walk))
            .withColumn("empty_run", F.sum(empty).over(island))
            .withColumn("_stop", F.min(F.when(F.col("empty_run") >= limit, F.col("chunk_idx")))
                        .over(Window.partitionBy(*SERIES)))
            .withColumn("attempted", F.col("_stop").isNull() | (F.col("chunk_idx") <= F.col("_stop")))
            .withColumn("_stopped", F.col("_stop").isNotNull())
            .drop("_island", "_stop"))


def backfill_plan(coverage: DataFrame, max_empty: int = 3) -> DataFrame:
    """One row per series: where the walk ended, what it found, and why it ended."""
    tried = F.col("attempted")
    return (with_stop(coverage, max_empty).groupBy(*SERIES)
            .agg(F.when(F.bool_or("_stopped"), "stopped_no_data").otherwise("complete").alias("status"),
                 F.count(F.lit(1)).alias("chunks_total"),
                 F.count_if(tried).alias("chunks_done"),
                 F.sum(F.when(tried, F.col("bars")).otherwise(0)).alias("bars_downloaded"),
                 F.min(F.when(tried, F.col("first_ts"))).alias("first_data_at"),
                 F.max(F.when(tried, F.col("last_ts"))).alias("last_data_at"),
                 F.max_by("empty_run", F.when(tried, F.col("chunk_idx"))).alias("consecutive_empty")))


def _ladder(now: datetime, name: str) -> list[tuple[str, datetime, datetime]]:
    _, _, width, deepest = GRANULARITIES[name]
    return [(label, now - timedelta(days=ago) - width, now - timedelta(days=ago))
            for label, ago in LOOKBACKS if deepest is None or ago <= deepest]


def _granularities(period_types: list[str] | None) -> list[str]:
    if period_types is None:
        return list(GRANULARITIES)
    asked = {p.lower() for p in period_types}
    names = [g for g, (period, *_) in GRANULARITIES.items() if g.lower() in asked or period.lower() in asked]
    if not names:
        raise ValueError(f"period types must name Day, Minute or Tick, got {period_types}")
    return names


def _rung_of(rungs: list[tuple[str, datetime, datetime]], at: Column | None = None) -> Column:
    """The rung whose window holds the bar. Windows of one granularity never overlap."""
    at = F.col("timestamp") if at is None else at
    rung = F.lit(None).cast("string")
    for label, start, end in rungs:
        rung = F.when(at.between(instant(start), instant(end)), label).otherwise(rung)
    return rung


def _in_rungs(rungs: list[tuple[str, datetime, datetime]]) -> Column:
    """The same windows on the key, as a disjunction of ranges the file scan can use."""
    cond = F.lit(False)
    for _, start, end in rungs:
        cond = cond | F.col("unix_ms").between(micros_of(start) // MICROS_PER_MS, micros_of(end) // MICROS_PER_MS)
    return cond


def probe_results(tables: dict[str, DataFrame], contracts: DataFrame, now: datetime | str,
                  stream: str = "last", period_types: list[str] | None = None) -> DataFrame:
    """Bars per contract, granularity and look-back window ending ``ago`` before ``now``.

    ``tables`` maps ticks/minutes/days to their bars. A bar's window follows
    from its time, so there is no range join; empty windows come from the
    contract list.
    """
    now = naive_utc(now)
    probes = []
    for name in _granularities(period_types):
        period, table, _, _ = GRANULARITIES[name]
        rungs = _ladder(now, name)
        listed = F.array(*[F.struct(F.lit(i).cast("bigint").alias("rung"), F.lit(label).alias("lookback"),
                                    instant(start).alias("probe_start"))
                           for i, (label, start, _) in enumerate(rungs)])
        frame = (contracts.select("symbol", "contract", F.inline(listed)))
        if table in tables:
            counted = (tables[table].filter(F.col("price_type") == stream).filter(_in_rungs(rungs))
                       .withColumn("lookback", _rung_of(rungs)).filter(F.col("lookback").isNotNull())
                       .groupBy("symbol", "contract", "lookback")
                       .agg(F.count(F.lit(1)).alias("bars"), F.min("timestamp").alias("first_bar"),
                            F.max("timestamp").alias("last_bar")))
            frame = frame.join(counted, ["symbol", "contract", "lookback"], "left")
        else:
            frame = frame.select("*", F.lit(None).cast("bigint").alias("bars"),
                                 F.lit(None).cast("timestamp").alias("first_bar"),
                                 F.lit(None).cast("timestamp").alias("last_bar"))
        probes.append(frame.select(
            "symbol", "contract", F.lit(name).alias("granularity"), F.lit(period).alias("period_type"),
            "rung", "lookback", "probe_start", F.coalesce("bars", F.lit(0).cast("bigint")).alias("bars"),
            "first_bar", "last_bar"))
    out = probes[0]
    for probe in probes[1:]:
        out = out.unionByName(probe)
    return out


def probe_ticks(ticks: DataFrame, contracts: DataFrame, now: datetime | str, stream: str = "last",
                period_types: list[str] | None = None) -> DataFrame:
    """``probe_results`` of ticks and the minute and day bars they make, in one scan of the ticks.

    A bar is there when its bucket has a tick, so each tick in reach of a window
    stands for its tick, its minute and its day; bars are the distinct buckets.
    """
    now = naive_utc(now)
    widths = {"Tick": 0, "Minute": UNIT_MICROS["Minute"], "Day": UNIT_MICROS["Day"]}
    names = _granularities(period_types)
    reach, seen = F.lit(False), []
    for name in names:
        rungs = _ladder(now, name)
        width = widths[GRANULARITIES[name][0]]
        at = F.timestamp_micros(bucket_start(F.unix_micros("timestamp"), width)) if width else F.col("timestamp")
        # a bucket that begins in a window ends a width behind it at most
        reach = reach | _in_rungs([(label, start, end + timedelta(microseconds=width)) for label, start, end in rungs])
        seen.append(F.struct(F.lit(name).alias("granularity"), _rung_of(rungs, at).alias("lookback"), at.alias("at")))
    rows = (ticks.filter(F.col("price_type") == stream).filter(reach)
            .select("symbol", "contract", F.inline(F.filter(F.array(*seen), lambda x: x["lookback"].isNotNull()))))
    ends = [F.min("at").alias("first_bar"), F.max("at").alias("last_bar")]
    buckets = (rows.filter(F.col("granularity") != "Tick1").groupBy("symbol", "contract", "granularity", "lookback", "at").count()
               .groupBy("symbol", "contract", "granularity", "lookback").agg(F.count(F.lit(1)).alias("bars"), *ends))
    single = (rows.filter(F.col("granularity") == "Tick1").groupBy("symbol", "contract", "granularity", "lookback")
              .agg(F.count(F.lit(1)).alias("bars"), *ends))
    counted = buckets.unionByName(single)
    listed = F.array(*[F.struct(F.lit(name).alias("granularity"), F.lit(GRANULARITIES[name][0]).alias("period_type"),
                                F.lit(i).cast("bigint").alias("rung"), F.lit(label).alias("lookback"), instant(start).alias("probe_start"))
                       for name in names for i, (label, start, _) in enumerate(_ladder(now, name))])
    return (contracts.select("symbol", "contract", F.inline(listed))
            .join(counted, ["symbol", "contract", "granularity", "lookback"], "left")
            .select("symbol", "contract", "granularity", "period_type", "rung", "lookback", "probe_start",
                    F.coalesce("bars", F.lit(0).cast("bigint")).alias("bars"), "first_bar", "last_bar"))


def probe_availability(results: DataFrame) -> DataFrame:
    """Roll the probe up: how far back each granularity of a contract reaches."""
    return (results.groupBy("symbol", "contract", "granularity", "period_type")
            .agg(F.count(F.lit(1)).alias("probes_run"), F.sum("bars").alias("bars"),
                 F.count_if(F.col("bars") > 0).alias("probes_with_data"),
                 F.min("first_bar").alias("first"), F.max("last_bar").alias("last"))
            .withColumn("first_available_iso", iso(F.col("first")))
            .withColumn("last_available_iso", iso(F.col("last")))
            .drop("first", "last"))
