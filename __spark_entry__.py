"""

Every query reads the given tables whole. F1 below are ticks made of
``events``, F2 day bars made of ``lineitem``, F3 instruments and F4 ledger
marks derived from F1 (see FIXTURES.md).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave import fixtures as fx
from tapeweave.operators import bars as ob
from tapeweave.operators import catalog as oc
from tapeweave.operators import coverage as ov
from tapeweave.operators import inspect as oi
from tapeweave.operators import sessions as os_
from tapeweave.operators.resample import resample
from tapeweave.operators.ranges import page_windows, with_chunks
from tapeweave.operators.stitch import dedup, latest_wins, stitch
from tapeweave.plans.backfill import backfill
from tapeweave.plans.export import export_series, export_timeframes
from tapeweave.plans.interchange import export_contract
from tapeweave.plans.refresh import Derived
from tapeweave.schema import BARS_RAW, KEY, OHLC, SERIES
from tapeweave.session import pin_utc, workspace
from tapeweave.sources import ledger as led
from tapeweave.sources import sinks
from tapeweave.sources.bar_source import read_bar_folders, write_bar_folders
from tapeweave.sources.scan import scan_bars
from tapeweave.sources.store import BarStore
from tapeweave.streaming import audited
from tapeweave.streaming.files import drain, fold_upserts, read_stream, read_upserts, upsert_writer
from tapeweave.streaming.merge import merge_stream
from tapeweave.streaming.series import bar_stream, stitch_stream

FLAGSHIP_DIR = "/root/testdata/sf0.001"
# The request all range queries share, and the instant the probe looks back from.
FROM, TO = date(2024, 1, 5), date(2024, 1, 25)
START, END = datetime(2024, 1, 5), datetime(2024, 1, 25, 23, 59, 59, 999999)
WALK_START, WALK_END = datetime(2023, 12, 30), datetime(2024, 2, 10, 12)
NOW = datetime(2024, 2, 1)
LISTED = date(1995, 2, 10), date(1996, 3, 5)  # a request for the contracts listed from the line items
CLEARED = datetime(1995, 1, 1), datetime(1996, 12, 31, 23, 59, 59, 999000)
LATENESS = timedelta(days=20)
BAR = [*SERIES, "timestamp", "unix_ms", *OHLC, "volume"]


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side returns them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema.fields])


def _hours(spark: SparkSession, d: str) -> DataFrame:
    return resample(fx.ticks(spark, d), "Minute", 60)


def _series(spark: SparkSession, d: str) -> DataFrame:
    return stitch(fx.day_bars(spark, d))


def _feed(df: DataFrame, path: str, slices: list[Column]) -> int:
    """Append the rows of each slice to a folder, one slice after the other; files there now.

    A task writes what it reads, without a shuffle: with the table the files grow in number and not in size.
    """
    for mine in slices:
        df.filter(mine).write.mode("append").parquet(path)
    return len(df.sparkSession.read.schema(df.schema).parquet(path).inputFiles())


def _split(spark: SparkSession, df: DataFrame, name: str, parts: int = 3) -> tuple[str, int]:
    """The same rows as a folder that a stream reads in ``parts`` micro-batches, and the files of one."""
    path = workspace(spark, name)
    files = _feed(df, path, [F.pmod(F.xxhash64("unix_ms"), F.lit(parts)) == k for k in range(parts)])
    return path, -(-files // parts)


def normalize_ticks(spark, d):
    return fx.ticks(spark, d)


def normalize_new_york(spark, d):
    return ob.normalize(fx.raw_ticks(spark, d), "America/New_York", keep=("seq",))


def resample_by(unit: str, value: int, offset: float = 0):
    return lambda spark, d: resample(fx.ticks(spark, d), unit, value, offset)


def resample_bars_to_day(spark, d):
    minutes = resample(fx.ticks(spark, d), "Minute", 15)
    return resample(minutes, "Day", 1)


def dedup_contract(spark, d):
    return dedup(fx.day_bars(spark, d)).select(BAR)


def stitch_days(spark, d):
    return _series(spark, d).select(BAR)


def stitch_hours(spark, d):
    return stitch(_hours(spark, d), fx.instruments(spark, d)).select(BAR)


def merge_incremental(spark, d):
    store = BarStore(spark, workspace(spark, "store"))
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    for part in range(3):
        store.merge(rows.filter(F.col("part") == part), "days")
    return store.read("days")


def merge_compacted(spark, d):
    store = BarStore(spark, workspace(spark, "store"))
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    for part in range(3):
        store.merge(rows.filter(F.col("part") == part), "days")
    store.compact("days")
    return store.read("days")


def replace_symbol(spark, d):
    """All symbols in two batches, then symbol R again from the second batch alone."""
    store = BarStore(spark, workspace(spark, "store"))
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    store.merge(rows.filter("part < 2"), "days")
    store.merge(rows.filter("part = 2"), "days")
    store.replace(rows.filter("part = 2 AND symbol = 'R'"), "days")
    return store.read("days")


def latest_wins_rows(spark, d):
    arrival = ("order_no", "line_no", "part_no")
    rows = sinks.to_interchange(fx.day_bars(spark, d, keep=arrival), keep=arrival)
    return latest_wins(rows, [F.col(c) for c in (*arrival, "open", "volume")]).drop(*arrival)


def list_instruments(spark, d):
    return oc.list_instruments(fx.listed(spark, d))


def list_root(spark, d):
    return oc.list_instruments(fx.listed(spark, d), "S7")


def prune_contracts(spark, d):
    return oc.prune_contracts(fx.instruments(spark, d).filter(oc.for_root(None)), FROM, TO)


def prune_listed(spark, d):
    return oc.prune_contracts(fx.listed(spark, d).filter(oc.for_root(None)), *LISTED)


def prune_report(spark, d):
    return oc.prune_report(fx.listed(spark, d).filter(oc.for_root(None)), *LISTED)


def bars_of_contracts(spark, d):
    kept = prune_contracts(spark, d).select("symbol", "contract", "expiry")
    return oc.bars_of_contracts(fx.ticks(spark, d), kept)


def fetch_bars(spark, d):
    return oi.fetch_bars(_hours(spark, d), "CLICK C1", "Minute", 60, START, END, "Last")


def select_streams(spark, d):
    return ob.select_streams(fx.ticks(spark, d), " Bid ")


def range_diagnostics(spark, d):
    return oi.range_diagnostics(fx.ticks(spark, d), START, END)


def inventory(spark, d):
    return oi.inventory(_hours(spark, d), fx.instruments(spark, d))


def store_summary(spark, d):
    return oi.store_summary({"days": _series(spark, d), "minutes": stitch_hours(spark, d)})


def stream_counts(spark, d):
    return oi.stream_counts(_series(spark, d))


def date_range(spark, d):
    return oi.date_range(_series(spark, d))


def roll_audit(spark, d):
    return oi.roll_audit(stitch_hours(spark, d), None, START, END)


def run_summary(spark, d):
    return oi.run_summary(fx.day_bars(spark, d), _series(spark, d))


def covered_contracts(spark, d):
    return led.coverage(fx.ledger(spark, d), "ticks", FROM, TO)


def pending_contracts(spark, d):
    contracts = prune_contracts(spark, d).select("symbol", "contract")
    return led.pending(contracts, fx.ledger(spark, d), "ticks", FROM, TO)


def contract_steps(spark, d):
    return oi.contract_steps(prune_contracts(spark, d), pending_contracts(spark, d))


def ledger_latest(spark, d):
    return led.ledger_latest(fx.ledger(spark, d))


def _tick_series(spark, d):
    streams = F.explode(F.array(F.lit("last"), F.lit("bid"), F.lit("ask"))).alias("price_type")
    return fx.instruments(spark, d).filter(oc.for_root(None)).select("symbol", "contract", streams)


def chunk_ranges_of(spark, d):
    """Week chunks of each symbol, the last one clipped."""
    symbols = fx.listed(spark, d).select("symbol").distinct()
    return with_chunks(symbols, WALK_START, WALK_END, 7)


def chunk_coverage(spark, d):
    return ov.chunk_coverage(fx.ticks(spark, d), _tick_series(spark, d), WALK_START, WALK_END, 1)


def backfill_stop(spark, d):
    return ov.backfill_plan(chunk_coverage(spark, d), 3)


def backfill_request(spark, d):
    contracts = fx.instruments(spark, d).filter(oc.for_root(None))
    return backfill(_hours(spark, d), contracts, "Minute", 1, WALK_START, WALK_END, "Bid", 2)


def _probe_tables(spark, d):
    ticks = fx.ticks(spark, d)
    return {"ticks": ticks, "minutes": resample(ticks, "Minute", 1), "days": resample(ticks, "Day", 1)}


def probe_results(spark, d):
    contracts = fx.instruments(spark, d).filter(oc.for_root(None))
    return ov.probe_results(_probe_tables(spark, d), contracts, NOW)


def probe_availability(spark, d):
    contracts = fx.instruments(spark, d).filter(oc.for_root(None))
    return ov.probe_availability(ov.probe_ticks(fx.ticks(spark, d), contracts, NOW))


def export_csv_roundtrip(spark, d):
    out = workspace(spark, "csv")
    sinks.export_csv(_series(spark, d), out, "gzip")
    return sinks.read_csv_export(spark, out)


def export_parquet_roundtrip(spark, d):
    out = workspace(spark, "parquet")
    sinks.export_parquet(_series(spark, d), out)
    return sinks.read_parquet_export(spark, out)


def interchange_roundtrip(spark, d):
    """Keyed Parquet: one row per (contract, stream, instant), the bar of the latest order."""
    out = workspace(spark, "interchange")
    arrival = ("order_no", "line_no", "part_no")
    rows = sinks.to_interchange(fx.day_bars(spark, d, keep=arrival), keep=arrival)
    rows = rows.withColumn("arrival", F.struct(*arrival, "open", "volume"))
    sinks.export_interchange(rows, out, "parquet", sequence="arrival")
    return sinks.read_interchange(spark, out)


def interchange_csv_roundtrip(spark, d):
    out = workspace(spark, "interchange")
    sinks.export_interchange(sinks.to_interchange(fx.ticks(spark, d)), out, "csv", compression="gzip")
    return sinks.read_interchange(spark, out, "csv")


def export_manifest_counts(spark, d):
    out = workspace(spark, "manifest")
    series = _series(spark, d)
    counted = sinks.export_manifest(spark, out, sinks.export_parquet(series, out), "parquet")
    same = sinks.verify_manifest(spark, out, counted, "parquet")
    stored = sinks.read_parquet_export(spark, out).count()
    return counted.select("bar_count", *[F.col("bar_count_by_stream")[s].alias(f"{s}_count")
                                         for s in ("last", "bid", "ask")], "status",
                          (F.lit(same) & (F.col("file_rows") == stored)).alias("files_as_written"))


def interchange_request(spark, d):
    out = workspace(spark, "request")
    return (export_contract(fx.ticks(spark, d), "VIEW C2", START, END, out, sequence="seq")
            .select("bar_count", F.col("bar_count_by_stream")["last"].alias("last_count"), "status"))


def scan_roundtrip(spark, d):
    """Source bars as a CSV drop, scanned with the declared schema and validated."""
    out = workspace(spark, "drop")
    (fx.raw_ticks(spark, d).select(*BARS_RAW.fieldNames()).write.option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(out))
    good, _ = ob.validate_bars(ob.normalize(scan_bars(spark, out, "csv")))
    return good


def union_sources(spark, d):
    own = sinks.to_interchange(fx.ticks(spark, d)).filter("price_type = 'last'")
    other = sinks.to_interchange(_series(spark, d), source="other").drop("price_type")
    return ob.union_sources(own, other)


def export_run(spark, d):
    """Request, prune, skip, merge, mark, write: two runs, the second one finds all covered."""
    store = BarStore(spark, workspace(spark, "store"))
    catalog, raw, out = fx.instruments(spark, d), fx.raw_ticks(spark, d), workspace(spark, "out")
    export_series(store, catalog, raw, None, "ticks", NOW, FROM, TO)
    again = export_series(store, catalog, raw, None, "ticks", NOW, FROM, TO, formats=("parquet",), out=out)
    assert again.batch_id is None
    return sinks.read_parquet_export(spark, again.outputs["parquet"])


def stream_merge(spark, d):
    """Three micro-batches in a fixed order; keys and ties cross them, as in ``merge_incremental``."""
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    path = workspace(spark, "stream-in")
    store = BarStore(spark, workspace(spark, "store"))
    checkpoint = workspace(spark, "checkpoint")
    for part in range(3):
        rows.filter(F.col("part") == part).drop("part").write.mode("append").parquet(path)
        drain(merge_stream(read_stream(spark, path, rows.drop("part").schema), store, "days", checkpoint, "days"))
    return store.read("days")


def _faulty(spark, d):
    """Day bars of which some lack a volume or a symbol."""
    rows = fx.day_bars(spark, d, keep=("expiry", "line_no"))
    return (rows.withColumn("volume", F.when(F.col("line_no") != 6, F.col("volume")))
            .withColumn("symbol", F.when(F.col("line_no") == 7, "  ").when(F.col("line_no") != 5, F.col("symbol"))))


def validate_rejects(spark, d):
    """Refused rows of a merge, by reason."""
    store = BarStore(spark, workspace(spark, "store"))
    store.merge(_faulty(spark, d).drop("line_no"), "days")
    return store.rejects("days").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("bars"))


def validate_kept(spark, d):
    """What the same merge keeps."""
    store = BarStore(spark, workspace(spark, "store"))
    store.merge(_faulty(spark, d).drop("line_no"), "days")
    return store.read("days")


def merge_vacuumed(spark, d):
    """As ``merge_compacted``, with the ledger rewritten and unreachable batches deleted."""
    store = BarStore(spark, workspace(spark, "store"))
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    for part in range(3):
        store.merge(rows.filter(F.col("part") == part), "days")
    store.compact("days")
    store.compact_ledger()
    store.vacuum()
    return store.read("days")


def export_run_open_ended(spark, d):
    """Two open-ended runs; the second loads the days after the first one's."""
    store = BarStore(spark, workspace(spark, "store"))
    catalog, raw = fx.instruments(spark, d), fx.raw_ticks(spark, d)
    export_series(store, catalog, raw, None, "ticks", datetime(2024, 1, 15), FROM)
    return export_series(store, catalog, raw, None, "ticks", NOW, FROM).series


def stream_stitch(spark, d):
    """Two streams over one sink: the second has a new checkpoint and sees all rows again."""
    src = fx.day_bars(spark, d)
    path, out = workspace(spark, "stream-in"), workspace(spark, "stream-out")
    parts = [F.pmod(F.xxhash64("open"), F.lit(3)) == k for k in range(3)]
    for fed, mine in ((2, parts[1:]), (3, parts[:1])):
        files = _feed(src, path, mine)
        live = stitch_stream(read_stream(spark, path, src.schema, -(-files // fed)))  # a part in each micro-batch
        drain(upsert_writer(live, out, workspace(spark, "checkpoint")), spark.sparkContext.defaultParallelism)
    fold_upserts(spark, out, live.schema, KEY)
    return read_upserts(spark, out, live.schema, KEY).select(BAR)


def stream_bars(spark, d):
    ticks = fx.ticks(spark, d)
    path, files = _split(spark, ticks, "stream-in")
    live = bar_stream(read_stream(spark, path, ticks.schema, files), "Minute", 60, "40 days")
    out = workspace(spark, "stream-out")
    drain(upsert_writer(live, out, workspace(spark, "checkpoint")), spark.sparkContext.defaultParallelism)
    return read_upserts(spark, out, live.schema, [*SERIES, "unix_ms"])


def merge_disjoint(spark, d):
    """Two merges whose key ranges don't meet: read without ranking."""
    store = BarStore(spark, workspace(spark, "store"))
    rows = fx.day_bars(spark, d)
    store.merge(rows.filter(F.col("timestamp") < F.lit(CLEARED[0])), "days")
    store.merge(rows.filter(F.col("timestamp") >= F.lit(CLEARED[0])), "days")
    return store.read("days")


def merge_tiered(spark, d):
    """Six merges; runs of about one size are made one as they come."""
    store = BarStore(spark, workspace(spark, "store"), fan=2)
    rows = fx.day_bars(spark, d, keep=("expiry", "order_no"))
    for part in range(6):
        store.merge(rows.filter(F.col("order_no") % 6 == part).drop("order_no"), "days")
    return store.read("days")


def merge_concurrent(spark, d):
    """A writer per stream, all at once."""
    path = workspace(spark, "store")
    rows = fx.day_bars(spark, d)
    with ThreadPoolExecutor(3) as pool:
        numbers = list(pool.map(lambda s: BarStore(spark, path).merge(rows.filter(F.col("price_type") == s), "days"),
                                ("last", "bid", "ask")))
    assert sorted(numbers) == [1, 2, 3]
    return BarStore(spark, path).read("days")


def replace_range(spark, d):
    """All parts in two merges, then two years again from the second part alone."""
    store = BarStore(spark, workspace(spark, "store"))
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    store.merge(rows.filter("part < 2"), "days")
    store.merge(rows.filter("part = 2"), "days")
    inside = F.col("timestamp").between(F.lit(CLEARED[0]), F.lit(CLEARED[1]))
    store.replace_range(rows.filter(F.col("part") == 2).filter(inside), "days", *CLEARED)
    return store.read("days")


def store_migrated(spark, d):
    """Files of an older store, without the contract column, taken over and merged into."""
    store = BarStore(spark, workspace(spark, "store"))
    (_series(spark, d).select("symbol", "price_type", "unix_ms", "timestamp", *OHLC, "volume")
     .write.partitionBy("symbol").parquet(f"{store.path}/bars/timeframe=days/batch=older"))
    store.adopt("days", "older")
    return store.read("days")


def refresh_weeks(spark, d):
    """Seven-day bars after three merges, each of which remakes the weeks it touched."""
    store = BarStore(spark, workspace(spark, "store"))
    weeks = Derived(store, "days", workspace(spark, "weeks"), "Day", 7)
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    for part in range(3):
        store.merge(rows.filter(F.col("part") == part), "days")
        weeks.refresh()
    return weeks.read()


def session_days(spark, d):
    """One bar per trading session; the sessions open on three exchanges' clocks, through daylight saving."""
    hours, days, of_symbol = fx.calendars(spark)
    listed = os_.sessions(hours, days, date(1991, 12, 1), date(2002, 1, 31))
    return os_.session_bars(fx.spread_ticks(spark, d), listed, of_symbol)


def fetch_pages(spark, d):
    """The days of ``fetch_bars`` page by page, under a limit of a week."""
    hours = _hours(spark, d)
    pages = page_windows(START, END, 7)
    last = len(pages) - 1
    found = [oi.fetch_bars(hours, "CLICK C1", "Minute", 1, a, b if i == last else b - timedelta(microseconds=1), "Last", 7)
             for i, (a, b) in enumerate(pages)]
    return ob.union_sources(*found)


def stitch_all_ticks(spark, d):
    return stitch(fx.ticks(spark, d), fx.instruments(spark, d), keep_all_ticks=True).select(*BAR, "seq")


def export_single(spark, d):
    """One ordered gzip file per symbol and stream, read back."""
    out = workspace(spark, "single")
    files = sinks.export_single_csv(_series(spark, d), out)
    rows = spark.read.option("header", True).schema(
        "unix_ms long, open double, high double, low double, close double, volume long, contract string").csv(
            [r["path"] for r in files.select("path").collect()])
    return rows.withColumn("name", F.regexp_extract(F.col("_metadata.file_path"), "root=([^/]*/[^/.]*)", 1))


def export_present_streams(spark, d):
    """Streams without rows get no folder: what is there after an export of some streams."""
    out = workspace(spark, "csv")
    sinks.export_csv(_series(spark, d).filter("NOT (symbol = 'A' AND price_type = 'ask')"), out)
    return sinks.export_files(spark, out, "csv").select(
        F.regexp_extract("path", "root=([^/]*)/", 1).alias("symbol"), F.regexp_extract("path", "stream=([^/]*)/", 1).alias("price_type")).distinct()


def export_all_timeframes(spark, d):
    """Ticks and days of one request, each into its own timeframe."""
    store = BarStore(spark, workspace(spark, "store"))
    raw = fx.raw_ticks(spark, d)
    done, failed = export_timeframes(store, fx.instruments(spark, d), {"ticks": raw, "days": raw.drop("seq")}, None, NOW, frm=FROM, to=TO)
    assert not failed
    return ob.union_sources(*[run.series.withColumn("timeframe", F.lit(name)) for name, run in done.items()])


def scan_folders(spark, d):
    """Source bars in folders by contract and day, read through the data source with pushed filters."""
    out = workspace(spark, "folders")
    write_bar_folders(fx.raw_ticks(spark, d), out)
    rows = read_bar_folders(spark, out, 7)
    picked = rows.filter((F.col("contract") == "CLICK C1") & (F.col("time") >= F.lit(START).cast("timestamp_ntz"))
                         & (F.col("time") <= F.lit(END).cast("timestamp_ntz")))
    return ob.normalize(picked)


def _tick_parts(spark, d, sink, checkpoint):
    """Three micro-batches: ticks by thirds of their number, or by time."""
    ticks, path = fx.ticks(spark, d), workspace(spark, "stream-in")
    for mine in sink[1]:
        ticks.filter(mine).write.mode("append").parquet(path)
        drain(sink[0](read_stream(spark, path, ticks.schema), checkpoint))
    return ticks.schema


def _audited_hours(spark, d):
    out, checkpoint = workspace(spark, "stream-out"), workspace(spark, "checkpoint")
    thirds = [F.col("seq") % 3 == k for k in range(3)]
    schema = _tick_parts(spark, d, (lambda live, cp: audited.bar_sink(live, out, cp, "Minute", 60, LATENESS), thirds), checkpoint)
    return out, schema


def stream_audited(spark, d):
    """Hour bars of the ticks that came in time; each micro-batch but the first has late ones."""
    out, schema = _audited_hours(spark, d)
    audited.fold_bars(spark, out, schema)
    return audited.read_bars(spark, out, schema)


def stream_late(spark, d):
    """What the same stream counted: rows in, used and late per micro-batch, and the late rows themselves."""
    out, schema = _audited_hours(spark, d)
    table = audited.EpochTable(spark, out)
    late = table.late(schema).groupBy("epoch").agg(F.count(F.lit(1)).alias("rows_kept_aside"))
    counts = table.audit().drop("watermark").join(late, "epoch", "left")
    return counts.select(F.col("epoch").cast("long").alias("epoch"), "rows_in", "rows_used", "rows_late",
                         F.coalesce("rows_kept_aside", F.lit(0).cast("long")).alias("rows_kept_aside"))


def stream_100tick(spark, d):
    """Bars of 100 ticks over three micro-batches in time order."""
    out, checkpoint = workspace(spark, "stream-out"), workspace(spark, "checkpoint")
    cuts = [F.col("timestamp") < F.lit(datetime(2024, 1, 10)), F.col("timestamp").between(F.lit(datetime(2024, 1, 10)), F.lit(datetime(2024, 1, 19, 23, 59, 59, 999999))),
            F.col("timestamp") >= F.lit(datetime(2024, 1, 20))]
    schema = _tick_parts(spark, d, (lambda live, cp: audited.tick_bar_sink(live, out, cp, 100), cuts), checkpoint)
    return audited.read_tick_bars(spark, out, schema)


def stream_stitch_late(spark, d):
    """The continuous series of a stream whose bars may be 20 days late; three micro-batches."""
    rows = fx.day_bars(spark, d, keep=("expiry", "part"))
    path, out, checkpoint = workspace(spark, "stream-in"), workspace(spark, "stream-out"), workspace(spark, "checkpoint")
    schema = rows.drop("part").schema
    for part in range(3):
        rows.filter(F.col("part") == part).drop("part").write.mode("append").parquet(path)
        drain(audited.stitch_sink(read_stream(spark, path, schema), out, checkpoint, timedelta(days=365 * 4)))
    return audited.read_stitched(spark, out, schema).select(BAR)


_QUERIES = {
    "normalize_ticks": normalize_ticks,
    "normalize_new_york": normalize_new_york,
    "scan_roundtrip": scan_roundtrip,
    "resample_hour": resample_by("Minute", 60),
    "resample_15m": resample_by("Minute", 15),
    "resample_30s": resample_by("Second", 30),
    "resample_day": resample_by("Day", 1),
    "resample_session_day": resample_by("Day", 1, 22),
    "resample_100tick": resample_by("Tick", 100),
    "resample_7tick": resample_by("Tick", 7),
    "resample_bars_to_day": resample_bars_to_day,
    "dedup_contract": dedup_contract,
    "stitch_days": stitch_days,
    "stitch_hours": stitch_hours,
    "merge_incremental": merge_incremental,
    "merge_compacted": merge_compacted,
    "replace_symbol": replace_symbol,
    "latest_wins": latest_wins_rows,
    "list_instruments": list_instruments,
    "prune_contracts": prune_contracts,
    "prune_report": prune_report,
    "bars_of_contracts": bars_of_contracts,
    "fetch_bars": fetch_bars,
    "select_streams": select_streams,
    "range_diagnostics": range_diagnostics,
    "inventory": inventory,
    "store_summary": store_summary,
    "stream_counts": stream_counts,
    "date_range": date_range,
    "roll_audit": roll_audit,
    "run_summary": run_summary,
    "covered_contracts": covered_contracts,
    "pending_contracts": pending_contracts,
    "contract_steps": contract_steps,
    "ledger_latest": ledger_latest,
    "chunk_ranges": chunk_ranges_of,
    "chunk_coverage": chunk_coverage,
    "backfill_stop": backfill_stop,
    "backfill_request": backfill_request,
    "probe_results": probe_results,
    "probe_availability": probe_availability,
    "export_csv_roundtrip": export_csv_roundtrip,
    "export_parquet_roundtrip": export_parquet_roundtrip,
    "interchange_roundtrip": interchange_roundtrip,
    "interchange_csv_roundtrip": interchange_csv_roundtrip,
    "export_manifest_counts": export_manifest_counts,
    "interchange_request": interchange_request,
    "union_sources": union_sources,
    "export_run": export_run,
    "stream_merge": stream_merge,
    "stream_stitch": stream_stitch,
    "stream_bars": stream_bars,
    "validate_rejects": validate_rejects,
    "validate_kept": validate_kept,
    "merge_vacuumed": merge_vacuumed,
    "export_run_open_ended": export_run_open_ended,
    "list_root": list_root,
    "prune_listed": prune_listed,
    "merge_disjoint": merge_disjoint,
    "merge_tiered": merge_tiered,
    "merge_concurrent": merge_concurrent,
    "replace_range": replace_range,
    "store_migrated": store_migrated,
    "refresh_weeks": refresh_weeks,
    "session_days": session_days,
    "fetch_pages": fetch_pages,
    "stitch_all_ticks": stitch_all_ticks,
    "export_single": export_single,
    "export_present_streams": export_present_streams,
    "export_all_timeframes": export_all_timeframes,
    "scan_folders": scan_folders,
    "stream_audited": stream_audited,
    "stream_late": stream_late,
    "stream_100tick": stream_100tick,
    "stream_stitch_late": stream_stitch_late,
}


def entry(spark: SparkSession) -> DataFrame:
    """Ticks to hourly bars to one continuous series, and which contract supplied what."""
    return naive(oi.roll_audit(stitch_hours(pin_utc(spark), FLAGSHIP_DIR)))


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline, if they can be imported."""
    try:
        import corpus_pipeline
        from tapeweave.llm.queries import QUERIES
        from tapeweave.llm.sql import SQL
    except ImportError as e:
        print(f"no training-data queries: {e}", file=sys.stderr)
        return {}, {}
    sql = SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(query):
        return lambda spark, sf_dir: naive(query(pin_utc(spark), sf_dir))
    return {name: wrap(query) for name, query in _QUERIES.items()} | _training_data()[0]


# --- SQL twins -------------------------------------------------------------------------------

_F1 = """f1 AS (
  SELECT upper(event_type) AS symbol,
         concat(upper(event_type), ' C', CAST(user_id % 4 AS VARCHAR)) AS contract,
         CASE event_id % 3 WHEN 0 THEN 'last' WHEN 1 THEN 'bid' ELSE 'ask' END AS price_type,
         epoch_us(ts) // 1000 AS unix_ms, ts AS timestamp,
         value AS open, value AS high, value AS low, value AS close,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, event_id AS seq
  FROM events)"""
_F2 = """f2 AS (
  SELECT l_returnflag AS symbol,
         concat(l_returnflag, ' C', CAST(l_suppkey % 8 AS VARCHAR)) AS contract,
         CAST(l_suppkey % 8 AS INTEGER) AS rank,
         CASE l_linenumber % 3 WHEN 0 THEN 'last' WHEN 1 THEN 'bid' ELSE 'ask' END AS price_type,
         epoch_us(l_shipdate) // 1000 AS unix_ms, l_shipdate AS timestamp,
         l_extendedprice AS open, l_extendedprice + l_quantity AS high,
         l_extendedprice - l_quantity AS low, l_extendedprice AS close,
         CAST(trunc(l_quantity) AS BIGINT) AS volume, l_orderkey % 3 AS part,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""
_F3 = """f3 AS (
  SELECT s.symbol, concat(s.symbol, k.suffix) AS contract, k.instrument_type, k.expiry, 'SIM' AS exchange
  FROM (SELECT DISTINCT upper(event_type) AS symbol FROM events) s,
       (VALUES (' C0', 'Future', DATE '2023-12-05'), (' C1', 'Future', DATE '2024-02-20'),
               (' C2', 'Future', DATE '2024-04-25'), (' C3', 'Future', DATE '2024-07-20'),
               (' C9', 'Future', DATE '2024-03-15'), (' SPOT', 'Stock', DATE '2024-03-15'))
         AS k(suffix, instrument_type, expiry)),
futures AS (SELECT * FROM f3 WHERE instrument_type = 'Future'),
kept AS (SELECT * FROM futures WHERE expiry BETWEEN DATE '2023-12-05' AND DATE '2024-04-25')"""
_F4 = """f4 AS (
  SELECT m.symbol, m.contract, 'ticks' AS table_name, m.from_date, m.to_date,
         CAST(m.n + t.extra AS BIGINT) AS bars_count, t.completed_at
  FROM (SELECT s.symbol, concat(s.symbol, k.suffix) AS contract, k.from_date, k.to_date,
               (SELECT count(*) FROM f1 b WHERE b.contract = concat(s.symbol, k.suffix)
                 AND CAST(b.timestamp AS DATE) BETWEEN k.from_date AND k.to_date) AS n
        FROM (SELECT DISTINCT symbol FROM f1) s,
             (VALUES (' C0', DATE '2024-01-01', DATE '2024-01-31'), (' C1', DATE '2024-01-01', DATE '2024-01-14'),
                     (' C1', DATE '2024-01-15', DATE '2024-01-31'), (' C2', DATE '2024-01-10', DATE '2024-01-20'),
                     (' C9', DATE '2024-01-01', DATE '2024-01-31')) AS k(suffix, from_date, to_date)) m,
       (VALUES (TIMESTAMP '2024-02-01 00:00:00', 1000), (TIMESTAMP '2024-02-02 00:00:00', 0)) AS t(completed_at, extra)),
f4_now AS (
  SELECT * FROM f4 QUALIFY row_number() OVER (
    PARTITION BY symbol, contract, table_name, from_date, to_date ORDER BY completed_at DESC, bars_count DESC) = 1),
f4_cover AS (
  SELECT symbol, contract, CAST(coalesce(sum(bars_count), 0) AS BIGINT) AS prior_bars, count(*) AS ledger_rows
  FROM f4_now WHERE from_date <= DATE '2024-01-05' AND to_date >= DATE '2024-01-25' GROUP BY ALL)"""
_F5 = """f5 AS (
  SELECT concat('S', l_suppkey) AS symbol, concat('S', l_suppkey, ' ', strftime(l_shipdate, '%Y-%m')) AS contract,
         'Future' AS instrument_type, CAST(max(l_shipdate) AS DATE) AS expiry, 'SIM' AS exchange
  FROM lineitem GROUP BY l_suppkey, strftime(l_shipdate, '%Y-%m')),
f5_kept AS (SELECT * FROM f5 WHERE expiry BETWEEN DATE '1995-01-10' AND DATE '1996-06-05')"""
_F6 = """f6 AS (
  SELECT l_returnflag AS symbol, concat(l_returnflag, ' C0') AS contract,
         CASE l_linenumber % 3 WHEN 0 THEN 'last' WHEN 1 THEN 'bid' ELSE 'ask' END AS price_type,
         CAST(l_shipdate AS TIMESTAMP) + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 61) % 86400 AS BIGINT)) AS timestamp,
         l_extendedprice AS open, l_extendedprice + l_quantity AS high, l_extendedprice - l_quantity AS low,
         l_extendedprice AS close, CAST(trunc(l_quantity) AS BIGINT) AS volume, (l_orderkey * 8 + l_linenumber) * 10000000 + l_partkey AS seq
  FROM lineitem),
hours_of(symbol, zone, opens, before) AS (VALUES ('A', 'America/Chicago', INTERVAL 17 HOUR, 1),
  ('N', 'Europe/Berlin', INTERVAL 70 MINUTE, 0), ('R', 'America/New_York', INTERVAL 570 MINUTE, 0)),
opened AS (
  SELECT symbol, CAST(day AS DATE) AS session_date,
         timezone('UTC', timezone(zone, day - to_days(before) + opens)) AS opens_at
  FROM hours_of, (SELECT unnest(generate_series(TIMESTAMP '1991-10-01', TIMESTAMP '2002-03-31', INTERVAL 1 DAY)) AS day)
  WHERE isodow(day) < 6 AND strftime(day, '%m-%d') NOT IN ('01-01', '07-04', '12-25'))"""
_BAR = "symbol, contract, price_type, timestamp, unix_ms, open, high, low, close, volume"
_TIE = "close DESC, high DESC, low DESC, open DESC, timestamp"
_KEY = "symbol, price_type, unix_ms"
_RANGE = "timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:59:59.999999'"
_ISO = "'%Y-%m-%dT%H:%M:%S.%f0Z'"


def _bars(bucket: str, source: str = "f1", order: str = "row(timestamp, seq)") -> str:
    return f"""SELECT symbol, contract, price_type, epoch_us({bucket}) // 1000 AS unix_ms, {bucket} AS timestamp,
      arg_min(open, {order}) AS open, max(high) AS high, min(low) AS low, arg_max(close, {order}) AS close,
      CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n
    FROM {source} GROUP BY symbol, contract, price_type, {bucket}"""


def _tick_bars(n: int) -> str:
    return f"""WITH {_F1}, placed AS (
      SELECT *, row_number() OVER (PARTITION BY symbol, contract, price_type ORDER BY timestamp, seq) - 1 AS place
      FROM f1)
    SELECT symbol, contract, price_type, epoch_us(min(timestamp)) // 1000 AS unix_ms, min(timestamp) AS timestamp,
      arg_min(open, place) AS open, max(high) AS high, min(low) AS low, arg_max(close, place) AS close,
      CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n, CAST((place // {n}) * {n} AS BIGINT) AS first_tick
    FROM placed GROUP BY symbol, contract, price_type, place // {n}"""


_HOURS = f"hours AS ({_bars('time_bucket(INTERVAL 1 HOUR, timestamp)')})"
_HOUR_SERIES = f"""{_F1}, {_F3}, {_HOURS}, hour_series AS (
  SELECT h.* FROM hours h LEFT JOIN f3 USING (symbol, contract)
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, expiry, contract, {_TIE}) = 1)"""
_DAY_SERIES = f"""{_F2}, day_series AS (
  SELECT * FROM f2 QUALIFY row_number() OVER (
    PARTITION BY {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1)"""
_MERGED = f"""{_F2}, batches AS (
  SELECT * FROM f2 QUALIFY row_number() OVER (
    PARTITION BY part, {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1)
SELECT {_BAR} FROM batches QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, part) = 1"""
_LATEST = f"""WITH {_F2} SELECT timestamp AS ts_event, contract AS symbol, price_type, 'nt' AS source,
  open, high, low, close, volume FROM f2
QUALIFY row_number() OVER (PARTITION BY contract, price_type, timestamp
  ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, open DESC, volume DESC) = 1"""
_STREAM_NAMES = "(VALUES ('last'), ('bid'), ('ask')) AS p(price_type)"


def _chunks(days: int, series: str, source: str) -> str:
    start, end = f"TIMESTAMP '{WALK_START}'", f"TIMESTAMP '{WALK_END}'"
    width = days * 86_400_000_000
    span = (WALK_END - WALK_START).total_seconds() / 86_400
    n = -(-int(span * 86_400) // (days * 86_400))
    return f"""counted AS (
      SELECT symbol, contract, price_type,
             least((epoch_us(timestamp) - epoch_us({start})) // {width}, {n - 1}) AS chunk_idx,
             count(*) AS bars, min(timestamp) AS first_ts, max(timestamp) AS last_ts
      FROM {source} WHERE timestamp BETWEEN {start} AND {end} GROUP BY ALL),
    chunks AS (
      SELECT s.symbol, s.contract, s.price_type, c.chunk_idx,
             make_timestamp(epoch_us({start}) + c.chunk_idx * {width}) AS chunk_from,
             least(make_timestamp(epoch_us({start}) + (c.chunk_idx + 1) * {width}), {end}) AS chunk_to,
             coalesce(bars, 0) AS bars, first_ts, last_ts
      FROM ({series}) s CROSS JOIN (SELECT range AS chunk_idx FROM range(0, {n})) c
      LEFT JOIN counted q ON q.symbol = s.symbol AND q.contract = s.contract
        AND q.price_type = s.price_type AND q.chunk_idx = c.chunk_idx)"""


def _stopped(limit: int) -> str:
    return f"""islands AS (
      SELECT *, sum(CASE WHEN bars > 0 THEN 1 ELSE 0 END) OVER (
        PARTITION BY symbol, contract, price_type ORDER BY chunk_idx) AS island FROM chunks),
    runs AS (
      SELECT *, sum(CASE WHEN bars = 0 THEN 1 ELSE 0 END) OVER (
        PARTITION BY symbol, contract, price_type, island ORDER BY chunk_idx) AS empty_run FROM islands),
    walk AS (
      SELECT *, min(CASE WHEN empty_run >= {limit} THEN chunk_idx END) OVER (
        PARTITION BY symbol, contract, price_type) AS stop_idx FROM runs)
    SELECT symbol, contract, price_type,
      CASE WHEN max(stop_idx) IS NULL THEN 'complete' ELSE 'stopped_no_data' END AS status,
      count(*) AS chunks_total,
      count(*) FILTER (stop_idx IS NULL OR chunk_idx <= stop_idx) AS chunks_done,
      CAST(coalesce(sum(bars) FILTER (stop_idx IS NULL OR chunk_idx <= stop_idx), 0) AS BIGINT) AS bars_downloaded,
      min(first_ts) FILTER (stop_idx IS NULL OR chunk_idx <= stop_idx) AS first_data_at,
      max(last_ts) FILTER (stop_idx IS NULL OR chunk_idx <= stop_idx) AS last_data_at,
      CAST(arg_max(empty_run, chunk_idx) FILTER (stop_idx IS NULL OR chunk_idx <= stop_idx) AS BIGINT) AS consecutive_empty
    FROM walk GROUP BY symbol, contract, price_type"""


# Ticks by the micro-batch they come in, and whether their hour had ended 20 days before the newest tick until then.
_LATE = f"""{_F1}, marks AS (
  SELECT seq % 3 AS batch, max(max(timestamp)) OVER (ORDER BY seq % 3 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 20 DAY AS mark FROM f1 GROUP BY seq % 3),
split AS (SELECT f1.*, batch, coalesce(time_bucket(INTERVAL 1 HOUR, timestamp) + INTERVAL 1 HOUR <= mark, false) AS late
  FROM f1 JOIN marks ON batch = seq % 3)"""


_PROBE = f"""{_F1}, {_F3},
minutes AS ({_bars('time_bucket(INTERVAL 1 MINUTE, timestamp)')}),
days AS ({_bars('time_bucket(INTERVAL 1 DAY, timestamp)')}),
grans(granularity, period_type, hours) AS (VALUES ('Day1', 'Day', 24), ('Minute1', 'Minute', 24), ('Tick1', 'Tick', 4)),
rungs(rung, lookback, ago) AS (VALUES (0, '1d', 1), (1, '1wk', 7), (2, '1mo', 30), (3, '3mo', 90), (4, '6mo', 180),
  (5, '1yr', 365), (6, '2yr', 730), (7, '5yr', 1825), (8, '10yr', 3650)),
ladder AS (
  SELECT *, TIMESTAMP '2024-02-01' - to_days(ago) AS probe_end,
         TIMESTAMP '2024-02-01' - to_days(ago) - to_hours(hours) AS probe_start
  FROM grans, rungs WHERE granularity <> 'Tick1' OR ago <= 730),
tables AS (
  SELECT 'Tick1' AS granularity, symbol, contract, price_type, timestamp FROM f1
  UNION ALL SELECT 'Minute1', symbol, contract, price_type, timestamp FROM minutes
  UNION ALL SELECT 'Day1', symbol, contract, price_type, timestamp FROM days),
probe AS (
  SELECT c.symbol, c.contract, l.granularity, l.period_type, CAST(l.rung AS BIGINT) AS rung, l.lookback, l.probe_start,
         count(t.timestamp) AS bars, min(t.timestamp) AS first_bar, max(t.timestamp) AS last_bar
  FROM futures c CROSS JOIN ladder l
  LEFT JOIN tables t ON t.contract = c.contract AND t.symbol = c.symbol AND t.granularity = l.granularity
    AND t.price_type = 'last' AND t.timestamp BETWEEN l.probe_start AND l.probe_end
  GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    tick_bar = "symbol, contract, price_type, unix_ms, timestamp, open, high, low, close, volume"
    series_rows = f"WITH {_DAY_SERIES} SELECT {_BAR} FROM day_series"
    stitched_days = f"WITH {_DAY_SERIES} SELECT {_BAR} FROM day_series"
    new_york = "timezone('UTC', timezone('America/New_York', timestamp))"
    tick_series = f"SELECT symbol, contract, price_type FROM futures, {_STREAM_NAMES}"
    return _training_data()[1] | {
        "normalize_ticks": f"WITH {_F1} SELECT {tick_bar}, seq FROM f1",
        "normalize_new_york": f"""WITH {_F1} SELECT symbol, contract, price_type, epoch_us({new_york}) // 1000 AS unix_ms,
            {new_york} AS timestamp, open, high, low, close, volume, seq FROM f1""",
        "scan_roundtrip": f"WITH {_F1} SELECT {tick_bar} FROM f1",
        "resample_hour": f"WITH {_F1} {_bars('time_bucket(INTERVAL 1 HOUR, timestamp)')}",
        "resample_15m": f"WITH {_F1} {_bars('time_bucket(INTERVAL 15 MINUTE, timestamp)')}",
        "resample_30s": f"WITH {_F1} {_bars('time_bucket(INTERVAL 30 SECOND, timestamp)')}",
        "resample_day": f"WITH {_F1} {_bars('time_bucket(INTERVAL 1 DAY, timestamp)')}",
        "resample_session_day": f"""WITH {_F1} {_bars(
            "time_bucket(INTERVAL 1 DAY, timestamp - INTERVAL 22 HOUR) + INTERVAL 22 HOUR")}""",
        "resample_100tick": _tick_bars(100),
        "resample_7tick": _tick_bars(7),
        "resample_bars_to_day": f"""WITH {_F1}, quarters AS ({_bars('time_bucket(INTERVAL 15 MINUTE, timestamp)')})
            {_bars('time_bucket(INTERVAL 1 DAY, timestamp)', 'quarters', 'timestamp')}""",
        "dedup_contract": f"""WITH {_F2} SELECT {_BAR} FROM f2 QUALIFY row_number() OVER (
            PARTITION BY symbol, contract, price_type, unix_ms ORDER BY volume DESC, {_TIE}) = 1""",
        "stitch_days": stitched_days,
        "stitch_hours": f"WITH {_HOUR_SERIES} SELECT {_BAR} FROM hour_series",
        "merge_incremental": f"WITH {_MERGED}",
        "merge_compacted": f"WITH {_MERGED}",
        "replace_symbol": f"""WITH {_F2}, batches AS (
            SELECT *, CASE WHEN part < 2 THEN 1 ELSE 2 END AS batch FROM f2 WHERE symbol <> 'R' OR part = 2),
            tops AS (SELECT * FROM batches QUALIFY row_number() OVER (
              PARTITION BY batch, {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1)
            SELECT {_BAR} FROM tops QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, batch) = 1""",
        "latest_wins": _LATEST,
        "list_instruments": f"""WITH {_F5} SELECT symbol, contract AS full_name,
            strftime(expiry, '%Y-%m-%d') AS expiry_iso, exchange FROM f5""",
        "list_root": f"""WITH {_F5} SELECT symbol, contract AS full_name,
            strftime(expiry, '%Y-%m-%d') AS expiry_iso, exchange FROM f5 WHERE symbol = 'S7'""",
        "prune_listed": f"WITH {_F5} SELECT * FROM f5_kept",
        "prune_contracts": f"WITH {_F3} SELECT * FROM kept",
        "prune_report": f"""WITH {_F5} SELECT symbol, count(*) AS contracts_total,
            count(*) FILTER (expiry BETWEEN DATE '1995-01-10' AND DATE '1996-06-05') AS contracts_kept,
            count(*) FILTER (expiry NOT BETWEEN DATE '1995-01-10' AND DATE '1996-06-05') AS contracts_dropped
            FROM f5 GROUP BY symbol""",
        "bars_of_contracts": f"WITH {_F1}, {_F3} SELECT f1.*, kept.expiry FROM f1 JOIN kept USING (symbol, contract)",
        "fetch_bars": f"""WITH {_F1}, {_HOURS} SELECT strftime(timestamp, {_ISO}) AS timestamp_iso,
            open, high, low, close, volume FROM hours
            WHERE contract = 'CLICK C1' AND price_type = 'last' AND {_RANGE}""",
        "select_streams": f"WITH {_F1} SELECT * FROM f1 WHERE price_type = 'bid'",
        "range_diagnostics": f"""WITH {_F1}, d AS (SELECT symbol, contract, price_type, count(*) AS total_bars,
            count(*) FILTER ({_RANGE}) AS kept_bars, min(timestamp) AS raw_first, max(timestamp) AS raw_last
            FROM f1 GROUP BY symbol, contract, price_type)
            SELECT *, total_bars - kept_bars AS filtered_bars, total_bars > kept_bars AND
              ((total_bars - kept_bars) * 10 > total_bars OR total_bars - kept_bars > 1000) AS reported FROM d""",
        "inventory": f"""WITH {_F1}, {_F3}, {_HOURS} SELECT c.symbol, c.contract AS full_name,
            strftime(c.expiry, '%Y-%m-%d') AS expiry_iso, count(h.timestamp) AS bar_count,
            strftime(min(h.timestamp), {_ISO}) AS first_bar_iso, strftime(max(h.timestamp), {_ISO}) AS last_bar_iso
            FROM futures c LEFT JOIN hours h ON h.symbol = c.symbol AND h.contract = c.contract
              AND h.price_type = 'last' GROUP BY c.symbol, c.contract, c.expiry""",
        "store_summary": f"""WITH {_HOUR_SERIES}, {_DAY_SERIES}, all_rows AS (
              SELECT 'minutes' AS timeframe, symbol, price_type, timestamp FROM hour_series
              UNION ALL SELECT 'days', symbol, price_type, timestamp FROM day_series)
            SELECT t.timeframe, a.symbol, a.price_type, count(a.timestamp) AS bar_count,
              min(a.timestamp) AS min_date, max(a.timestamp) AS max_date
            FROM (VALUES ('ticks'), ('minutes'), ('days')) AS t(timeframe) LEFT JOIN all_rows a USING (timeframe)
            GROUP BY t.timeframe, a.symbol, a.price_type""",
        "stream_counts": f"""WITH {_DAY_SERIES} SELECT symbol, price_type, count(*) AS bar_count
            FROM day_series GROUP BY symbol, price_type""",
        "date_range": f"""WITH {_DAY_SERIES} SELECT symbol, min(timestamp) AS min_ts, max(timestamp) AS max_ts
            FROM day_series GROUP BY symbol""",
        "roll_audit": f"""WITH {_HOUR_SERIES} SELECT symbol, contract, count(*) AS bars,
            min(timestamp) AS min_ts, max(timestamp) AS max_ts FROM hour_series WHERE {_RANGE}
            GROUP BY symbol, contract""",
        "run_summary": f"""WITH {_DAY_SERIES}, s AS (SELECT symbol, price_type, count(*) AS staged_rows FROM f2 GROUP BY ALL),
            e AS (SELECT symbol, price_type, count(*) AS final_rows, count(DISTINCT contract) AS contracts,
                  min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM day_series GROUP BY symbol, price_type)
            SELECT * FROM s JOIN e USING (symbol, price_type)""",
        "covered_contracts": f"WITH {_F1}, {_F4} SELECT * FROM f4_cover",
        "pending_contracts": f"""WITH {_F1}, {_F3}, {_F4} SELECT symbol, contract FROM kept
            WHERE (symbol, contract) NOT IN (SELECT (symbol, contract) FROM f4_cover)""",
        "contract_steps": f"""WITH {_F1}, {_F3}, {_F4} SELECT k.symbol,
            count(*) FILTER (c.contract IS NULL) AS contracts_processed,
            count(*) FILTER (c.contract IS NOT NULL) AS contracts_skipped
            FROM kept k LEFT JOIN f4_cover c ON c.symbol = k.symbol AND c.contract = k.contract GROUP BY k.symbol""",
        "ledger_latest": f"WITH {_F1}, {_F4} SELECT * FROM f4_now",
        "chunk_ranges": f"""WITH {_F5}, s AS (SELECT DISTINCT symbol FROM f5)
            SELECT symbol, range AS chunk_idx, TIMESTAMP '{WALK_START}' + to_days(CAST(range * 7 AS INTEGER)) AS chunk_from,
              least(TIMESTAMP '{WALK_START}' + to_days(CAST((range + 1) * 7 AS INTEGER)), TIMESTAMP '{WALK_END}') AS chunk_to
            FROM s, range(0, 7)""",
        "chunk_coverage": f"WITH {_F1}, {_F3}, {_chunks(1, tick_series, 'f1')} SELECT * FROM chunks",
        "backfill_stop": f"WITH {_F1}, {_F3}, {_chunks(1, tick_series, 'f1')}, {_stopped(3)}",
        "backfill_request": f"""WITH {_F1}, {_F3}, {_HOURS},
            {_chunks(7, "SELECT symbol, contract, 'bid' AS price_type FROM futures", 'hours')}, {_stopped(2)}""",
        "probe_results": f"WITH {_PROBE} SELECT * FROM probe",
        "probe_availability": f"""WITH {_PROBE} SELECT symbol, contract, granularity, period_type,
            count(*) AS probes_run, CAST(sum(bars) AS BIGINT) AS bars,
            count(*) FILTER (bars > 0) AS probes_with_data,
            strftime(min(first_bar), {_ISO}) AS first_available_iso,
            strftime(max(last_bar), {_ISO}) AS last_available_iso
            FROM probe GROUP BY symbol, contract, granularity, period_type""",
        "export_csv_roundtrip": f"""WITH {_DAY_SERIES} SELECT symbol, price_type, unix_ms, open, high, low, close,
            volume, contract FROM day_series""",
        "export_parquet_roundtrip": series_rows,
        "interchange_roundtrip": _LATEST,
        "interchange_csv_roundtrip": f"""WITH {_F1} SELECT epoch_us(timestamp) * 1000 AS ts_event_ns, contract AS symbol,
            price_type, 'nt' AS source, open, high, low, close, volume FROM f1""",
        "export_manifest_counts": f"""WITH {_DAY_SERIES} SELECT count(*) AS bar_count,
            count(*) FILTER (price_type = 'last') AS last_count, count(*) FILTER (price_type = 'bid') AS bid_count,
            count(*) FILTER (price_type = 'ask') AS ask_count, 'ready' AS status, true AS files_as_written FROM day_series""",
        "interchange_request": f"""WITH {_F1} SELECT count(*) AS bar_count,
            count(*) FILTER (price_type = 'last') AS last_count, 'ready' AS status
            FROM f1 WHERE contract = 'VIEW C2' AND {_RANGE}""",
        "union_sources": f"""WITH {_F1}, {_DAY_SERIES}
            SELECT timestamp AS ts_event, contract AS symbol, price_type, 'nt' AS source, open, high, low, close, volume
            FROM f1 WHERE price_type = 'last'
            UNION ALL SELECT timestamp, contract, NULL, 'other', open, high, low, close, volume FROM day_series""",
        "export_run": f"""WITH {_F1}, {_F3} SELECT {tick_bar} FROM f1 JOIN kept USING (symbol, contract) WHERE {_RANGE}
            QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, expiry, contract, {_TIE}) = 1""",
        "stream_merge": f"WITH {_MERGED}",
        "merge_vacuumed": f"WITH {_MERGED}",
        "validate_rejects": f"""WITH {_F2} SELECT CASE l_linenumber WHEN 7 THEN 'blank symbol' WHEN 6 THEN 'null: volume'
            ELSE 'null: symbol' END AS reject_reason, count(*) AS bars FROM f2 WHERE l_linenumber IN (5, 6, 7) GROUP BY ALL""",
        "validate_kept": f"""WITH {_F2} SELECT {_BAR} FROM f2 WHERE l_linenumber NOT IN (5, 6, 7)
            QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1""",
        "export_run_open_ended": f"""WITH {_F1}, {_F3} SELECT {tick_bar} FROM f1 JOIN kept USING (symbol, contract)
            WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp <=
              CASE WHEN expiry <= DATE '2024-01-14' THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01' END
            QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, expiry, contract, {_TIE}) = 1""",
        "merge_disjoint": stitched_days,
        "merge_concurrent": stitched_days,
        "merge_tiered": f"""WITH {_F2}, batches AS (
            SELECT * FROM f2 QUALIFY row_number() OVER (
              PARTITION BY l_orderkey % 6, {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1)
            SELECT {_BAR} FROM batches QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, l_orderkey % 6) = 1""",
        "replace_range": f"""WITH {_F2}, batches AS (
            SELECT *, CASE WHEN part < 2 THEN 1 ELSE 2 END AS batch FROM f2
            WHERE part = 2 OR timestamp NOT BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31 23:59:59.999'),
            tops AS (SELECT * FROM batches QUALIFY row_number() OVER (
              PARTITION BY batch, {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1)
            SELECT {_BAR} FROM tops QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, batch) = 1""",
        "store_migrated": f"WITH {_DAY_SERIES} SELECT * REPLACE ('' AS contract) FROM (SELECT {_BAR} FROM day_series)",
        "refresh_weeks": f"""WITH merged AS (WITH {_MERGED}), w AS (
            SELECT *, make_timestamp((epoch_us(timestamp) // {7 * 86_400_000_000}) * {7 * 86_400_000_000}) AS start FROM merged)
            SELECT symbol, price_type, epoch_ms(start) AS unix_ms, start AS timestamp, arg_min(open, timestamp) AS open,
              max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume,
              count(*) AS n FROM w GROUP BY symbol, price_type, start""",
        "session_days": f"""WITH {_F6}, t AS (
            SELECT f6.*, o.session_date, o.opens_at FROM f6 ASOF JOIN opened o
            ON f6.symbol = o.symbol AND f6.timestamp >= o.opens_at)
            SELECT symbol, contract, price_type, session_date, epoch_us(opens_at) // 1000 AS unix_ms, opens_at AS timestamp,
              arg_min(open, row(timestamp, seq)) AS open, max(high) AS high, min(low) AS low,
              arg_max(close, row(timestamp, seq)) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n
            FROM t GROUP BY symbol, contract, price_type, session_date, opens_at""",
        "fetch_pages": f"""WITH {_F1}, {_HOURS} SELECT strftime(timestamp, {_ISO}) AS timestamp_iso,
            open, high, low, close, volume FROM hours
            WHERE contract = 'CLICK C1' AND price_type = 'last' AND {_RANGE}""",
        "stitch_all_ticks": f"""WITH {_F1}, {_F3} SELECT {_BAR}, seq FROM (
            SELECT f1.*, f3.expiry FROM f1 LEFT JOIN f3 USING (symbol, contract)) QUALIFY row_number() OVER (
              PARTITION BY {_KEY}, seq ORDER BY volume DESC, expiry, contract, {_TIE}) = 1""",
        "export_single": f"""WITH {_DAY_SERIES} SELECT unix_ms, open, high, low, close, volume, contract,
            concat(symbol, '/', price_type) AS name FROM day_series""",
        "export_present_streams": f"""WITH {_DAY_SERIES} SELECT DISTINCT symbol, price_type FROM day_series
            WHERE NOT (symbol = 'A' AND price_type = 'ask')""",
        "export_all_timeframes": f"""WITH {_F1}, {_F3}, s AS (SELECT {tick_bar} FROM f1 JOIN kept USING (symbol, contract) WHERE {_RANGE}
            QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY volume DESC, expiry, contract, {_TIE}) = 1)
            SELECT s.*, t.timeframe FROM s, (VALUES ('ticks'), ('days')) AS t(timeframe)""",
        "scan_folders": f"WITH {_F1} SELECT {tick_bar} FROM f1 WHERE contract = 'CLICK C1' AND {_RANGE}",
        "stream_audited": f"WITH {_LATE} {_bars('time_bucket(INTERVAL 1 HOUR, timestamp)', '(SELECT * FROM split WHERE NOT late)')}",
        "stream_late": f"""WITH {_LATE} SELECT batch AS epoch, count(*) AS rows_in, count(*) FILTER (NOT late) AS rows_used,
            count(*) FILTER (late) AS rows_late, count(*) FILTER (late) AS rows_kept_aside FROM split GROUP BY batch""",
        "stream_100tick": _tick_bars(100),
        "stream_stitch_late": f"""WITH {_F2}, marks AS (
            SELECT part, max(max(timestamp)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - INTERVAL 1460 DAY AS mark FROM f2 GROUP BY part),
            used AS (SELECT f2.* FROM f2 JOIN marks USING (part) WHERE mark IS NULL OR timestamp > mark)
            SELECT {_BAR} FROM used QUALIFY row_number() OVER (
              PARTITION BY {_KEY} ORDER BY volume DESC, rank, contract, {_TIE}) = 1""",
        "stream_stitch": stitched_days,
        "stream_bars": f"WITH {_F1} {_bars('time_bucket(INTERVAL 1 HOUR, timestamp)')}",
    }
