"""Bars kept up to date, the folder source, and single-file exports."""

import glob
import gzip
import hashlib
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.resample import resample
from tapeweave.plans.refresh import Derived
from tapeweave.session import workspace
from tapeweave.sources import sinks
from tapeweave.sources.bar_source import BarReader, read_bar_folders, write_bar_folders
from tapeweave.sources.store import BarStore


@pytest.fixture
def store(spark):
    return BarStore(spark, workspace(spark, "store"))


def day(d, volume=5, hours=range(24), **more):
    return [bar(f"2024-01-{d:02d} {h:02d}:00:00", volume, **more) for h in hours]


def full(store):
    return resample(store.read("minutes"), "Day", 1, series=["symbol", "price_type"])


def check(store, days):
    want = full(store)
    assert rows_of(days.read(), *want.columns) == rows_of(want, *want.columns)


def test_refreshes_equal_the_full_resample(spark, store):
    days = Derived(store, "minutes", workspace(spark, "days"), "Day")
    assert days.read().isEmpty()
    store.merge(frame(spark, day(3) + day(4) + day(5) + day(4, symbol="NQ")), "minutes")
    assert days.refresh().full
    check(store, days)
    store.merge(frame(spark, day(4, 9, range(2)) + day(9)), "minutes")
    got = days.refresh()
    assert (got.buckets, got.full) == (2, False)
    check(store, days)
    assert days.refresh().buckets == 0


def test_untouched_files_are_not_read(spark, store):
    days = Derived(store, "minutes", workspace(spark, "days"), "Day")
    for d in (3, 4, 5):
        store.merge(frame(spark, day(d)), "minutes")
    days.refresh()
    store.merge(frame(spark, day(4, 9, range(1))), "minutes")
    seen = []
    real = BarStore._scan

    def scan(self, files):
        seen.extend(f.low for f in files)
        return real(self, files)
    BarStore._scan = scan
    try:
        days.refresh()
    finally:
        BarStore._scan = real
    check(store, days)
    assert rows_of(days.read(), "volume") == [(120,), (120,), (124,)]


def test_compactions_touch_nothing(spark, store):
    days = Derived(store, "minutes", workspace(spark, "days"), "Day")
    for v in (1, 2):
        store.merge(frame(spark, day(3, v)), "minutes")
    days.refresh()
    store.compact("minutes")
    assert days.refresh().buckets == 0
    check(store, days)


def test_replacements_and_cleared_ranges_remake_what_was_there(spark, store):
    days = Derived(store, "minutes", workspace(spark, "days"), "Day")
    store.merge(frame(spark, day(3) + day(4) + day(5) + day(4, symbol="NQ")), "minutes")
    days.refresh()
    store.replace_range(frame(spark, day(4, 1, range(2))), "minutes", "2024-01-04", "2024-01-05 11:59:59")
    days.refresh()
    check(store, days)
    store.replace(frame(spark, day(8)), "minutes")
    got = days.refresh()
    check(store, days)
    assert not got.full and rows_of(days.read(), "symbol") == [("ES",), ("NQ",)]


def test_lost_history_means_a_full_refresh(spark, store):
    days = Derived(store, "minutes", workspace(spark, "days"), "Day")
    store.merge(frame(spark, day(3)), "minutes")
    days.refresh()
    store.replace(frame(spark, day(4)), "minutes")
    store.vacuum()
    other = Derived(BarStore(spark, store.path), "minutes", days.out, "Day")
    assert other.refresh().full
    check(store, other)
    with pytest.raises(ValueError):
        Derived(store, "minutes", "x", "Tick", 5)


def raw(spark, n=2000):
    df = spark.range(n).select(
        F.lit("ES").alias("symbol"), F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 7 == 0, "a/b %").otherwise("ES H4").alias("contract"),
        F.lit("last").alias("price_type"),
        F.when(F.col("id") % 90 != 1, (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("id").cast("int") * 20))).cast("timestamp_ntz").alias("time"),
        *[F.lit(1.5).alias(c) for c in ("open", "high", "low", "close")], F.col("id").cast("double").alias("volume"))
    return df


def test_folder_source_reads_all(spark):
    out = workspace(spark, "folders")
    df = raw(spark)
    write_bar_folders(df, out)
    got = read_bar_folders(spark, out)
    assert rows_of(got, "volume") == rows_of(df, "volume")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.select(got.columns).collect()))


@pytest.mark.parametrize("condition", [
    "contract = 'a/b %'", "contract IN ('a/b %', 'none') AND time >= TIMESTAMP_NTZ '2024-01-05 10:00:00'",
    "time > TIMESTAMP_NTZ '2024-01-05' AND time < TIMESTAMP_NTZ '2024-01-06 00:20:00'", "contract IS NULL AND volume > 100",
    "contract = 'none'", "time <= TIMESTAMP_NTZ '2023-01-01'"])
def test_folder_source_with_filters(spark, condition):
    out = workspace(spark, "folders")
    df = raw(spark)
    write_bar_folders(df, out)
    assert rows_of(read_bar_folders(spark, out, 3).filter(condition), "volume") == rows_of(df.filter(condition), "volume")


def test_folder_source_plans_by_contract_and_chunk(spark):
    out = workspace(spark, "folders")
    write_bar_folders(raw(spark), out)
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, LessThan
    reader = BarReader({"path": out, "chunk_days": "7"})
    everything = reader.partitions()
    filters = [EqualTo(("contract",), "ES H4"), GreaterThanOrEqual(("time",), datetime(2024, 1, 10)), LessThan(("time",), datetime(2024, 1, 12)),
               IsNotNull(("time",))]
    assert list(reader.pushFilters(filters)) == filters[-1:]
    some = reader.partitions()
    assert {c.contract for c in some} == {"ES H4"} and 1 <= len(some) <= 2 and len(everything) > 8
    days = {f.split("day=")[1][:10] for c in some for f in c.files}
    assert days == {"2024-01-10", "2024-01-11"}


@pytest.mark.parametrize("compression", ["gzip", None])
def test_single_files_are_valid_and_in_order(spark, compression, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_RECORDS_PER_FILE", 100)  # many parts
    rows = [bar(f"2024-01-{d:02d} {h:02d}:{m:02d}:00", 1, symbol=s, price_type=p, contract='x "y", z')
            for s in ("ES", "a/b") for p in ("last", "bid") for d in range(1, 4) for h in range(24) for m in (0, 30)]
    out = workspace(spark, "single")
    files = sinks.export_single_csv(frame(spark, rows[::-1]).repartition(7), out, compression).collect()
    assert len(files) == 4 and all(f["parts"] > 1 for f in files)
    for f in files:
        data = open(f["path"].removeprefix("file:"), "rb").read()
        assert hashlib.sha256(data).hexdigest() == f["sha256"] and len(data) == f["size_bytes"]
        lines = (gzip.decompress(data) if compression else data).decode().splitlines()
        assert lines[0] == "unix_ms,open,high,low,close,volume,contract" and lines[1].endswith('"x ""y"", z"')
        keys = [int(line.split(",")[0]) for line in lines[1:]]
        assert keys == sorted(keys) and len(keys) == 144
    assert not glob.glob(out.removeprefix("file:") + "/*/.*")
    assert sinks.export_single_csv(frame(spark, rows).filter("false"), workspace(spark, "none")).count() == 0
    with pytest.raises(ValueError):
        sinks.export_single_csv(frame(spark, rows), out, "zip")


def test_counts_are_those_of_the_write(spark):
    rows = frame(spark, [bar("2024-01-05", 9, seq=1), bar("2024-01-05", 1, seq=2), bar("2024-01-04", 1, price_type="bid"), bar("2024-01-04", 1, price_type="odd")])
    done = sinks.export_parquet(rows, workspace(spark, "p"))
    assert done.given == done.rows == {"last": 2, "bid": 1, "other": 1}
    out = workspace(spark, "i")
    done = sinks.export_interchange(sinks.to_interchange(rows, keep=("seq",)), out, "parquet", sequence="seq")
    assert done.given == {"last": 2, "bid": 1, "other": 1} and done.rows == {"last": 1, "bid": 1, "other": 1}
    plain = sinks.export_interchange(sinks.to_interchange(rows), workspace(spark, "i"), "csv")
    assert plain.given == plain.rows == {"last": 2, "bid": 1, "other": 1}
    manifest = sinks.export_manifest(spark, out, done, "parquet")
    row = manifest.first()
    assert (row["bar_count"], row["file_rows"], row["status"]) == (4, 3, "ready") and sinks.verify_manifest(spark, out, manifest, "parquet")
    path = glob.glob(out.removeprefix("file:") + "/*.parquet")[0]
    shutil.copy(path, path.replace("part-", "part-9"))
    assert not sinks.verify_manifest(spark, out, manifest.sparkSession.createDataFrame([row], manifest.schema), "parquet")


def test_keyed_needs_a_sequence(spark):
    rows = sinks.to_interchange(frame(spark, [bar("2024-01-05")]))
    for fmt, dedup in (("parquet", False), ("csv", True)):
        with pytest.raises(ValueError, match="sequence"):
            sinks.export_interchange(rows, workspace(spark, "x"), fmt, dedup=dedup)
