"""Exports: layout, order, escaping, manifest."""

import glob
import hashlib
import gzip
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.functions.text import clean_symbol, safe_name
from tapeweave.plans.interchange import export_contract
from tapeweave.schema import BAR_COLUMNS, INTERCHANGE_COLUMNS
from tapeweave.session import workspace
from tapeweave.sources import sinks
from tapeweave.sources.scan import scan_bars, scan_instruments, scan_series


def local(path):
    return path.removeprefix("file:")


def many(spark, n=3000):
    """Shuffled rows of two symbols, no ask rows."""
    df = spark.range(0, n, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "NQ").otherwise("ES").alias("symbol"), F.lit("ES H4").alias("contract"),
        F.when(F.col("id") % 2 == 0, "last").otherwise("bid").alias("price_type"),
        ((F.col("id") * 7919) % n * 60_000).alias("unix_ms"), *[F.lit(1.5).alias(c) for c in ("open", "high", "low", "close")],
        F.col("id").alias("volume"))
    return df.withColumn("timestamp", F.timestamp_millis("unix_ms")).select(BAR_COLUMNS)


def test_csv_files_are_in_time_order_per_stream(spark):
    out = workspace(spark, "csv")
    sinks.export_csv(many(spark), out)
    folders = sorted(os.path.relpath(p, local(out)) for p in glob.glob(local(out) + "/root=*/stream=*"))
    assert folders == [f"root={r}/stream={s}" for r in ("ES", "NQ") for s in ("bid", "last")]
    for folder in folders:
        keys = []
        for path in sorted(glob.glob(f"{local(out)}/{folder}/part-*.csv")):
            lines = open(path).read().splitlines()
            assert lines[0] == "unix_ms,open,high,low,close,volume,contract"
            keys += [int(line.split(",")[0]) for line in lines[1:]]
        assert keys == sorted(keys) and len(keys) > 100


def test_parquet_files_hold_all_columns_in_order(spark):
    import pyarrow.parquet as pq
    out = workspace(spark, "parquet")
    sinks.export_parquet(many(spark), out)
    for folder in glob.glob(local(out) + "/root=*/stream=*"):
        keys = []
        for path in sorted(glob.glob(folder + "/part-*.parquet")):
            table = pq.ParquetFile(path).read()
            assert table.column_names == BAR_COLUMNS
            keys += table["unix_ms"].to_pylist()
        assert keys == sorted(keys)
    assert scan_series(spark, out).count() == 3000


def test_store_files_are_sorted(spark):
    import pyarrow.parquet as pq
    from tapeweave.sources.store import BarStore
    store = BarStore(spark, workspace(spark, "store"))
    store.merge(many(spark), "minutes")
    for path in glob.glob(local(store.path) + "/bars/timeframe=minutes/batch=*/symbol=*/*.parquet"):
        table = pq.ParquetFile(path).read(columns=["price_type", "unix_ms"]).to_pylist()
        keys = [(r["price_type"], r["unix_ms"]) for r in table]
        assert keys == sorted(keys)


ODD = 'A,B "C"\nD '


def test_interchange_csv_keeps_duplicates_order_and_odd_symbols(spark):
    out = workspace(spark, "interchange")
    rows = [bar("2024-01-05 10:00:00.123456", 1, ODD, "ask"), bar("2024-01-05 10:00:00", 2, ODD, "last"),
            bar("2024-01-05 10:00:00", 2, ODD, "last"), bar("2024-01-05 10:00:00", 3, ODD, "bid")]
    sinks.export_interchange(sinks.to_interchange(frame(spark, rows)), out, "csv")
    text = "".join(open(p).read() for p in sorted(glob.glob(local(out) + "/part-*.csv")))
    assert '"A,B ""C""\nD "' in text and "1704448800123456000" in text
    back = sinks.read_interchange(spark, out, "csv", multiline=True)
    assert [r["price_type"] for r in back.collect()] == ["last", "last", "bid", "ask"]
    assert {r["symbol"] for r in back.collect()} == {ODD} and {r["source"] for r in back.collect()} == {"nt"}


def test_interchange_parquet_is_keyed_and_snappy(spark):
    import pyarrow.parquet as pq
    out = workspace(spark, "interchange")
    df = frame(spark, [bar("2024-01-05", 9, seq=1), bar("2024-01-05", 1, seq=2), bar("2024-01-04", 1, price_type="bid")])
    sinks.export_interchange(sinks.to_interchange(df, keep=("seq",)), out, "parquet", sequence="seq")
    assert rows_of(sinks.read_interchange(spark, out), "price_type", "volume") == [("bid", 1), ("last", 1)]
    meta = pq.ParquetFile(glob.glob(local(out) + "/*.parquet")[0])
    assert meta.schema_arrow.names == INTERCHANGE_COLUMNS
    assert meta.metadata.row_group(0).column(0).compression == "SNAPPY"


def test_interchange_keyed_by_arrival_in_both_formats(spark):
    df = sinks.to_interchange(frame(spark, [bar("2024-01-05", 1, seq=2), bar("2024-01-05", 9, seq=1), bar("2024-01-05", 4, "ES M4", seq=1)]), keep=("seq",))
    for fmt in ("parquet", "csv"):
        out = workspace(spark, "interchange")
        sinks.export_interchange(df, out, fmt, sequence="seq", dedup=True)
        assert rows_of(sinks.read_interchange(spark, out, fmt), "symbol", "volume") == [("ES H4", 1), ("ES M4", 4)]


def test_manifest_counts_and_hashes(spark):
    out = workspace(spark, "csv")
    df = many(spark)
    row = sinks.export_manifest(spark, out, sinks.export_csv(df, out, "gzip"), "csv").first()
    assert (row["bar_count"], row["status"]) == (3000, "ready")
    assert row["bar_count_by_stream"] == {"last": 1500, "bid": 1500}
    files = sinks.export_files(spark, out, "csv").collect()
    assert row["files"] == len(files) and row["size_bytes"] == sum(f["size_bytes"] for f in files)
    for f in files:
        data = open(local(f["path"]), "rb").read()
        assert hashlib.sha256(data).hexdigest() == f["sha256"] and len(data) == f["size_bytes"]
        assert gzip.decompress(data).startswith(b"unix_ms,open")


def test_nothing_to_export(spark):
    empty = frame(spark, [bar("2024-01-05")])
    got = export_contract(empty, "ES Z9", "2024-01-01", "2024-02-01", workspace(spark, "none"), fmt="csv").first()
    assert (got["status"], got["bar_count"], got["bar_count_by_stream"]) == ("no_data", 0, {})
    out = workspace(spark, "none")
    sinks.export_csv(empty.filter("false"), out)
    assert not glob.glob(local(out) + "/root=*")


def test_contract_request_filters_stream_and_range(spark):
    df = frame(spark, [bar("2024-01-05", seq=1), bar("2024-01-06", seq=2), bar("2024-01-05", price_type="bid", seq=3)])
    out = workspace(spark, "one")
    got = export_contract(df, "ES H4", "2024-01-05", "2024-01-05 12:00:00", out, streams="Last", sequence="seq").first()
    assert got["bar_count_by_stream"] == {"last": 1}
    assert sinks.read_interchange(spark, out).count() == 1


def test_unknown_formats_are_refused(spark):
    df = sinks.to_interchange(frame(spark, [bar("2024-01-05")]))
    with pytest.raises(ValueError):
        sinks.export_interchange(df, workspace(spark, "x"), "xml")
    with pytest.raises(ValueError):
        scan_bars(spark, "x", "xml")


def test_scan_formats(spark):
    raw = spark.createDataFrame([("ES", "ES H4", "last", datetime(2024, 1, 5, 10, 0, 0, 5), 1.0, 2.0, 0.5, 1.5, 2.7)],
                                "symbol string, contract string, price_type string, time timestamp_ntz, open double, "
                                "high double, low double, close double, volume double")
    for fmt in ("parquet", "orc"):
        path = workspace(spark, fmt)
        raw.write.format(fmt).save(path)
        assert scan_bars(spark, path, fmt).collect() == raw.collect()
    path = workspace(spark, "bad")
    os.makedirs(local(path))
    with open(local(path) + "/a.csv", "w") as f:
        f.write("symbol,contract,price_type,time,open,high,low,close,volume\n"
                "ES,ES H4,last,2024-01-05 10:00:00.000005,1,2,0.5,1.5,2.7\nES,ES H4,last,never,1,2,0.5,x,2\n")
    got = scan_bars(spark, path, "csv").orderBy(F.col("time").asc_nulls_last()).collect()
    assert got[0] == raw.first() and got[1]["time"] is None and got[1]["close"] is None


def test_catalog_scan(spark):
    path = workspace(spark, "catalog")
    df = spark.sql("SELECT 'ES' symbol, 'ES H4' contract, 'Future' instrument_type, DATE '2024-03-15' expiry, 'CME' exchange")
    df.write.parquet(path)
    assert scan_instruments(spark, path).collect() == df.collect()


def test_text_helpers(spark):
    row = spark.createDataFrame([(" es ", "ES 06-26/a:b")], "a string, b string").select(
        clean_symbol(F.col("a")), safe_name(F.col("b"))).first()
    assert tuple(row) == ("ES", "ES_06-26_a_b")
