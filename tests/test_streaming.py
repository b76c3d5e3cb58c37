"""Streams equal their batch twins, whatever the order and repetition."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from helpers import bar, frame, rows_of
from tapeweave.operators.resample import resample
from tapeweave.operators.stitch import stitch
from tapeweave.schema import BAR_COLUMNS, KEY, SERIES
from tapeweave.session import workspace
from tapeweave.sources.store import BarStore
from tapeweave.streaming.files import drain, read_stream, read_upserts, upsert_writer
from tapeweave.streaming.merge import merge_stream
from tapeweave.streaming.series import bar_stream, stitch_stream


def rows(seed, n=200):
    rng = random.Random(seed)
    months = [("ES H4", date(2024, 3, 15)), ("ES M4", date(2024, 6, 21))]
    out = []
    for i in range(n):
        contract, expiry = rng.choice(months)
        out.append(bar(f"2024-01-05 {rng.randrange(4):02d}:{rng.randrange(20):02d}:{rng.randrange(60):02d}", i, contract,
                       price=float(rng.randrange(50)), expiry=expiry, seq=i))
    return out


def files(spark, data, n=3):
    path = workspace(spark, "in")
    for i in range(n):
        frame(spark, data[i::n]).coalesce(1).write.mode("append").parquet(path)
    return path, frame(spark, data).schema


def test_merge_stream_equals_batch_and_restarts(spark):
    data = rows(1)
    path, schema = files(spark, data)
    store, checkpoint = BarStore(spark, workspace(spark, "store")), workspace(spark, "cp")
    drain(merge_stream(read_stream(spark, path, schema, 1), store, "minutes", checkpoint, "q"))
    assert store.ledger().select("batch").distinct().count() == 3
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == rows_of(stitch(frame(spark, data)), *BAR_COLUMNS)

    late = [bar("2024-01-05 00:00:01", 10_000, "ES M4", price=1.0)]
    frame(spark, late).write.mode("append").parquet(path)
    drain(merge_stream(read_stream(spark, path, schema, 1), store, "minutes", checkpoint, "q"))
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == rows_of(stitch(frame(spark, data + late)), *BAR_COLUMNS)

    # A lost checkpoint delivers everything again under the same names: nothing changes.
    before = store.ledger().count()
    drain(merge_stream(read_stream(spark, path, schema, 1), store, "minutes", workspace(spark, "cp"), "q"))
    assert store.ledger().count() == before


def test_stream_commits_claim_no_coverage(spark):
    path, schema = files(spark, rows(2), 1)
    store = BarStore(spark, workspace(spark, "store"))
    drain(merge_stream(read_stream(spark, path, schema), store, "minutes", workspace(spark, "cp"), "q"))
    contracts = spark.createDataFrame([("ES", "ES H4")], "symbol string, contract string")
    assert store.pending(contracts, "minutes", date(2024, 1, 5), date(2024, 1, 5)).count() == 1


def test_stitch_stream_equals_batch(spark):
    data = rows(3) + [bar("2024-01-05 01:00:00", 7, "ES H4", price=5.0), bar("2024-01-05 01:00:00", 7, "ES H4", price=6.0)]
    path, schema = files(spark, data)
    for lateness in (None, "2 days"):
        live = stitch_stream(read_stream(spark, path, schema, 1), lateness)
        out = workspace(spark, "out")
        drain(upsert_writer(live, out, workspace(spark, "cp")))
        assert rows_of(read_upserts(spark, out, live.schema, KEY), *BAR_COLUMNS) == \
            rows_of(stitch(frame(spark, data)), *BAR_COLUMNS)


def test_bar_stream_equals_batch(spark):
    data = rows(4)
    path, schema = files(spark, data)
    live = bar_stream(read_stream(spark, path, schema, 1), "Minute", 15, "1 day")
    out = workspace(spark, "out")
    drain(upsert_writer(live, out, workspace(spark, "cp")))
    batch = resample(frame(spark, data), "Minute", 15)
    assert rows_of(read_upserts(spark, out, live.schema, [*SERIES, "unix_ms"]), *batch.columns) == rows_of(batch, *batch.columns)


@pytest.mark.parametrize("query, table, parts", [("stream_stitch", "lineitem", [2, 3]), ("stream_bars", "events", [3])])
def test_fed_files_grow_in_number_and_not_in_size(spark, sf_dir, tmp_path, monkeypatch, query, table, parts):
    source, n = spark.read.parquet(f"{sf_dir}/{table}.parquet"), 6
    source.repartition(n).write.parquet(f"{tmp_path}/{table}.parquet")
    fed = []
    monkeypatch.setattr(entry, "read_stream", lambda s, path, schema, k: fed.append((path, k)) or read_stream(s, path, schema, k))
    want = sorted(map(repr, getattr(entry, query)(spark, sf_dir).collect()))
    del fed[:]
    assert sorted(map(repr, getattr(entry, query)(spark, str(tmp_path)).collect())) == want
    assert [k for _, k in fed] == [n] * len(parts)  # in a micro-batch
    made = spark.read.parquet(fed[-1][0]).groupBy(F.input_file_name()).count().collect()
    assert len(made) == n * parts[-1] and max(r["count"] for r in made) <= source.count() / n + n
