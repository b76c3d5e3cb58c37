"""Nothing is lost without a sign: rejects, open-ended resume, restarted sinks, vacuum."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.ranges import resolve_range
from tapeweave.operators.stitch import stitch
from tapeweave.plans.export import export_series
from tapeweave.schema import BAR_COLUMNS, KEY
from tapeweave.session import workspace
from tapeweave.sources.store import BarStore
from tapeweave.streaming.files import drain, fold_upserts, read_stream, read_upserts, upsert_writer
from tapeweave.streaming.merge import merge_stream
from tapeweave.streaming.series import stitch_stream

T0, T1 = "2024-01-05 10:00:00", "2024-01-05 10:01:00"


@pytest.fixture
def store(spark):
    return BarStore(spark, workspace(spark, "store"))


def faulty(spark):
    good = frame(spark, [bar(T0, 5), bar(T1, 5)])
    none = good.limit(1)
    return (good.unionByName(none.withColumn("symbol", F.lit(None).cast("string")))
            .unionByName(none.withColumn("symbol", F.lit("  "))).unionByName(none.withColumn("volume", F.lit(None).cast("bigint")))
            .unionByName(none.withColumn("volume", F.lit(None).cast("bigint"))))


def test_rows_in_are_kept_or_rejected(spark, store):
    store.merge(faulty(spark), "minutes")
    assert store.read("minutes").count() == 2
    assert rows_of(store.rejects("minutes"), "reject_reason") == [("blank symbol",), ("null: symbol",), ("null: volume",), ("null: volume",)]
    assert rows_of(store.ledger(), "symbol", "bars_count") == [("ES", 2)]
    assert store.rejects("days").isEmpty()


def test_streamed_rejects(spark, store):
    path = workspace(spark, "in")
    rows = faulty(spark)
    rows.coalesce(1).write.parquet(path)
    drain(merge_stream(read_stream(spark, path, rows.schema), store, "minutes", workspace(spark, "cp"), "q"))
    assert store.read("minutes").count() == 2 and store.rejects("minutes").count() == 4


def live_folders(store):
    """Batch folders that a read opens; its plan lists the ledger's files beside them."""
    return {f.split("batch=")[1].split("/")[0] for f in store.read("minutes").inputFiles() if "batch=" in f}


def test_merge_reads_its_input_once(spark, store):
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b
    rows = frame(spark, [bar(T0, v) for v in range(20)]).coalesce(1)
    store.merge(rows.mapInArrow(seen, rows.schema), "minutes")
    assert scans.value == 20


def test_vacuum_and_ledger_compaction_change_no_rows(spark, store):
    for day in (5, 6, 7):
        store.merge(frame(spark, [bar(f"2024-01-0{day} 10:00:00", day), bar(T0, 1)]), "minutes")
    before = rows_of(store.read("minutes"), *BAR_COLUMNS)
    store.compact("minutes")
    store.compact_ledger()
    assert store.vacuum() == 3 and store.vacuum() == 0
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == before
    assert len(store.ledger().inputFiles()) == 1
    assert len(live_folders(store)) == 1


def test_reads_list_live_folders_only(spark, store):
    for v in (1, 2):
        store.merge(frame(spark, [bar(T0, v)]), "minutes")
    store.compact("minutes")
    live = {r["batch"] for r in store.live_ledger().select("batch").distinct().collect()}
    assert live_folders(store) == live


CATALOG = "symbol string, contract string, instrument_type string, expiry date, exchange string"
RAW = ("symbol string, contract string, price_type string, time timestamp_ntz, open double, high double, "
       "low double, close double, volume double")


def raw(spark, *bars):
    return spark.createDataFrame([("ES", c, "last", t, 1.0, 2.0, 0.5, 1.5, float(v)) for c, t, v in bars], RAW)


def catalog(spark, *rows):
    return spark.createDataFrame([("ES", c, kind, e, "CME") for c, kind, e in rows], CATALOG)


def test_open_end_is_an_instant(spark, store):
    now = datetime(2024, 1, 5, 1, tzinfo=timezone.utc)
    assert resolve_range(None, None, now, "Asia/Tokyo").end == datetime(2024, 1, 5, 10)
    assert resolve_range(None, None, now.astimezone(ZoneInfo("America/Chicago")), "Asia/Tokyo").end == datetime(2024, 1, 5, 10)
    assert resolve_range(None, None, now, "America/Chicago").end == datetime(2024, 1, 4, 19)
    with pytest.raises(ValueError):
        resolve_range(None, None, datetime(2024, 1, 5, 1), "Asia/Tokyo")
    listed = catalog(spark, ("ES H4", "Future", date(2024, 3, 15)))
    bars = raw(spark, ("ES H4", datetime(2024, 1, 5, 9, 30), 1), ("ES H4", datetime(2024, 1, 5, 10, 30), 1))
    run = export_series(store, listed, bars, "ES", "minutes", now, date(2024, 1, 1), tz="Asia/Tokyo")
    assert rows_of(run.series, "timestamp") == [(datetime(2024, 1, 5, 0, 30),)]
    assert store.ledger().first()["completed_at"] == datetime(2024, 1, 5, 1)


def test_a_second_day_loads_new_days_only(spark, store):
    listed = catalog(spark, ("ES F4", "Future", date(2024, 1, 3)), ("ES H4", "Future", date(2024, 3, 15)))
    bars = [("ES F4", datetime(2024, 1, 2, 10), 9), *(("ES H4", datetime(2024, 1, d, 10), d) for d in range(2, 9))]
    request = dict(symbol="ES", timeframe="minutes", frm=date(2024, 1, 1))
    first = export_series(store, listed, raw(spark, *bars), now=datetime(2024, 1, 5, 12), **request)
    assert first.series.count() == 4
    # covered to the 4th: the expired contract is finished, the other is asked for the days from the 5th on
    second = export_series(store, listed, raw(spark, *bars, ("ES F4", datetime(2024, 1, 3, 10), 1)), now=datetime(2024, 1, 7, 12), **request)
    assert rows_of(second.contracts, "contract", "covered_end") == [("ES H4", date(2024, 1, 4))]
    assert rows_of(store.ledger().filter("batch_id = 2"), "contract", "bars_count") == [("ES H4", 3)]
    assert second.series.agg(F.max("timestamp")).first()[0] == datetime(2024, 1, 7, 10)


def test_groups_keep_what_came_before_a_failure(spark, store):
    listed = catalog(spark, ("ES H4", "Future", date(2024, 3, 15)), ("ES M4", "Future", date(2024, 4, 20)))
    bars = raw(spark, ("ES H4", datetime(2024, 1, 5, 10), 5), ("ES M4", datetime(2024, 1, 5, 10), 5), ("ES M4", datetime(2024, 1, 6, 10), 5))
    broken = bars.withColumn("open", F.expr("CASE WHEN contract = 'ES M4' THEN double(raise_error('lost')) ELSE open END"))
    request = dict(symbol="ES", timeframe="minutes", now=datetime(2024, 2, 1), frm=date(2024, 1, 5), to=date(2024, 1, 25), group_size=1)
    with pytest.raises(Exception):
        export_series(store, listed, broken, **request)
    assert rows_of(store.ledger(), "contract") == [("ES H4",)]
    again = export_series(store, listed, bars, **request)
    assert rows_of(again.contracts, "contract") == [("ES M4",)]
    assert rows_of(again.series, "contract") == [("ES H4",), ("ES M4",)]


@pytest.mark.parametrize("order", [1, -1])
def test_a_contract_listed_twice(spark, order):
    rows = [("ES H4", "Future", date(2024, 3, 15)), ("ES H4", "Future", date(2024, 9, 15)),
            ("ES H4", "Index", date(2020, 1, 1)), ("ES M4", "Future", date(2024, 6, 15))][::order]
    bars = frame(spark, [bar(T0, 5, "ES M4"), bar(T0, 5, "ES H4")]).drop("expiry")
    assert rows_of(stitch(bars, catalog(spark, *rows)), "contract") == [("ES H4",)]


def test_a_new_checkpoint_is_newer(spark):
    path, out = workspace(spark, "in"), workspace(spark, "out")
    schema = frame(spark, [bar(T0)]).schema

    def send(volume):
        frame(spark, [bar(T0, volume)]).coalesce(1).write.mode("append").parquet(path)

    def run(checkpoint):
        live = stitch_stream(read_stream(spark, path, schema, 1))
        drain(upsert_writer(live, out, checkpoint), 2)
        return rows_of(read_upserts(spark, out, live.schema, KEY), "volume"), live.schema
    first = workspace(spark, "cp")
    for volume in (1, 2, 3):
        send(volume)
        assert run(first)[0] == [(volume,)]
    send(99)
    volumes, schema_out = run(workspace(spark, "cp"))
    assert volumes == [(99,)]
    fold_upserts(spark, out, schema_out, KEY)
    assert rows_of(read_upserts(spark, out, schema_out, KEY), "volume") == [(99,)]
    assert read_upserts(spark, workspace(spark, "nothing"), schema_out, KEY).isEmpty()


def test_range_of_the_last_day(spark):
    now = datetime(2024, 1, 5, 12)
    assert resolve_range(date(2024, 1, 1), None, now).covered_to == (now - timedelta(days=1)).date()
