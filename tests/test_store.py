"""The keyed store, its ledger, and the export request."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.stitch import stitch
from tapeweave.plans.export import export_series, export_timeframes
from tapeweave.schema import BAR_COLUMNS, KEY, LEDGER
from tapeweave.session import workspace
from tapeweave.sources import ledger as led
from tapeweave.sources.store import BarStore

T0, T1 = "2024-01-05 10:00:00", "2024-01-05 10:01:00"


@pytest.fixture
def store(spark):
    return BarStore(spark, workspace(spark, "store"))


def some_rows(seed, n=300, distinct_volume=False):
    rng = random.Random(seed)
    return [bar(f"2024-01-05 10:{rng.randrange(30):02d}:00", i if distinct_volume else rng.randrange(5),
                rng.choice(["ES H4", "ES M4"]), rng.choice(["last", "bid"]), float(rng.randrange(50)),
                symbol=rng.choice(["ES", "NQ"])) for i in range(n)]


def test_empty_store_reads_empty(store):
    assert store.read("ticks").isEmpty() and store.ledger().isEmpty()


def test_incumbent_keeps_ties_and_higher_volume_replaces(spark, store):
    store.merge(frame(spark, [bar(T0, 5), bar(T1, 5)]), "minutes")
    store.merge(frame(spark, [bar(T0, 5, "ES Z3", price=20.0, expiry=date(2023, 12, 15)),
                              bar(T1, 6, "ES Z3", price=20.0, expiry=date(2023, 12, 15))]), "minutes")
    assert rows_of(store.read("minutes"), "unix_ms", "contract")[0][1] == "ES H4"
    assert rows_of(store.read("minutes"), "unix_ms", "contract")[1][1] == "ES Z3"


def test_merge_is_idempotent(spark, store):
    df = frame(spark, some_rows(1))
    store.merge(df, "minutes")
    once = rows_of(store.read("minutes"), *BAR_COLUMNS)
    store.merge(df, "minutes")
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == once == rows_of(stitch(df), *BAR_COLUMNS)


@pytest.mark.parametrize("seed", [2, 3])
def test_any_split_gives_the_same_store(spark, store, seed):
    rows = some_rows(seed, distinct_volume=True)
    random.Random(seed).shuffle(rows)
    for i in range(3):
        store.merge(frame(spark, rows[i::3]), "minutes")
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == rows_of(stitch(frame(spark, rows)), *BAR_COLUMNS)


def test_timeframes_are_separate(spark, store):
    store.merge(frame(spark, [bar(T0)]), "minutes")
    assert store.read("days").isEmpty() and store.read("minutes").count() == 1
    assert rows_of(store.summary("ES"), "timeframe", "bar_count") == [("days", 0), ("minutes", 1), ("ticks", 0)]


def test_commit_key_is_merged_once(spark, store):
    df = frame(spark, [bar(T0)])
    assert store.merge(df, "minutes", commit_key="q-0") == 1
    assert store.merge(df, "minutes", commit_key="q-0") is None
    assert store.ledger().count() == 1


def test_batch_without_ledger_rows_is_invisible(spark, store):
    store.merge(frame(spark, [bar(T0, 5)]), "minutes")
    store._write(frame(spark, [bar(T0, 99), bar(T1, 99)]).select(BAR_COLUMNS), "minutes", "crashed")
    assert rows_of(store.read("minutes"), "volume") == [(5,)]


def test_replace_touches_one_symbol_and_timeframe(spark, store):
    both = frame(spark, [bar(T0, 5), bar(T0, 5, "NQ H4", symbol="NQ")])
    store.merge(both, "minutes")
    store.merge(both, "days")
    store.replace(frame(spark, [bar(T1, 1)]), "minutes", frm=date(2024, 1, 5), to=date(2024, 1, 5))
    assert rows_of(store.read("minutes"), "symbol", "volume") == [("ES", 1), ("NQ", 5)]
    assert store.read("days").count() == 2
    live = store.live_ledger()
    assert rows_of(live.filter("table_name = 'minutes'"), "symbol", "generation") == [("ES", 2), ("NQ", 1)]


def test_compact_keeps_rows_and_marks(spark, store):
    for i in range(3):
        store.merge(frame(spark, some_rows(i)), "minutes", frm=date(2024, 1, i + 1), to=date(2024, 1, i + 1))
    before, marks = rows_of(store.read("minutes"), *BAR_COLUMNS), rows_of(store.live_ledger(), *led.LEDGER_KEY, "bars_count")
    store.compact("minutes")
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == before
    assert rows_of(store.live_ledger(), *led.LEDGER_KEY, "bars_count") == marks
    assert store.live_ledger().select("batch").distinct().count() == 1
    plan = store.read("minutes")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_store_from_before_the_contract_column(spark, store):
    store.merge(frame(spark, [bar(T0, 5)]), "minutes")
    old = frame(spark, [bar(T1, 5)]).select(*[c for c in BAR_COLUMNS if c != "contract"])
    old.drop("symbol").write.parquet(f"{store.path}/bars/timeframe=minutes/batch=before/symbol=NQ")
    assert store.adopt("minutes", "before") == 2
    assert rows_of(store.ledger(), "symbol", "contract", "bars_count") == [("ES", "ES H4", 1), ("NQ", "", 1)]
    assert rows_of(store.read("minutes"), "symbol", "contract") == [("ES", "ES H4"), ("NQ", "")]


def test_odd_symbols_survive_folders(spark, store):
    names = ["001", "a/b", 'say "x"', "ünï", "x=y", "c,d", "%41"]
    store.merge(frame(spark, [bar(T0, 1, symbol=n) for n in names]), "minutes")
    assert [r[0] for r in rows_of(store.read("minutes"), "symbol")] == sorted(names)
    assert store.read("minutes", "001").count() == 1


def test_files_prune_by_symbol_range_and_key(spark, store):
    for i in range(2):
        store.merge(frame(spark, some_rows(i)), "minutes")
    files = store.read("minutes", "ES").inputFiles()
    assert files and all("symbol=ES" in f for f in files)
    plan = store.read("minutes", "ES").filter("unix_ms > 5")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(unix_ms,5)" in plan
    assert store.read("minutes", start="2024-01-06").inputFiles() == []
    some = store.read("minutes", start="2024-01-05 10:05:00", end="2024-01-05 10:07:00")
    assert rows_of(some, *BAR_COLUMNS) == rows_of(store.read("minutes").filter("minute(timestamp) BETWEEN 5 AND 7"), *BAR_COLUMNS)


def ledger_of(spark, *rows):
    base = [("ES", "ES H4", "ticks", date.fromisoformat(a), date.fromisoformat(b), n, datetime(2024, 2, day), bid, "x", 1, None)
            for a, b, n, day, bid in rows]
    return spark.createDataFrame(base, LEDGER)


def covers(spark, ledger, frm, to):
    contracts = spark.createDataFrame([("ES", "ES H4")], "symbol string, contract string")
    return led.pending(contracts, ledger, "ticks", date.fromisoformat(frm), date.fromisoformat(to)).isEmpty()


def test_coverage_needs_one_containing_row(spark):
    adjoining = ledger_of(spark, ("2024-01-01", "2024-01-14", 5, 1, 1), ("2024-01-15", "2024-01-31", 5, 1, 1))
    assert not covers(spark, adjoining, "2024-01-10", "2024-01-20")
    assert covers(spark, adjoining, "2024-01-02", "2024-01-14")
    assert covers(spark, ledger_of(spark, ("2024-01-01", "2024-01-31", 0, 1, 1)), "2024-01-01", "2024-01-31")
    assert not covers(spark, ledger_of(spark, ("2024-01-01", "2024-01-31", 0, 1, 1)), "2024-01-01", "2024-02-01")


def test_coverage_sums_latest_marks(spark):
    ledger = ledger_of(spark, ("2024-01-01", "2024-01-31", 5, 1, 1), ("2024-01-01", "2024-01-31", 7, 2, 2),
                       ("2023-12-01", "2024-02-28", 10, 1, 1))
    row = led.coverage(ledger, "ticks", date(2024, 1, 2), date(2024, 1, 3)).first()
    assert (row["prior_bars"], row["ledger_rows"]) == (17, 2)


def test_remarked_key_does_not_hide_the_earlier_batch(spark, store):
    request = {"frm": date(2024, 1, 5), "to": date(2024, 1, 5)}
    store.merge(frame(spark, [bar(T0, 5)]), "minutes", **request)
    store.merge(frame(spark, [bar(T1, 5)]), "minutes", **request)
    assert store.read("minutes").count() == 2
    assert led.ledger_latest(store.live_ledger()).count() == 1


RAW = ("symbol string, contract string, price_type string, time timestamp_ntz, open double, high double, "
       "low double, close double, volume double")
CATALOG = [("ES", "ES Z3", "Future", date(2023, 12, 4), "CME"), ("ES", "ES H4", "Future", date(2024, 3, 15), "CME"),
           ("ES", "ES M4", "Future", date(2024, 4, 25), "CME"), ("ES", "ES U4", "Future", date(2024, 9, 20), "CME"),
           ("ES", "ES K4", "Future", date(2024, 4, 1), "CME"), ("ES", "ES", "Index", date(2024, 3, 15), "CME")]


def export_inputs(spark):
    catalog = spark.createDataFrame(CATALOG, "symbol string, contract string, instrument_type string, expiry date, exchange string")
    rows = [("ES", c, "last", datetime(2024, 1, d, 10), 1.0, 2.0, 0.5, 1.5, float(v))
            for c, d, v in (("ES H4", 5, 10), ("ES M4", 5, 2), ("ES M4", 6, 3), ("ES Z3", 5, 99), ("ES U4", 5, 99),
                            ("ES H4", 26, 10), ("ES H4", 4, 10))]
    return catalog, spark.createDataFrame(rows, RAW)


def test_export_request(spark, store):
    catalog, raw = export_inputs(spark)
    request = dict(symbol=" es ", timeframe="minutes", now=datetime(2024, 2, 1), frm=date(2024, 1, 5), to=date(2024, 1, 25))
    first = export_series(store, catalog, raw, tz="America/Chicago", formats=("csv", "parquet"),
                          out=workspace(spark, "out"), **request)
    assert rows_of(first.series, "contract", "volume") == [("ES H4", 10), ("ES M4", 3)]
    assert first.series.agg(F.min("timestamp")).first()[0] == datetime(2024, 1, 5, 16)
    assert rows_of(first.steps, "contracts_processed", "contracts_skipped") == [(3, 0)]
    assert rows_of(store.ledger(), "contract", "bars_count") == [("ES H4", 1), ("ES K4", 0), ("ES M4", 2)]
    assert set(first.outputs) == {"csv", "parquet"}
    summary = first.summary.first()
    assert (summary["staged_rows"], summary["final_rows"]) == (3, 2)

    narrower = dict(request, frm=date(2024, 1, 6))
    again = export_series(store, catalog, raw, **narrower)
    assert again.batch_id is None and rows_of(again.steps, "contracts_skipped") == [(3,)]
    wider = export_series(store, catalog, raw, **dict(request, to=date(2024, 1, 26)))
    assert wider.batch_id == 2
    replaced = export_series(store, catalog, raw, replace=True, **narrower)
    assert rows_of(replaced.series, "contract", "volume") == [("ES M4", 3)]
    assert replaced.contracts.count() == 3


def test_open_ended_run_is_repeated_the_same_day(spark, store):
    catalog, raw = export_inputs(spark)
    request = dict(symbol="ES", timeframe="minutes", now=datetime(2024, 2, 1, 12), frm=date(2024, 1, 5))
    assert export_series(store, catalog, raw, **request).batch_id == 1
    assert export_series(store, catalog, raw, **request).batch_id == 2


def test_failed_run_marks_nothing(spark, store):
    catalog, raw = export_inputs(spark)
    broken = raw.withColumn("open", F.expr("CASE WHEN volume = 3 THEN double(raise_error('lost')) ELSE open END"))
    with pytest.raises(Exception):
        export_series(store, catalog, broken, "ES", "minutes", datetime(2024, 2, 1), date(2024, 1, 5), date(2024, 1, 25))
    assert store.ledger().isEmpty() and store.read("minutes").isEmpty()


def test_failing_timeframe_does_not_stop_the_next(spark, store):
    catalog, raw = export_inputs(spark)
    broken = raw.withColumn("open", F.expr("double(raise_error('lost'))"))
    done, failed = export_timeframes(store, catalog, {"days": raw, "minutes": broken}, "ES", datetime(2024, 2, 1),
                                     frm=date(2024, 1, 5), to=date(2024, 1, 25))
    assert set(done) == {"days"} and set(failed) == {"minutes"}
    assert rows_of(store.ledger().select("table_name").distinct(), "table_name") == [("days",)]


def test_export_range_only(spark, store):
    catalog, raw = export_inputs(spark)
    request = dict(symbol="ES", timeframe="minutes", now=datetime(2024, 2, 1), tz="America/Chicago")
    export_series(store, catalog, raw, frm=date(2024, 1, 5), to=date(2024, 1, 26), **request)
    out = export_series(store, catalog, raw, frm=date(2024, 1, 5), to=date(2024, 1, 5), formats=("parquet",),
                        out=workspace(spark, "out"), range_only=True, **request).outputs["parquet"]
    from tapeweave.sources.sinks import read_parquet_export
    assert rows_of(read_parquet_export(spark, out), "contract", "timestamp") == [("ES H4", datetime(2024, 1, 5, 16))]


def test_blank_symbol_is_refused(spark, store):
    catalog, raw = export_inputs(spark)
    with pytest.raises(ValueError):
        export_series(store, catalog, raw, "  ", "minutes", datetime(2024, 2, 1))


def test_key_columns(spark, store):
    store.merge(frame(spark, some_rows(5)), "ticks")
    df = store.read("ticks")
    assert df.columns == BAR_COLUMNS and df.groupBy(*KEY).count().filter("count > 1").isEmpty()
