"""Catalog, inventory, audits, coverage, stop rule, probe."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave import fixtures as fx
from tapeweave.operators import catalog as oc
from tapeweave.operators import coverage as ov
from tapeweave.operators import inspect as oi
from tapeweave.operators.resample import resample
from tapeweave.operators.stitch import stitch
from tapeweave.plans.backfill import backfill
from tapeweave.session import join_dim

CATALOG = "symbol string, contract string, instrument_type string, expiry date, exchange string"


def catalog(spark, *expiries, kind="Future"):
    return spark.createDataFrame([("ES", f"ES {d}", kind, date.fromisoformat(d), "CME") for d in expiries], CATALOG)


@pytest.mark.parametrize("expiry, kept", [("2023-12-04", False), ("2023-12-05", True), ("2024-04-25", True),
                                          ("2024-04-26", False)])
def test_expiry_window_edges(spark, expiry, kept):
    got = oc.prune_contracts(catalog(spark, expiry), date(2024, 1, 5), date(2024, 1, 25))
    assert (got.count() == 1) == kept


def test_expiry_window_clamps_month_ends(spark):
    got = oc.prune_contracts(catalog(spark, "2024-02-29", "2024-03-01", "2024-06-30", "2024-07-01"),
                             date(2024, 3, 31), date(2024, 3, 31))
    assert sorted(r[1] for r in got.collect()) == ["ES 2024-02-29", "ES 2024-03-01", "ES 2024-06-30"]


def test_listing_is_by_expiry_and_futures_only(spark):
    df = catalog(spark, "2024-06-21", "2024-03-15").unionAll(catalog(spark, "2024-01-01", kind="Stock"))
    assert [r["expiry_iso"] for r in oc.list_instruments(df, "ES").collect()] == ["2024-03-15", "2024-06-21"]
    assert oc.list_instruments(df, "es").isEmpty()


def test_inventory_lists_contracts_without_bars(spark):
    bars = frame(spark, [bar("2024-01-05 10:00:00", contract="ES 2024-03-15"),
                         bar("2024-01-06 10:00:00", contract="ES 2024-03-15"),
                         bar("2024-01-07 10:00:00", contract="ES 2024-03-15", price_type="bid")])
    got = oi.inventory(bars, catalog(spark, "2024-03-15", "2024-06-21"), "ES").collect()
    assert [(r["bar_count"], r["first_bar_iso"], r["last_bar_iso"]) for r in got] == [
        (2, "2024-01-05T10:00:00.0000000Z", "2024-01-06T10:00:00.0000000Z"), (0, None, None)]


def test_roll_shows_front_then_back(spark):
    rows = []
    for day in range(1, 31):
        front, back = max(1, 100 - 4 * day), 4 * day
        rows += [bar(f"2024-06-{day:02d} 10:00:00", front, "ES M4", expiry=date(2024, 6, 21)),
                 bar(f"2024-06-{day:02d} 10:00:00", back, "ES U4", expiry=date(2024, 9, 20))]
    audit = oi.roll_audit(stitch(frame(spark, rows)), "ES", "2024-06-01", "2024-07-01").collect()
    assert [r["contract"] for r in audit] == ["ES M4", "ES U4"]
    assert audit[0]["max_ts"] < audit[1]["min_ts"] and audit[0]["bars"] + audit[1]["bars"] == 30


def test_fetch_guard_and_bounds(spark):
    bars = frame(spark, [bar(f"2024-01-{d:02d}") for d in (1, 2, 3)] + [bar("2024-01-02", contract="ES M4")])
    got = oi.fetch_bars(bars, "ES H4", "Minute", 1, "2024-01-01", "2024-01-02")
    assert [r["timestamp_iso"][:10] for r in got.collect()] == ["2024-01-01", "2024-01-02"]
    assert oi.fetch_bars(bars, "ES H4", "Minute", 1, "2024-01-01T00:00:00+05:00", "2024-01-01T05:00:00+05:00").count() == 1
    with pytest.raises(ValueError, match="page"):
        oi.fetch_bars(bars, "ES H4", "Tick", 1, "2024-01-01", "2024-01-03")
    assert oi.fetch_bars(bars, "ES H4", "Tick", 1, "2024-01-01", "2024-01-03", max_days=9).count() == 3
    with pytest.raises(ValueError):
        oi.fetch_bars(bars, "ES H4", "Day", 1, "2024-01-02", "2024-01-02")


@pytest.mark.parametrize("inside, outside, reported", [(9, 1, False), (8, 1, True), (3, 0, False)])
def test_diagnostics_threshold(spark, inside, outside, reported):
    rows = [bar(f"2024-01-05 10:{i:02d}:00") for i in range(inside)] + [bar(f"2023-01-05 10:{i:02d}:00") for i in range(outside)]
    row = oi.range_diagnostics(frame(spark, rows), "2024-01-01", "2024-02-01").first()
    assert (row["kept_bars"], row["filtered_bars"], row["reported"]) == (inside, outside, reported)


def test_summary_reports_absent_timeframes(spark):
    got = oi.store_summary({"days": frame(spark, [bar("2024-01-05")])}).collect()
    assert [(r["timeframe"], r["bar_count"]) for r in got] == [("days", 1), ("minutes", 0), ("ticks", 0)]


def walk(counts, limit):
    """The chunk walk as a plain loop."""
    run = done = bars = 0
    for n in counts:
        done, bars = done + 1, bars + n
        run = 0 if n else run + 1
        if run >= limit:
            return "stopped_no_data", done, bars, run
    return "complete", done, bars, run


@pytest.mark.parametrize("counts, limit", [
    ([1, 0, 0, 1, 0, 0, 0, 1], 3), ([0, 0, 1, 0, 0], 3), ([0, 0, 0, 5], 3), ([1, 1, 1], 1), ([0, 1], 1),
    ([1, 0, 1, 0], 0), ([0] * 5, 9), ([2, 0, 0, 0], 3)])
def test_stop_rule(spark, counts, limit):
    rows = [bar(f"2024-01-{i + 1:02d} 10:00:{k:02d}") for i, n in enumerate(counts) for k in range(n)]
    rows.append(bar("2030-01-01"))
    series = spark.createDataFrame([("ES", "ES H4", "last")], "symbol string, contract string, price_type string")
    end = datetime(2024, 1, 1) + timedelta(days=len(counts))
    got = ov.backfill_plan(ov.chunk_coverage(frame(spark, rows), series, datetime(2024, 1, 1), end, 1), limit).first()
    assert (got["status"], got["chunks_done"], got["bars_downloaded"], got["consecutive_empty"]) == walk(counts, max(1, limit))
    assert got["chunks_total"] == len(counts)


def test_backfill_request_uses_the_period_chunk(spark):
    contracts = catalog(spark, "2024-03-15")
    bars = frame(spark, [bar("2024-01-03", contract="ES 2024-03-15"), bar("2024-01-28", contract="ES 2024-03-15")])
    got = backfill(bars, contracts, "Minute", 1, "2024-01-01", "2024-01-30").first()
    assert (got["chunks_total"], got["chunks_done"], got["status"]) == (5, 5, "complete")
    assert got["first_data_at"] == datetime(2024, 1, 3) and got["last_data_at"] == datetime(2024, 1, 28)


def test_probe_against_each_window(spark):
    rng = random.Random(4)
    now = datetime(2024, 2, 1)
    times = [now - timedelta(seconds=rng.randrange(4000 * 86_400)) for _ in range(2000)]
    times += [now - timedelta(days=d) for d, _ in ((1, 0), (2, 0), (7, 0), (730, 0))]
    ticks = frame(spark, [bar(t.isoformat(), contract="ES 2024-03-15", seq=i) for i, t in enumerate(times)])
    tables = {"ticks": ticks, "days": resample(ticks, "Day", 1)}
    results = ov.probe_results(tables, catalog(spark, "2024-03-15"), now).collect()
    assert len(results) == 25
    for r in results:
        if r["granularity"] == "Tick1":
            start = now - timedelta(days=dict(ov.LOOKBACKS)[r["lookback"]], hours=4)
            assert r["probe_start"] == start
            assert r["bars"] == sum(start <= t <= start + timedelta(hours=4) for t in times)
        if r["granularity"] == "Minute1":
            assert r["bars"] == 0
    rolled = {r["granularity"]: r for r in ov.probe_availability(ov.probe_results(
        tables, catalog(spark, "2024-03-15"), now, period_types=["tick", "Day1"])).collect()}
    assert set(rolled) == {"Tick1", "Day1"} and rolled["Tick1"]["probes_run"] == 7 and rolled["Day1"]["probes_run"] == 9
    with pytest.raises(ValueError):
        ov.probe_results(tables, catalog(spark, "2024-03-15"), now, period_types=["Week"])


def test_probe_has_no_range_join_and_pushes_the_windows(spark, sf_dir):
    from tapeweave import fixtures as fx
    bars = fx.day_bars(spark, sf_dir)
    out = ov.probe_results({"days": bars}, fx.instruments(spark, sf_dir), datetime(2001, 1, 1), period_types=["Day"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dimension_join_small_and_salted(spark, how):
    fact = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 40)))
                                       .alias("contract"), F.col("id").alias("unix_ms"))
    dim = spark.range(0, 30).select(F.concat(F.lit("c"), "id").alias("contract"), F.col("id").alias("rank"))
    dim = dim.unionAll(spark.createDataFrame([("hot", 99)], "contract string, rank bigint"))
    small = join_dim(fact, dim, ["contract"], how, spread=["unix_ms"])
    salted = join_dim(fact, dim, ["contract"], how, spread=["unix_ms"], rows=10)
    plain = join_dim(fact, dim, ["contract"], how, rows=10)
    want = rows_of(small.fillna(-1), *small.columns)
    assert rows_of(salted.fillna(-1), *small.columns) == want == rows_of(plain.fillna(-1), *small.columns)


def test_contract_steps(spark):
    contracts = catalog(spark, "2024-03-15", "2024-06-21", "2024-09-20")
    got = oi.contract_steps(contracts, contracts.filter("contract like '%03-15'")).first()
    assert (got["contracts_processed"], got["contracts_skipped"]) == (1, 2)


@pytest.mark.parametrize("now", [datetime(2024, 2, 1), datetime(2024, 1, 20, 7, 30, 15)])
def test_probe_of_ticks_equals_the_probe_of_their_bars(spark, sf_dir, now):
    ticks, contracts = fx.ticks(spark, sf_dir), fx.instruments(spark, sf_dir).filter("instrument_type = 'Future'")
    tables = {"ticks": ticks, "minutes": resample(ticks, "Minute", 1), "days": resample(ticks, "Day", 1)}
    for kinds in (None, ["Day", "Tick"]):
        want = ov.probe_results(tables, contracts, now, period_types=kinds)
        got = ov.probe_ticks(ticks, contracts, now, period_types=kinds)
        assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    assert want.filter("bars > 0").count() > 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 4
