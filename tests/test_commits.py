"""Commit log, key ranges, tiers, cleared ranges, and writers at the same time."""

import math
import os
import random
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.stitch import stitch
from tapeweave.schema import BAR_COLUMNS
from tapeweave.session import workspace
from tapeweave.sources import commits, key_ranges
from tapeweave.sources.commits import File, Hole, publish
from tapeweave.sources.store import BarStore

T0 = "2024-01-05 10:00:00"


@pytest.fixture
def store(spark):
    return BarStore(spark, workspace(spark, "store"))


def day(d, volume=5, hours=3, **more):
    return [bar(f"2024-01-{d:02d} {h:02d}:00:00", volume, **more) for h in range(hours)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def file(path, low, high, run, streams=("last",), symbol="ES", rows=1):
    return File(path, "days", symbol, "b", run, streams, low, high, rows, 1)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 10), st.integers(1, 4), st.sampled_from(["last", "bid"])), max_size=25))
@settings(max_examples=300, deadline=None)
def test_overlapping_files_equal_all_pairs(spans):
    files = [file(str(i), a, a + n, run, (s,)) for i, (a, n, run, s) in enumerate(spans)]
    want = {f.path for f in files for g in files if f.run != g.run and f.streams == g.streams and f.low <= g.high and g.low <= f.high}
    assert key_ranges.overlapping(files) == want


def test_holes_hide_older_runs():
    f = file("a", 10, 20, 3)
    hole = Hole("days", "ES", 5, 15, 4)
    assert key_ranges.holes_of(f, [hole]) == (False, True)
    assert key_ranges.holes_of(f, [Hole("days", "ES", 10, 20, 4)]) == (True, True)
    assert key_ranges.holes_of(file("a", 10, 20, 4), [hole]) == (False, False)
    assert key_ranges.holes_of(file("a", 10, 20, 3, symbol="NQ"), [hole]) == (False, False)


def test_tiers_are_due_by_size_and_never_cross_a_hole():
    runs = [file(str(i), 0, 9, i, rows=r) for i, r in enumerate([100, 4, 5, 1, 1, 1, 1])]
    assert {f.path for f in key_ranges.due(runs, [], 4)} == {"3", "4", "5", "6"}
    assert key_ranges.due(runs[:-1], [], 4) == []
    assert key_ranges.due(runs, [Hole("days", "ES", 0, 1, 5)], 4) == []


@pytest.mark.parametrize("fan", [2, 4])
def test_rows_rewritten_by_tiers_grow_as_n_log_n(fan):
    """50, 500 and 5000 merges of one row each, counted without Spark."""
    for n in (50, 500, 5000):
        live: list[File] = []
        moved = 0
        for i in range(n):
            live.append(file(str(i), 0, 9, i + 1))
            while taken := key_ranges.due(live, [], fan):
                moved += sum(f.rows for f in taken)
                live = [f for f in live if f not in taken]
                live.append(file(f"c{i}-{len(live)}", 0, 9, min(f.run for f in taken), rows=sum(f.rows for f in taken)))
        assert moved <= n * (math.log(n, fan) + 1) and len(live) <= fan * (math.log(n, fan) + 1)


def test_publish_creates_only_if_absent(spark):
    path = workspace(spark, "log") + "/commits/1.json"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if publish(spark, path, str(i)) else None) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and open(path.removeprefix("file:")).read() == str(won[0])
    assert os.listdir(os.path.dirname(path.removeprefix("file:"))) == ["1.json"]


def test_disjoint_merges_are_read_without_ranking(spark, store):
    store.merge(frame(spark, day(3)), "minutes")
    store.merge(frame(spark, day(4)), "minutes")
    df = store.read("minutes")
    assert "Window" not in plan(df) and df.count() == 6
    store.merge(frame(spark, day(4, 9)), "minutes")
    df = store.read("minutes")
    assert "Window" in plan(df)
    assert rows_of(df, "volume") == [(5,)] * 3 + [(9,)] * 3
    assert "Window" not in plan(store.read("minutes", end="2024-01-03 23:59:59"))


def test_streams_of_one_time_do_not_meet(spark, store):
    store.merge(frame(spark, day(3)), "minutes")
    store.merge(frame(spark, day(3, price_type="bid")), "minutes")
    assert "Window" not in plan(store.read("minutes")) and store.read("minutes").count() == 6


def test_two_writers_at_once_both_survive(spark, store):
    others = [BarStore(spark, store.path) for _ in range(4)]
    frames = [frame(spark, day(3 + i) + day(20, 5 + i)) for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda s, f: s.merge(f, "minutes", frm=date(2024, 1, 1), to=date(2024, 1, 9)), others, frames))
    assert sorted(numbers) == [1, 2, 3, 4]
    assert sorted(r["batch_id"] for r in store.ledger().select("batch_id").distinct().collect()) == [1, 2, 3, 4]
    everything = stitch(frame(spark, [r for i in range(4) for r in day(3 + i) + day(20, 5 + i)]))
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == rows_of(everything, *BAR_COLUMNS)


def test_one_commit_key_from_two_writers_is_merged_once(spark, store):
    others = [BarStore(spark, store.path) for _ in range(3)]
    with ThreadPoolExecutor(3) as pool:
        numbers = list(pool.map(lambda s: s.merge(frame(spark, day(3)), "minutes", commit_key="q-7"), others))
    assert sorted(numbers, key=str) == [1, None, None] and store.ledger().count() == 1


def interrupted(store, monkeypatch, act):
    """Let ``act`` commit right before the next commit of ``store`` takes its number."""
    real, waiting = commits.publish, [act]

    def first(spark, path, text):
        if waiting:
            waiting.pop()()
        return real(spark, path, text)
    monkeypatch.setattr(commits, "publish", first)


def test_a_merge_joins_the_generation_of_a_replacement_before_it(spark, store, monkeypatch):
    store.merge(frame(spark, day(3)), "minutes")
    other = BarStore(spark, store.path)
    interrupted(store, monkeypatch, lambda: other.replace(frame(spark, day(4)), "minutes"))
    assert store.merge(frame(spark, day(5)), "minutes") == 3
    assert rows_of(store.read("minutes").select(F.dayofmonth("timestamp").alias("d")).distinct(), "d") == [(4,), (5,)]
    assert rows_of(store.live_ledger(), "batch_id", "generation") == [(2, 2), (3, 2)]


def test_a_replacement_removes_what_was_merged_meanwhile(spark, store, monkeypatch):
    store.merge(frame(spark, day(3)), "minutes")
    other = BarStore(spark, store.path)
    interrupted(store, monkeypatch, lambda: other.merge(frame(spark, day(4)), "minutes"))
    assert store.replace(frame(spark, day(5)), "minutes") == 3
    assert rows_of(store.read("minutes").select(F.dayofmonth("timestamp").alias("d")).distinct(), "d") == [(5,)]


def test_a_compaction_keeps_what_was_merged_meanwhile(spark, store, monkeypatch):
    for v in (1, 2):
        store.merge(frame(spark, day(3, v)), "minutes", frm=date(2024, 1, 3), to=date(2024, 1, 3))
    other = BarStore(spark, store.path)
    late = frame(spark, day(3, 2, price=99.0) + day(4, 9))
    interrupted(store, monkeypatch, lambda: other.merge(late, "minutes", frm=date(2024, 1, 4), to=date(2024, 1, 4)))
    assert store.compact("minutes") == 4
    # the compacted bars keep their place before the later merge, so a tie leaves them
    assert rows_of(store.read("minutes"), "volume", "open") == [(2, 10.0)] * 3 + [(9, 10.0)] * 3
    assert store.live_ledger().select("from_date").distinct().count() == 2


def test_a_compaction_starts_again_when_its_files_are_gone(spark, store, monkeypatch):
    for v in (1, 2):
        store.merge(frame(spark, day(3, v)), "minutes")
    other = BarStore(spark, store.path)
    interrupted(store, monkeypatch, lambda: other.replace(frame(spark, day(3, 1, hours=1)), "minutes"))
    store.compact("minutes")
    assert rows_of(store.read("minutes"), "volume") == [(1,)]


def test_merges_with_tiers_equal_one_merge(spark):
    store = BarStore(spark, workspace(spark, "store"), fan=2)
    rng = random.Random(4)
    rows = [bar(f"2024-01-{rng.randrange(3, 9):02d} {rng.randrange(24):02d}:00:00", i, price=float(i)) for i in range(160)]
    for i in range(8):
        store.merge(frame(spark, rows[i * 20:(i + 1) * 20]), "minutes")
    assert rows_of(store.read("minutes"), *BAR_COLUMNS) == rows_of(stitch(frame(spark, rows)), *BAR_COLUMNS)
    assert len({f.run for f in store.log.snapshot().live("minutes")}) <= 4


def test_tiers_renumber_files_that_meet_no_other(spark, store):
    for d in (3, 4, 5, 6):
        store.merge(frame(spark, day(d)), "minutes")
    before = {f.path for f in store.log.snapshot().live("minutes")}
    assert store.compact_tiers("minutes", 4) == 0
    after = store.log.snapshot().live("minutes")
    assert {f.path for f in after} == before and {f.run for f in after} == {1}
    store.merge(frame(spark, day(3, 9)), "minutes")
    assert rows_of(store.read("minutes").filter("day(timestamp) = 3"), "volume") == [(9,)] * 3
    assert store.vacuum() == 0 and store.read("minutes").count() == 12


def test_replace_range_clears_keys_and_nothing_else(spark, store):
    store.merge(frame(spark, day(3) + day(4) + day(5) + day(4, symbol="NQ")), "minutes")
    number = store.replace_range(frame(spark, [bar("2024-01-04 01:00:00", 1, price=3.0), bar("2024-01-09 00:00:00", 1)]), "minutes",
                                 "2024-01-04", "2024-01-04 23:59:59", frm=date(2024, 1, 4), to=date(2024, 1, 4))
    want = [("ES", d, h, 5) for d in (3, 5) for h in range(3)] + [("ES", 4, 1, 1), ("ES", 9, 0, 1)] + [("NQ", 4, h, 5) for h in range(3)]

    def seen():
        return rows_of(store.read("minutes").select("symbol", F.dayofmonth("timestamp").alias("d"), F.hour("timestamp").alias("h"), "volume"), "symbol", "d", "h", "volume")
    assert number == 2 and seen() == sorted(want)
    # a later merge fills the cleared keys again, and a tie there is won by the replacement
    store.merge(frame(spark, [bar("2024-01-04 02:00:00", 1, price=7.0), bar("2024-01-04 01:00:00", 1, price=7.0)]), "minutes")
    want = sorted(want + [("ES", 4, 2, 1)])
    assert seen() == want
    assert store.compact_tiers("minutes", 2) >= 0 and seen() == want
    store.compact("minutes")
    assert seen() == want and store.log.snapshot().holes == ()
    with pytest.raises(ValueError):
        store.replace_range(frame(spark, day(3)), "minutes", "2024-01-04", "2024-01-03")


def test_replace_range_without_bars(spark, store):
    store.merge(frame(spark, day(3) + day(4)), "minutes")
    store.replace_range(frame(spark, day(3)).limit(0), "minutes", "2024-01-03", "2024-01-03 23:59:59", symbols=["ES"])
    assert rows_of(store.read("minutes").select(F.dayofmonth("timestamp").alias("d")).distinct(), "d") == [(4,)]
    assert store.read("minutes", "ES", "2024-01-03", "2024-01-03 12:00:00").isEmpty()


def test_checkpoints_change_nothing_and_start_new_readers(spark, store):
    store.merge(frame(spark, day(3) + day(4)), "minutes", commit_key="a")
    store.replace_range(frame(spark, day(3, 1, hours=1)), "minutes", "2024-01-03", "2024-01-03 23:59:59")
    before = rows_of(store.read("minutes"), *BAR_COLUMNS)
    marks = rows_of(store.ledger(), "symbol", "batch_id")
    for _ in range(3):
        store.compact_ledger()
    fresh = BarStore(spark, store.path)
    assert rows_of(fresh.read("minutes"), *BAR_COLUMNS) == before and rows_of(fresh.ledger(), "symbol", "batch_id") == marks
    assert fresh.log.snapshot() .holes == store.log.snapshot().holes and len(fresh.log.snapshot().folders) == 1
    assert fresh.merge(frame(spark, day(3)), "minutes", commit_key="a") is None
    fresh.merge(frame(spark, day(9)), "minutes")
    assert store.read("minutes").count() == len(before) + 3
    assert BarStore(spark, store.path).read("minutes").count() == len(before) + 3


def test_a_commit_deleted_while_it_is_read_is_looked_for_again(spark, store, monkeypatch):
    for d in (3, 4, 5):
        store.merge(frame(spark, day(d)), "minutes")
    fresh, other = BarStore(spark, store.path), BarStore(spark, store.path)
    real, waiting = fresh.log._commit, [True]

    def late(version):
        if waiting:
            waiting.pop()
            for _ in range(3):  # the third one forgets what the first one replaced
                other.compact_ledger()
        return real(version)
    monkeypatch.setattr(fresh.log, "_commit", late)
    assert fresh.read("minutes").count() == 9 and fresh.ledger().count() == 3


def test_commits_beside_a_checkpoint_are_not_lost(spark, store, monkeypatch):
    store.merge(frame(spark, day(3)), "minutes")
    other = BarStore(spark, store.path)
    interrupted(store, monkeypatch, lambda: other.merge(frame(spark, day(4)), "minutes"))
    store.compact_ledger()
    for s in (store, other, BarStore(spark, store.path)):
        assert s.read("minutes").count() == 6 and s.ledger().count() == 2


def test_a_writer_that_dies_leaves_nothing(spark, store, monkeypatch):
    store.merge(frame(spark, day(3)), "minutes")

    def dies(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(commits, "publish", dies)
    with pytest.raises(RuntimeError):
        store.merge(frame(spark, day(3, 9)), "minutes")
    monkeypatch.undo()
    assert rows_of(store.read("minutes"), "volume") == [(5,)] * 3
    assert store.merge(frame(spark, day(3, 7)), "minutes") == 2 and rows_of(store.read("minutes"), "volume") == [(7,)] * 3


def test_no_work_table_is_left(spark, store):
    folder = os.path.dirname(store.path.removeprefix("file:"))
    before = set(os.listdir(folder))
    store.merge(frame(spark, day(3)), "minutes")
    store.merge(frame(spark, day(3).copy()).withColumn("volume", F.lit(None).cast("bigint")), "minutes")
    assert set(os.listdir(folder)) == before | {os.path.basename(store.path)}
    assert store.rejects("minutes").count() == 3


def test_work_tables_of_an_application_are_cleared(spark, tmp_path, monkeypatch):
    import tapeweave.session as ses
    monkeypatch.setattr(ses, "shared_dir", lambda _: str(tmp_path))
    ses.written(spark.range(3), "numbers")
    (tmp_path / "tapeweave" / "another-application").mkdir()
    assert ses.clear_workspace(spark) and not ses.clear_workspace(spark)
    assert os.listdir(tmp_path / "tapeweave") == ["another-application"]


def test_the_zone_is_not_changed_silently(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            BarStore(spark, workspace(spark, "store"))
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_counts_come_from_the_log(spark, store):
    a = store.merge(frame(spark, day(3) + day(3) + day(4, price_type="bid")), "minutes")
    b = store.merge(frame(spark, day(3, 9)), "minutes")
    assert rows_of(store.staged([a, b]), "symbol", "price_type", "staged_rows") == [("ES", "bid", 3), ("ES", "last", 6)]
    assert rows_of(store.staged([b]), "staged_rows") == [(3,)] and store.refused("minutes", [a, b]).isEmpty()
    assert {datetime(2024, 1, 3)} == {r[0] for r in store.read("minutes", start="2024-01-03", end="2024-01-03").select("timestamp").collect()}
