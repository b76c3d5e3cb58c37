"""Audited streams: used and late rows add up, bars equal their batch twins, restarts change nothing."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bar, frame, rows_of
from tapeweave.operators.resample import resample, tick_bars
from tapeweave.operators.stitch import stitch
from tapeweave.schema import BAR_COLUMNS, KEY
from tapeweave.session import workspace
from tapeweave.streaming import audited
from tapeweave.streaming.files import drain, read_stream, read_upserts, upsert_writer
from tapeweave.streaming.series import stitch_stream


def ticks(seed, n=240, minutes=300):
    rng = random.Random(seed)
    at = sorted(rng.randrange(minutes * 60) for _ in range(n))
    start = datetime(2024, 1, 5)
    return [bar((start + timedelta(seconds=s)).isoformat(" "), rng.randrange(1, 9), rng.choice(["ES H4", "ES M4"]),
                rng.choice(["last", "bid"]), float(rng.randrange(50)), seq=i) for i, s in enumerate(at)]


class Feed:
    """A folder that a sink reads micro-batch by micro-batch."""

    def __init__(self, spark, sink):
        self.spark, self.sink = spark, sink
        self.path, self.out, self.checkpoint = (workspace(spark, n) for n in ("in", "out", "cp"))

    def send(self, rows):
        df = frame(self.spark, rows)
        self.schema = df.schema
        df.coalesce(2).write.mode("append").parquet(self.path)
        drain(self.sink(read_stream(self.spark, self.path, df.schema), self.out, self.checkpoint))

    def table(self):
        return audited.EpochTable(self.spark, self.out)


def hours(live, out, checkpoint):
    return audited.bar_sink(live, out, checkpoint, "Minute", 60, timedelta(hours=1))


def test_bars_in_order_equal_the_batch(spark):
    data = ticks(1)
    feed = Feed(spark, hours)
    for part in (data[:100], data[100:101], data[101:]):
        feed.send(part)
    want = resample(frame(spark, data), "Minute", 60)
    got = audited.read_bars(spark, feed.out, feed.schema)
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    audited.fold_bars(spark, feed.out, feed.schema)
    assert rows_of(audited.read_bars(spark, feed.out, feed.schema), *want.columns) == rows_of(want, *want.columns)
    feed.send(ticks(2, 30))
    assert feed.table().audit().agg(F.sum("rows_in")).first()[0] == 270


def test_every_row_is_used_or_late(spark):
    data = ticks(3)
    feed = Feed(spark, hours)
    parts = [data[100:200], data[:60] + data[200:], data[60:100]]
    for part in parts:
        feed.send(part)
    audit = feed.table().audit().orderBy("epoch").collect()
    assert [r["rows_in"] for r in audit] == [len(p) for p in parts]
    assert all(r["rows_in"] == r["rows_used"] + r["rows_late"] for r in audit)
    assert audit[0]["rows_late"] == 0 and audit[1]["rows_late"] > 0 and audit[2]["rows_late"] > 0
    late = feed.table().late(feed.schema)
    assert late.groupBy("epoch").count().count() == 2 and late.count() == sum(r["rows_late"] for r in audit)
    used = frame(spark, data).join(late.select("seq"), "seq", "left_anti")
    want = resample(used, "Minute", 60)
    assert rows_of(audited.read_bars(spark, feed.out, feed.schema), *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize("value", [1, 7, 1000])
def test_tick_bars_equal_the_batch(spark, value):
    data = ticks(4)
    feed = Feed(spark, lambda live, out, cp: audited.tick_bar_sink(live, out, cp, value))
    for a, b in ((0, 90), (90, 95), (95, 240)):
        part = data[a:b]
        random.Random(a).shuffle(part)
        feed.send(part)
    want = tick_bars(frame(spark, data), value)
    got = audited.read_tick_bars(spark, feed.out, feed.schema)
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    audited.fold_tick_bars(spark, feed.out, feed.schema)
    assert rows_of(audited.read_tick_bars(spark, feed.out, feed.schema), *want.columns) == rows_of(want, *want.columns)


def test_ticks_behind_their_series_are_late(spark):
    data = ticks(5)
    feed = Feed(spark, lambda live, out, cp: audited.tick_bar_sink(live, out, cp, 5))
    feed.send(data[:200])
    feed.send(data[:10] + data[200:])
    assert feed.table().audit().orderBy("epoch").collect()[1]["rows_late"] == 10
    want = tick_bars(frame(spark, data), 5)
    assert rows_of(audited.read_tick_bars(spark, feed.out, feed.schema), *want.columns) == rows_of(want, *want.columns)


def test_stitched_stream_with_late_bars(spark):
    early = [bar("2024-01-05 10:00:00", 5), bar("2024-01-06 10:00:00", 5)]
    late = [bar("2024-01-05 10:00:00", 9, "ES M4"), bar("2024-01-06 10:00:00", 9, "ES M4", expiry=date(2024, 6, 21))]
    feed = Feed(spark, lambda live, out, cp: audited.stitch_sink(live, out, cp, timedelta(hours=12)))
    feed.send(early)
    feed.send(late)
    want = rows_of(stitch(frame(spark, early + late[1:])), *BAR_COLUMNS)
    assert rows_of(audited.read_stitched(spark, feed.out, feed.schema), *BAR_COLUMNS) == want
    audited.fold_stitched(spark, feed.out, feed.schema)
    assert rows_of(audited.read_stitched(spark, feed.out, feed.schema), *BAR_COLUMNS) == want
    assert rows_of(feed.table().late(feed.schema), "volume") == [(9,)]


def test_a_repeated_micro_batch_changes_nothing(spark):
    feed = Feed(spark, hours)
    feed.send(ticks(6, 50))
    before = rows_of(audited.read_bars(spark, feed.out, feed.schema), "unix_ms", "n")
    # what a restart does whose commit got lost: the same micro-batch under the same number
    import os
    import shutil
    commits = feed.checkpoint.removeprefix("file:") + "/commits"
    shutil.copytree(commits, commits + "-kept")
    for name in os.listdir(commits):
        os.remove(f"{commits}/{name}")
    drain(hours(read_stream(spark, feed.path, feed.schema), feed.out, feed.checkpoint))
    assert rows_of(audited.read_bars(spark, feed.out, feed.schema), "unix_ms", "n") == before
    assert feed.table().audit().count() == 1


def test_a_table_has_one_checkpoint(spark):
    feed = Feed(spark, hours)
    feed.send(ticks(7, 20))
    feed.checkpoint = workspace(spark, "cp")
    with pytest.raises(Exception, match="another checkpoint"):
        feed.send(ticks(8, 20))
    assert feed.table().audit().count() == 1


def test_nothing_yet(spark):
    out = workspace(spark, "out")
    schema = frame(spark, ticks(9, 3)).schema
    assert audited.read_bars(spark, out, schema).isEmpty() and audited.EpochTable(spark, out).audit().isEmpty()
    audited.fold_bars(spark, out, schema)


def test_a_new_checkpoint_at_the_old_path_is_a_new_run(spark):
    """It had written only its first micro-batch, and its folder was made anew: its results count as newer, the old ones stay."""
    import os
    path, out, checkpoint = (workspace(spark, n) for n in ("in", "out", "cp"))
    first, second = frame(spark, [bar("2024-01-05", 5)]), frame(spark, [bar("2024-01-06", 7)])
    for rows in (first, second):
        rows.write.mode("overwrite").parquet(path)
        live = stitch_stream(read_stream(spark, path, rows.schema))
        drain(upsert_writer(live, out, checkpoint), 2)
        schema = live.schema
        os.rename(checkpoint.removeprefix("file:"), checkpoint.removeprefix("file:") + f"-{rows.first()['volume']}")
    assert rows_of(read_upserts(spark, out, schema, KEY), "volume") == [(5,), (7,)]
