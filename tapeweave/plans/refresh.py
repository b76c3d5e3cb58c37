"""Larger bars kept up to date: only the buckets that a commit has touched are made again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.functions.time import UNIT_MICROS, bucket_start
from tapeweave.operators.resample import resample
from tapeweave.operators.stitch import top_one
from tapeweave.schema import OHLC, check_period, check_timeframe
from tapeweave.session import join_dim
from tapeweave.sources.commits import ADD, REMOVE, Snapshot, publish
from tapeweave.sources.store import BarStore
from tapeweave.streaming.files import exists

_SERIES = ["symbol", "price_type"]
_ROWS = T.StructType([*(T.StructField(c, T.StringType()) for c in _SERIES), T.StructField("unix_ms", T.LongType()),
                      T.StructField("timestamp", T.TimestampType()), *(T.StructField(c, T.DoubleType()) for c in OHLC),
                      T.StructField("volume", T.LongType()), T.StructField("n", T.LongType())])


@dataclass(frozen=True)
class Refreshed:
    """``version`` of the store that the bars stand for, how many buckets were made again, and whether all were."""

    version: int
    buckets: int
    full: bool


class Derived:
    """Bars of ``unit`` x ``value`` over the stored series of one timeframe, kept below ``out``.

    Every refresh writes the buckets it made again as one folder named by the
    store's version; of a bucket the newest folder counts. A bucket that lost all
    its bars is written with n = 0. Refreshes of one folder go one at a time.
    """

    def __init__(self, store: BarStore, timeframe: str, out: str, unit: str, value: int = 1):
        check_period(unit, value)
        if unit == "Tick":
            raise ValueError("tick-count bars move with every tick: make them again as a whole")
        self.store, self.timeframe, self.out = store, check_timeframe(timeframe), out.rstrip("/")
        self.unit, self.value, self.width = unit, value, UNIT_MICROS[unit] * value

    def versions(self) -> list[int]:
        spark = self.store.spark
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/done")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(root)) if fs.exists(root) else []

    def read(self) -> DataFrame:
        """The bars as of the last refresh."""
        spark, done = self.store.spark, self.versions()
        if not done:
            return spark.createDataFrame([], _ROWS)
        rows = (spark.read.schema(T.StructType([*_ROWS.fields, T.StructField("version", T.LongType())]))
                .option("basePath", f"{self.out}/bars").parquet(*[f"{self.out}/bars/version={v}" for v in done]))
        if len(done) > 1:
            rows = top_one(rows, ["unix_ms", *_SERIES], [F.col("version").desc()])
        return rows.filter("n > 0").select(*_ROWS.fieldNames())

    def refresh(self) -> Refreshed:
        """Bring the bars up to the store's newest version."""
        snap, done = self.store.log.snapshot(), self.versions()
        if done and done[-1] >= snap.version:
            return Refreshed(snap.version, 0, False)
        touched = self._touched(snap, done[-1]) if done else None
        if touched is None:
            bars = self._bars(self.store.read(self.timeframe))
            known = self.read().select(*_SERIES, "unix_ms", "timestamp")
            made = bars.unionByName(self._empty(known, bars)) if done else bars
        else:
            ends = touched.agg(F.min("_start").alias("low"), F.max("_start").alias("high")).first()
            if ends["low"] is None:
                self._put(snap.version, self.store.spark.createDataFrame([], _ROWS))
                publish(self.store.spark, f"{self.out}/done/{snap.version:020d}", "")
                return Refreshed(snap.version, 0, False)
            # files outside the touched span aren't opened
            rows = self.store.read(self.timeframe).filter(F.col("unix_ms").between(
                F.lit(ends["low"] // 1000), F.lit((ends["high"] + self.width) // 1000)))
            rows = rows.withColumn("_start", bucket_start(F.unix_micros("timestamp"), self.width))
            bars = self._bars(join_dim(rows, touched, [*_SERIES, "_start"], "left_semi").drop("_start"))
            start = F.timestamp_micros("_start")
            made = bars.unionByName(self._empty(touched.select(*_SERIES, F.unix_millis(start).alias("unix_ms"), start.alias("timestamp")), bars))
        self._put(snap.version, made)
        count = self.store.spark.read.parquet(f"{self.out}/bars/version={snap.version}").count()
        publish(self.store.spark, f"{self.out}/done/{snap.version:020d}", "")
        return Refreshed(snap.version, count, touched is None)

    def _put(self, version: int, rows: DataFrame) -> None:
        rows.select(*_ROWS.fieldNames()).write.mode("overwrite").parquet(f"{self.out}/bars/version={version}")

    def _bars(self, rows: DataFrame) -> DataFrame:
        return resample(rows, self.unit, self.value, series=_SERIES).select(*_ROWS.fieldNames())

    def _empty(self, buckets: DataFrame, bars: DataFrame) -> DataFrame:
        """The buckets that have no bar any more, with n = 0."""
        gone = buckets.join(bars.select(*_SERIES, "unix_ms"), [*_SERIES, "unix_ms"], "left_anti")
        return gone.select(*[F.col(f.name) if f.name in gone.columns else F.lit(0).cast(f.dataType).alias(f.name) for f in _ROWS.fields])

    def _touched(self, snap: Snapshot, since: int) -> DataFrame | None:
        """Buckets (series and start) that commits after ``since`` may have changed; None if that can't be told any more.

        Compactions change no bar. What merges add is read from the files they added,
        what replacements took away from those they removed, and a cleared range
        touches the buckets that were there.
        """
        commits = {c["version"]: c for c in snap.commits if c["version"] > since}
        if set(range(since + 1, snap.version + 1)) - set(commits) - self._checkpoints(since, snap.version):
            return None  # a checkpoint has taken the place of some of them
        store, mine = self.store, [c for c in commits.values() if c.get("timeframe") == self.timeframe]
        if not mine:
            return store.spark.createDataFrame([], "symbol string, price_type string, _start long")
        entries = (store.log.entries(snap).filter(F.col("kind").isin(ADD, REMOVE) & (F.col("table_name") == self.timeframe)
                                                  & F.col("version").isin([c["version"] for c in mine if c["kind"] in ("merge", "replace")]))
                   .select("path").distinct())
        paths = [r["path"] for r in entries.collect()]  # files of the commits since the last refresh
        if not all(exists(store.spark, f"{store._bars}/{p}") for p in paths):
            return None  # deleted since
        start = bucket_start(F.unix_micros("timestamp"), self.width).alias("_start")
        empty = store.spark.createDataFrame([], "symbol string, price_type string, _start long")
        rows = store.scan_paths(paths).select(*_SERIES, start) if paths else empty
        for h in (h for h in snap.holes if h.timeframe == self.timeframe and h.version > since):
            low = h.low * 1000 - (h.low * 1000) % self.width
            inside = self.read().filter((F.col("symbol") == h.symbol) & (F.unix_micros("timestamp") >= low)
                                        & (F.unix_micros("timestamp") <= (h.high + 1) * 1000))
            rows = rows.unionByName(inside.select(*_SERIES, F.unix_micros("timestamp").alias("_start")))
        return rows.distinct()

    def _checkpoints(self, since: int, last: int) -> set[int]:
        log = self.store.log
        return {n for n in log._numbers() if since < n <= last and log._commit(n)["kind"] == "checkpoint"}
