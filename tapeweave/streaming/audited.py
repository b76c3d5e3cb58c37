"""Streams of which every row is accounted for: used or late, counted per micro-batch.

A watermark inside a streaming aggregate drops late rows without a trace. Here
each micro-batch is split before anything is aggregated: rows that come too late
go to a side table, the others become mergeable parts (one per key), and an audit
row counts both. Parts of all micro-batches together give the current result, so
no state store is kept, and a micro-batch that is repeated finds its number done.

Only micro-batches whose audit row is written are read; it is written last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tapeweave.functions.time import UNIT_MICROS, bucket_start, epoch_ms
from tapeweave.operators.resample import order_key, placed
from tapeweave.operators.stitch import preference, top_one
from tapeweave.schema import KEY, OHLC, SERIES, check_period
from tapeweave.session import join_dim, remove_path, workspace
from tapeweave.sources.commits import publish
from tapeweave.streaming.files import checkpoint_id, exists, read_text

AUDIT = "rows_in long, rows_used long, rows_late long, watermark long, newest long"


class EpochTable:
    """Results of micro-batches below ``out``: ``parts``, ``late``, ``state`` and ``audit`` by epoch."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")

    def own(self, checkpoint: str) -> None:
        """One checkpoint writes a table: its epochs number the folders."""
        mine = checkpoint_id(self.spark, checkpoint)
        path = f"{self.out}/_owner"
        if not publish(self.spark, path, mine) and read_text(self.spark, path) != mine:
            raise ValueError(f"{self.out} belongs to another checkpoint")

    def epochs(self) -> list[int]:
        """Micro-batches that are done."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/audit")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath() for s in fs.listStatus(root)]
        return sorted(int(p.getName()[6:]) for p in names if p.getName().startswith("epoch=") and exists(self.spark, f"{p}/_SUCCESS"))

    def folded(self) -> int:
        """The last micro-batch whose parts are folded into one folder, -1 if none."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/folds")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return max((int(s.getPath().getName()) for s in fs.listStatus(root)), default=-1) if fs.exists(root) else -1

    def put(self, name: str, epoch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.out}/{name}/epoch={epoch}")

    def read(self, name: str, schema: T.StructType | str, epochs: list[int] | None = None) -> DataFrame:
        wanted = self.epochs() if epochs is None else epochs
        paths = [f"{self.out}/{name}/epoch={e}" for e in wanted]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn("epoch", F.lit(None).cast("int"))
        return self.spark.read.schema(schema).option("basePath", f"{self.out}/{name}").parquet(*paths)

    def parts(self, schema: T.StructType) -> DataFrame:
        """Parts of all micro-batches that are done."""
        last = self.folded()
        rows = self.read("parts", schema, [e for e in self.epochs() if e > last]).select(*schema.fieldNames())
        if last < 0:
            return rows
        return rows.unionByName(self.spark.read.schema(schema).parquet(f"{self.out}/folded/{read_text(self.spark, f'{self.out}/folds/{last:012d}')}"))

    def audit(self) -> DataFrame:
        """Per micro-batch: ``epoch``, ``rows_in``, ``rows_used``, ``rows_late``, and the watermark it was held against."""
        rows = self.read("audit", AUDIT)
        return rows.select("epoch", "rows_in", "rows_used", "rows_late", F.timestamp_micros("watermark").alias("watermark"))

    def late(self, schema: T.StructType) -> DataFrame:
        """Rows that came too late, with their ``epoch``."""
        return self.read("late", schema)

    def fold(self, schema: T.StructType, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Write the parts so far as one folder and delete theirs; a stream may go on meanwhile."""
        done = self.epochs()
        if not done or done[-1] <= self.folded():
            return
        name = uuid.uuid4().hex
        merge(self.parts(schema)).select(*schema.fieldNames()).write.parquet(f"{self.out}/folded/{name}")
        if publish(self.spark, f"{self.out}/folds/{done[-1]:012d}", name):
            for e in done:
                remove_path(self.spark, f"{self.out}/parts/epoch={e}")


def _writer(stream: DataFrame, out: str, checkpoint: str, split: Callable[[DataFrame, EpochTable, int], DataFrame],
            reduce: Callable[[DataFrame, EpochTable, int], DataFrame]) -> DataStreamWriter:
    """Per micro-batch: ``split`` marks late rows (column ``_late``) and may add columns, ``reduce`` makes parts of the rest."""
    spark, own = stream.sparkSession, stream.columns

    def put(batch: DataFrame, epoch: int) -> None:
        table = EpochTable(spark, out)
        table.own(checkpoint)
        if epoch in table.epochs():
            return
        # read once; counts, late rows and parts come from the same files
        path = workspace(spark, "micro-batch")
        marked = split(batch, table, epoch)
        marked.write.parquet(path)
        rows = spark.read.schema(marked.schema).parquet(path)
        table.put("late", epoch, rows.filter("_late").select(*own))
        used = rows.filter("not _late")
        table.put("parts", epoch, reduce(used, table, epoch))
        counted = rows.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(~F.col("_late")).alias("rows_used"),
                           F.count_if("_late").alias("rows_late"), F.max("_watermark").alias("watermark"),
                           F.max(F.unix_micros("timestamp")).alias("newest"))
        table.put("audit", epoch, counted.coalesce(1))
        remove_path(spark, path)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)


def _watermark(table: EpochTable, epoch: int, lateness: timedelta) -> Column:
    """The newest instant of earlier micro-batches less ``lateness``, in microseconds; null before there is one."""
    seen = table.read("audit", AUDIT, [e for e in table.epochs() if e < epoch])
    newest = seen.agg(F.max("newest").alias("m")).first()["m"]
    return F.lit(None if newest is None else newest - lateness // timedelta(microseconds=1)).cast("bigint")


# --- time bars ---------------------------------------------------------------------------------

def _bar_parts(keys: list[str], schema: T.StructType) -> T.StructType:
    order = T.DecimalType(38, 0)
    return T.StructType([*(schema[c] for c in keys if c in schema.fieldNames()), T.StructField("start", T.LongType()),
                         T.StructField("first", order), T.StructField("last", order),
                         *(T.StructField(c, T.DoubleType()) for c in OHLC),
                         T.StructField("volume", T.LongType()), T.StructField("n", T.LongType())])


def _reduced(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return rows.groupBy(*keys, "start").agg(
        F.min(order).cast("decimal(38,0)").alias("first"), F.max(order).cast("decimal(38,0)").alias("last"),
        F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", order).alias("close"), F.sum("volume").cast("bigint").alias("volume"), F.count(F.lit(1)).alias("n"))


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "start").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min_by("open", "first").alias("open"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last").alias("close"),
        F.sum("volume").alias("volume"), F.sum("n").alias("n"))


def bar_sink(ticks: DataFrame, out: str, checkpoint: str, unit: str, value: int, lateness: timedelta) -> DataStreamWriter:
    """Time bars of a tick stream. A tick is late when its bar ended ``lateness`` or more before the newest
    tick of earlier micro-batches; then it is kept in the side table and counted, not used."""
    check_period(unit, value)
    if unit == "Tick":
        raise ValueError("use tick_bar_sink for tick-count bars")
    width = UNIT_MICROS[unit] * value

    def split(batch: DataFrame, table: EpochTable, epoch: int) -> DataFrame:
        start = bucket_start(F.unix_micros("timestamp"), width)
        return (batch.withColumn("start", start).withColumn("_watermark", _watermark(table, epoch, lateness))
                .withColumn("_late", F.coalesce(F.col("start") + width <= F.col("_watermark"), F.lit(False))))

    def reduce(used: DataFrame, table: EpochTable, epoch: int) -> DataFrame:
        return _reduced(used.withColumn("_order", order_key(used)), SERIES, "_order")

    return _writer(ticks, out, checkpoint, split, reduce)


def read_bars(spark: SparkSession, out: str, ticks: T.StructType) -> DataFrame:
    """Bars of ``bar_sink`` as they are now, in the columns of ``resample``."""
    found = _merged(EpochTable(spark, out).parts(_bar_parts(SERIES, ticks)), SERIES)
    start = F.timestamp_micros("start")
    return found.select(*SERIES, epoch_ms(start).alias("unix_ms"), start.alias("timestamp"), *OHLC, "volume", "n")


def fold_bars(spark: SparkSession, out: str, ticks: T.StructType) -> None:
    EpochTable(spark, out).fold(_bar_parts(SERIES, ticks), lambda parts: _merged(parts, SERIES))


# --- tick-count bars ---------------------------------------------------------------------------

def tick_bar_sink(ticks: DataFrame, out: str, checkpoint: str, value: int) -> DataStreamWriter:
    """Bars of ``value`` consecutive ticks of a stream, as the batch ``tick_bars`` makes them of all ticks.

    Ticks must come in the order (timestamp, seq) from one micro-batch to the
    next; inside one any order will do. A tick at or before the last one of its
    series from an earlier micro-batch would move every bar after it: it is late.
    State is one row per series: ticks so far, and the last one.
    """
    check_period("Tick", value)
    seq = F.col("seq").cast("bigint") if "seq" in ticks.columns else F.lit(0).cast("bigint")
    state = T.StructType([*(ticks.schema[c] for c in SERIES), T.StructField("seen", T.LongType()),
                          T.StructField("last_us", T.LongType()), T.StructField("last_seq", T.LongType())])

    def before(table: EpochTable, epoch: int) -> DataFrame:
        done = [e for e in table.epochs() if e < epoch]
        return table.read("state", state, done[-1:]).select(*state.fieldNames())

    def split(batch: DataFrame, table: EpochTable, epoch: int) -> DataFrame:
        known = join_dim(batch, before(table, epoch), SERIES, "left", spread=["timestamp"])
        us = F.unix_micros("timestamp")
        late = (us < F.col("last_us")) | ((us == F.col("last_us")) & (seq <= F.col("last_seq")))
        return (known.withColumn("_late", F.coalesce(late, F.lit(False))).withColumn("_watermark", F.lit(None).cast("bigint"))
                .withColumn("seen", F.coalesce("seen", F.lit(0).cast("bigint"))).drop("last_us", "last_seq"))

    def reduce(used: DataFrame, table: EpochTable, epoch: int) -> DataFrame:
        numbered, path = placed(used, SERIES, keep=("seen",))
        total = F.col("seen") + F.col("_place")
        bars = numbered.withColumn("_at", total).withColumn("start", total - F.pmod(total, F.lit(value).cast("bigint")))
        out_rows = _reduced(bars, SERIES, "_at").join(
            bars.groupBy(*SERIES, "start").agg(F.min(F.unix_micros("timestamp")).alias("begin")), [*SERIES, "start"])
        ends = used.groupBy(*SERIES).agg(F.max("seen").alias("was"), F.count(F.lit(1)).alias("more"),
                                         F.max(F.struct(F.unix_micros("timestamp").alias("us"), seq.alias("seq"))).alias("end"))
        grown = ends.select(*SERIES, (F.col("was") + F.col("more")).alias("seen"), F.col("end.us").alias("last_us"),
                            F.col("end.seq").alias("last_seq"))
        old = before(table, epoch)
        table.put("state", epoch, grown.unionByName(old.join(grown.select(*SERIES), SERIES, "left_anti")).select(*state.fieldNames()))
        return out_rows

    return _writer(ticks, out, checkpoint, split, reduce)


def _tick_parts(ticks: T.StructType) -> T.StructType:
    return T.StructType([*_bar_parts(SERIES, ticks).fields, T.StructField("begin", T.LongType())])


def _merged_ticks(parts: DataFrame) -> DataFrame:
    begin = parts.groupBy(*SERIES, "start").agg(F.min("begin").alias("begin"))
    return _merged(parts, SERIES).join(begin, [*SERIES, "start"])


def read_tick_bars(spark: SparkSession, out: str, ticks: T.StructType) -> DataFrame:
    """Bars of ``tick_bar_sink`` as they are now, in the columns of ``tick_bars``; the last of a series may be short."""
    found = _merged_ticks(EpochTable(spark, out).parts(_tick_parts(ticks)))
    begin = F.timestamp_micros("begin")
    return found.select(*SERIES, epoch_ms(begin).alias("unix_ms"), begin.alias("timestamp"), *OHLC, "volume", "n",
                        F.col("start").alias("first_tick"))


def fold_tick_bars(spark: SparkSession, out: str, ticks: T.StructType) -> None:
    EpochTable(spark, out).fold(_tick_parts(ticks), _merged_ticks)


# --- the continuous series ---------------------------------------------------------------------

def stitch_sink(bars: DataFrame, out: str, checkpoint: str, lateness: timedelta) -> DataStreamWriter:
    """The winning bar per key of a stream of bars (which carry ``expiry``). A bar is late when it lies
    ``lateness`` or more before the newest bar of earlier micro-batches."""
    def split(batch: DataFrame, table: EpochTable, epoch: int) -> DataFrame:
        return (batch.withColumn("_watermark", _watermark(table, epoch, lateness))
                .withColumn("_late", F.coalesce(F.unix_micros("timestamp") <= F.col("_watermark"), F.lit(False))))

    def reduce(used: DataFrame, table: EpochTable, epoch: int) -> DataFrame:
        return top_one(used, KEY, preference()).drop("_late", "_watermark")

    return _writer(bars, out, checkpoint, split, reduce)


def read_stitched(spark: SparkSession, out: str, bars: T.StructType) -> DataFrame:
    return top_one(EpochTable(spark, out).parts(bars), KEY, preference())


def fold_stitched(spark: SparkSession, out: str, bars: T.StructType) -> None:
    EpochTable(spark, out).fold(bars, lambda parts: top_one(parts, KEY, preference()))
