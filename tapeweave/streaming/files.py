"""File-based stream sources and an idempotent keyed sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tapeweave.operators.stitch import top_one
from tapeweave.session import remove_path
from tapeweave.sources.commits import publish


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                glob: str | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


_UPSERT = ["_run", "_epoch"]


def upsert_writer(df: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Write each micro-batch of an update-mode aggregate to its own folder.

    Folders are named by run and micro-batch. A checkpoint has one run number,
    taken from the folder when it writes first, so a stream that starts anew
    over old results counts as the newer one although its micro-batches begin
    at 0 again. A checkpoint is known by an id inside its folder, not by its path. A repeated micro-batch rewrites its own folder, so
    at-least-once delivery is enough; ``read_upserts`` returns the current row
    per key. One stream at a time writes a folder.
    """
    spark = df.sparkSession
    state: dict[str, int] = {}

    def run_number(epoch: int) -> int:
        if "run" not in state:
            known, mine = _runs(spark, out), checkpoint_id(spark, checkpoint)
            own = [r["run"] for r in known if r["checkpoint"] == mine]
            state["run"] = max(own) if own else 1 + max([r["run"] for r in known], default=0)
            if not own:
                (spark.createDataFrame([(state["run"], mine)], "run long, checkpoint string")
                 .coalesce(1).write.mode("append").parquet(f"{out}/_runs"))
        return state["run"]

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/_run={run_number(epoch)}/_epoch={epoch}")

    return (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id in the checkpoint's folder; a folder without one gets one, and only one, whoever asks first."""
    path = f"{checkpoint.rstrip('/')}/tapeweave-id"
    publish(spark, path, uuid.uuid4().hex)
    return read_text(spark, path)


def _runs(spark: SparkSession, out: str) -> list:
    """Runs so far, one small row each."""
    path = f"{out}/_runs"
    return spark.read.schema("run long, checkpoint string").parquet(path).collect() if exists(spark, path) else []


def _upserts(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    numbered = T.StructType(schema.fields + [T.StructField(c, T.LongType()) for c in _UPSERT])
    paths = [f"{out}/_run={r}" for r in sorted({x["run"] for x in _runs(spark, out)}) if exists(spark, f"{out}/_run={r}")]
    if not paths:
        return spark.createDataFrame([], numbered)
    return spark.read.schema(numbered).option("basePath", out).parquet(*paths)


def read_upserts(spark: SparkSession, out: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    newest = [F.col(c).desc() for c in _UPSERT]
    return top_one(_upserts(spark, out, schema), keys, newest).drop(*_UPSERT)


def fold_upserts(spark: SparkSession, out: str, schema: T.StructType, keys: list[str]) -> None:
    """Rewrite the current rows as one folder, so reads do not rank all micro-batches for ever.

    For a stream that is not running. The folded rows come first under a new
    run number and the old folders go afterwards: a crash in between leaves
    rows twice, of which the newest is read as before.
    """
    known = _runs(spark, out)
    run = 1 + max([r["run"] for r in known], default=0)
    current = read_upserts(spark, out, schema, keys)
    current.write.mode("overwrite").parquet(f"{out}/_run={run}/_epoch=0")
    spark.createDataFrame([(run, "folded")], "run long, checkpoint string").coalesce(1).write.mode("append").parquet(f"{out}/_runs")
    for r in {x["run"] for x in known}:
        remove_path(spark, f"{out}/_run={r}")


def drain(writer: DataStreamWriter, state_partitions: int | None = None) -> None:
    """Process everything available now, then stop.

    A stateful query keeps as many state stores as it has shuffle partitions,
    and keeps that number for good; ``state_partitions`` sets it for this query.
    """
    conf = SparkSession.active().conf
    before = conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
    query.awaitTermination()
