"""Session settings, the shared work folder, and size-checked dimension joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tapeweave.functions.time import UTC_NAMES

# A side is broadcast only when both bounds hold; it is measured, not guessed.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 64

_local_dirs: dict[str, str] = {}


def shuffle_partitions(input_bytes: int, cores: int = 8, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Initial shuffle partitions for an input: about ``target_bytes`` of it each.

    Adaptive execution joins small ones afterwards, so this may be generous.
    For the largest inputs a larger ``target_bytes`` keeps their number down.
    """
    return max(cores, -(-input_bytes // target_bytes))


def session(app: str = "tapeweave", input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; ``input_bytes`` sizes the shuffles."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Instants are UTC everywhere in this library, and microsecond integers in Parquet.

    The default INT96 timestamps carry no statistics, so files could not be skipped by time.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, is {zone}: call pin_utc(spark)")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="tapeweave-")
    return _local_dirs[sc.applicationId]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tapeweave/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_workspace(spark: SparkSession) -> bool:
    """Delete all work tables of this application; frames that still read them stop working."""
    return remove_path(spark, _own_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table and continue from the files.

    Later reads see the same rows whichever executors are lost, and read only
    the columns they need.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measure(df: DataFrame, *more: Column, rows: int = BROADCAST_ROWS) -> Row:
    """``rows`` and ``size`` in bytes of a side, looking at no more than ``rows + 1`` rows of it."""
    return (df.limit(rows + 1)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("size"), *more)
            .first())


def fits_broadcast(found: Row, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    return found["rows"] <= rows and found["size"] <= size


def join_dim(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "inner",
             spread: list[str] | None = None, rows: int = BROADCAST_ROWS,
             found: Row | None = None) -> DataFrame:
    """Join a large table to a dimension that has one row per ``on``.

    A dimension of measured small size is broadcast; ``found`` is that
    measurement when the caller has it. A larger one is joined by a shuffle;
    ``spread`` names fact columns whose hash splits a hot key over ``SALTS``
    tasks, with the dimension repeated per salt; adaptive skew joins split
    what is still too large.
    """
    if fits_broadcast(found or measure(dim, rows=rows), rows):
        return fact.join(F.broadcast(dim), on, how)
    if not spread:
        return fact.join(dim, on, how)
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS).cast("bigint")))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                            F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
