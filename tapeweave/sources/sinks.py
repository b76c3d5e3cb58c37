"""Series and interchange exports, and the manifest of what was written."""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as afs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.functions.time import epoch_ns
from tapeweave.operators.stitch import latest_wins
from tapeweave.schema import (BARS, CSV_COLUMNS, DEFAULT_SOURCE, INTERCHANGE_COLUMNS, OHLC, STREAMS)
from tapeweave.session import remove_path, workspace

# Bounds a part file, which the manifest hashes as one value.
MAX_RECORDS_PER_FILE = 4_000_000
_CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": "",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_ENDINGS = {"csv": r"\.csv(\.gz)?$", "parquet": r"\.parquet$"}


@dataclass(frozen=True)
class Written:
    """What a sink was given and what it wrote, counted by the write itself."""

    given: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


class _Count:
    """Rows per stream that pass through a frame; rows of no known stream count under ``other``."""

    def __init__(self):
        self._seen = Observation()

    def over(self, df: DataFrame) -> DataFrame:
        known = [F.count_if(F.col("price_type") == s).alias(s) for s in STREAMS]
        other = F.count_if(~F.coalesce(F.col("price_type").isin(*STREAMS), F.lit(False))).alias("other")
        return df.observe(self._seen, *known, other)

    def result(self) -> dict[str, int]:
        return {s: n for s, n in self._seen.get.items() if n}


def _ordered(df: DataFrame, *order: str) -> DataFrame:
    """Sorted as a set of files: ranges of ``order``, each sorted. No single-task sort."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _folders(df: DataFrame) -> DataFrame:
    """Folder names as copies, so symbol and stream stay inside the files too."""
    return df.withColumn("root", F.col("symbol")).withColumn("stream", F.col("price_type"))


def export_csv(bars: DataFrame, out: str, compression: str | None = None, header: bool = True) -> Written:
    """``root=.../stream=.../part-*.csv`` with unix_ms, prices, volume, contract, in time order.

    A stream without rows gets no folder. ``compression='gzip'`` packs each file.
    """
    count = _Count()
    # counted behind the shuffle, which samples what lies before it
    writer = (count.over(_ordered(_folders(bars), "root", "stream", "unix_ms"))
              .select("root", "stream", *CSV_COLUMNS).write)
    if compression:
        writer = writer.option("compression", compression)
    (writer.options(**_CSV | {"header": header}).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("root", "stream").csv(out))
    return Written(count.result(), count.result())


def export_parquet(bars: DataFrame, out: str) -> Written:
    """The same layout with all ten columns in every file."""
    count = _Count()
    (count.over(_ordered(_folders(bars), "root", "stream", "unix_ms")).select("root", "stream", *BARS.fieldNames())
     .write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("root", "stream").parquet(out))
    return Written(count.result(), count.result())


def export_single_csv(bars: DataFrame, out: str, compression: str | None = "gzip") -> DataFrame:
    """One ordered CSV file per root and stream: ``root=.../<stream>.csv[.gz]``; returns a row per file.

    Rows are sorted and packed as ordered parts without a header by as many tasks
    as the data needs. One task per file then puts the header and the parts one
    after the other, as bytes: gzip files may be joined so. It sorts nothing and
    holds a few megabytes; size and SHA-256 come from the bytes it writes.
    """
    if compression not in (None, "gzip"):
        raise ValueError(f"compression must be gzip or None, got {compression!r}")
    spark, suffix = bars.sparkSession, ".csv.gz" if compression else ".csv"
    work = workspace(spark, "parts")
    export_csv(bars, work, compression, header=False)
    listed = (_part_files(spark, work, "csv").select("path")
              .groupBy(F.regexp_extract("path", "(root=[^/]*)/stream=([^/]*)/[^/]*$", 1).alias("root"),
                       F.regexp_extract("path", "(root=[^/]*)/stream=([^/]*)/[^/]*$", 2).alias("stream"))
              .agg(F.sort_array(F.collect_list("path")).alias("parts")))
    names = (",".join(CSV_COLUMNS) + "\n").encode()
    target = out.rstrip("/")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header = gzip.compress(names, mtime=0) if compression else names
        for batch in batches:
            for row in batch.to_pylist():
                files, base = file_system(target)
                folder = f"{base}/{row['root']}"
                files.create_dir(folder, recursive=True)
                own = f"{folder}/.{row['stream']}-{TaskContext.get().taskAttemptId()}"
                sha, size = hashlib.sha256(), 0
                with files.open_output_stream(own, compression=None) as sink:
                    for piece in _pieces(header, row["parts"]):
                        sink.write(piece)
                        sha.update(piece)
                        size += len(piece)
                path = f"{folder}/{row['stream']}{suffix}"
                files.move(own, path)
                yield pa.RecordBatch.from_pydict({"path": [path], "parts": [len(row["parts"])], "size_bytes": [size],
                                                  "sha256": [sha.hexdigest()]},
                                                 schema=pa.schema([("path", pa.string()), ("parts", pa.int64()),
                                                                   ("size_bytes", pa.int64()), ("sha256", pa.string())]))

    made = listed.repartition("root", "stream").mapInArrow(join, "path string, parts long, size_bytes long, sha256 string")
    rows = made.collect()  # a row per root and stream
    remove_path(spark, work)
    return spark.createDataFrame(rows, made.schema)


def file_system(uri: str) -> tuple[afs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is a local (mounted) one."""
    if uri.startswith("file:"):
        return afs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return afs.FileSystem.from_uri(uri) if ":/" in uri else (afs.LocalFileSystem(), uri)


def _pieces(header: bytes, parts: list[str], size: int = 8 << 20) -> Iterator[bytes]:
    yield header
    for part in parts:
        files, path = file_system(part)
        with files.open_input_stream(path, compression=None) as source:
            while piece := source.read(size):
                yield piece


def read_csv_export(spark: SparkSession, out: str) -> DataFrame:
    schema = T.StructType([BARS[c] for c in CSV_COLUMNS]
                          + [T.StructField("root", T.StringType()), T.StructField("stream", T.StringType())])
    df = spark.read.schema(schema).options(**_CSV).csv(out)
    return (df.withColumn("contract", F.coalesce("contract", F.lit("")))
            .withColumnsRenamed({"root": "symbol", "stream": "price_type"}))


def read_parquet_export(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(BARS).option("recursiveFileLookup", True).parquet(out)


def to_interchange(bars: DataFrame, source: str = DEFAULT_SOURCE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Interchange rows: ``symbol`` is the full contract name, ``source`` tells the provenance."""
    return bars.select(F.col("timestamp").alias("ts_event"), F.col("contract").alias("symbol"),
                       "price_type", F.lit(source).alias("source"), *OHLC, "volume", *keep)


def _stream_rank() -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STREAMS]), F.col("price_type"))


def keyed(rows: DataFrame, sequence: str | None) -> DataFrame:
    """One row per (contract, stream, instant): the latest by ``sequence``, the column of arrival."""
    if not sequence:
        raise ValueError("which row came last needs a sequence: name the column of arrival")
    return latest_wins(rows, [F.col(sequence)])


def export_interchange(rows: DataFrame, out: str, fmt: str = "parquet", sequence: str | None = None,
                       compression: str | None = None, dedup: bool = False) -> Written:
    """Write interchange rows.

    CSV carries nanoseconds and every row it is given (``dedup`` makes it
    keyed), streams in last, bid, ask order. Parquet is always keyed and
    ordered by (price_type, ts_event). What is keyed needs ``sequence``.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"format must be csv or parquet, got {fmt!r}")
    given, left = _Count(), _Count()
    one_per_key = fmt == "parquet" or dedup
    if one_per_key:
        rows = keyed(given.over(rows), sequence)
    if fmt == "csv":
        ranked = rows.withColumn("_rank", _stream_rank()).withColumn("ts_event_ns", epoch_ns(F.col("ts_event")))
        # The trailing columns let ranges split an instant that many rows share.
        ties = [sequence] if sequence else []
        writer = (left.over(_ordered(ranked, "_rank", "symbol", "ts_event_ns", *ties, "volume", "close"))
                  .select("ts_event_ns", *INTERCHANGE_COLUMNS[1:]).write.options(**_CSV))
        if compression:
            writer = writer.option("compression", compression)
        writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).csv(out)
    else:
        (left.over(_ordered(rows.select(*INTERCHANGE_COLUMNS), "price_type", "ts_event", "symbol")).write
         .option("compression", compression or "snappy")
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(out))
    return Written(given.result() if one_per_key else left.result(), left.result())


def read_interchange(spark: SparkSession, out: str, fmt: str = "parquet", multiline: bool = False) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(out).select(*INTERCHANGE_COLUMNS)
    schema = T.StructType([T.StructField("ts_event_ns", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in ("symbol", "price_type", "source")]
                          + [T.StructField(c, T.DoubleType()) for c in OHLC]
                          + [T.StructField("volume", T.LongType())])
    return spark.read.schema(schema).options(**_CSV).option("multiLine", multiline).csv(out)


def _part_files(spark: SparkSession, out: str, fmt: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(out)
            .filter(F.col("path").rlike(_ENDINGS[fmt])))


def export_files(spark: SparkSession, out: str, fmt: str) -> DataFrame:
    """Size and SHA-256 of every part file, hashed by the task that reads it."""
    return (_part_files(spark, out, fmt)
            .select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")))


def export_manifest(spark: SparkSession, out: str, written: Written, fmt: str) -> DataFrame:
    """One row per export: part files, bytes, rows, rows per stream, and one SHA-256 over all files.

    ``written`` is what the sink has returned: ``bar_count`` and its streams are
    the rows it was given, ``file_rows`` those that lie in the files (fewer where
    the sink keeps one per key). Without any the status is ``no_data``.

    ``sha256`` is a hash tree: files are hashed where they are read, a folder is
    the hash of its files' names and hashes in order, the export that of its
    folders. ``verify_manifest`` computes it again.
    """
    long, zero = "bigint", F.lit(0).cast("bigint")
    given, rows = sum(written.given.values()), sum(written.rows.values())
    counts = sorted((k, v) for k, v in written.given.items())
    by_stream = (F.create_map(*[F.lit(x) if isinstance(x, str) else F.lit(x).cast(long) for kv in counts for x in kv])
                 if counts else F.create_map().cast("map<string,bigint>"))
    return (_hash_tree(spark, out, fmt)
            .select(F.lit(given).cast(long).alias("bar_count"), by_stream.alias("bar_count_by_stream"),
                    F.lit(rows).cast(long).alias("file_rows"), "files", F.coalesce("size_bytes", zero).alias("size_bytes"),
                    "sha256", F.lit("ready" if given else "no_data").alias("status")))


def _hash_tree(spark: SparkSession, out: str, fmt: str) -> DataFrame:
    listed = export_files(spark, out, fmt)
    names = F.transform(F.sort_array(F.collect_list(F.struct(F.regexp_extract("path", "[^/]*$", 0).alias("name"), "sha256"))),
                        lambda f: F.concat_ws(" ", f["name"], f["sha256"]))
    base = F.regexp_extract("path", "((?:root=[^/]*/stream=[^/]*/)?)[^/]*$", 1)
    folders = (listed.groupBy(base.alias("folder"))
               .agg(F.sha2(F.concat_ws("\n", names), 256).alias("sha256"), F.count(F.lit(1)).alias("files"),
                    F.sum("size_bytes").alias("size_bytes")))
    inner = F.transform(F.sort_array(F.collect_list(F.struct("folder", "sha256"))), lambda f: F.concat_ws(" ", f["folder"], f["sha256"]))
    return folders.agg(F.sha2(F.concat_ws("\n", inner), 256).alias("sha256"),
                       F.coalesce(F.sum("files"), F.lit(0).cast("bigint")).alias("files"), F.sum("size_bytes").alias("size_bytes"))


def verify_manifest(spark: SparkSession, out: str, manifest: DataFrame, fmt: str) -> bool:
    """Whether the files are those the manifest was made of."""
    row, now = manifest.first(), _hash_tree(spark, out, fmt).first()
    return (row["sha256"], row["files"], row["size_bytes"]) == (now["sha256"], now["files"], now["size_bytes"] or 0)
