"""Reading source bars and the instrument catalog with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.schema import BAR_COLUMNS, BARS, BARS_RAW, INSTRUMENTS


def scan_bars(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
              schema: T.StructType = BARS_RAW, multiline: bool = False) -> DataFrame:
    """Source bars from Parquet, ORC or CSV; no inference, so no extra pass.

    Values a CSV cannot parse become NULL and end in the rejects of
    ``validate_bars``. Bars of all contracts and streams are one scan.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return (reader.option("header", True).option("quote", '"').option("escape", '"')
                .option("mode", "PERMISSIVE").option("multiLine", multiline).csv(paths))
    if fmt in ("parquet", "orc"):
        return reader.format(fmt).load(paths)
    raise ValueError(f"format must be parquet, orc or csv, got {fmt!r}")


def scan_instruments(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return scan_bars(spark, path, fmt, INSTRUMENTS)


def scan_series(spark: SparkSession, path: str) -> DataFrame:
    """Exported Parquet series, several sources or streams at once."""
    df = spark.read.schema(BARS).option("recursiveFileLookup", True).parquet(path)
    return df.withColumn("contract", F.coalesce("contract", F.lit(""))).select(*BAR_COLUMNS)
