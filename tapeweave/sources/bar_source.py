"""Source bars in folders by contract and day, as a data source that plans by contract and time chunk.

``spark.read.format("bar_folders")`` lists the folders, leaves out contracts and
days that the pushed filters exclude, and reads each contract's days in chunks of
``chunk_days`` as one task; inside a file the filter on ``time`` skips row groups.
Filters it accepts in full are not evaluated again by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.dataset as ads
from pyarrow import compute as pc
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.pandas.types import to_arrow_schema

from tapeweave.schema import BARS_RAW
from tapeweave.sources.sinks import file_system

_NULL = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows whose contract or time is null
_TIME = {GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}


@dataclass
class Chunk(InputPartition):
    """Files of one contract whose days lie in one chunk."""

    contract: str | None
    files: tuple[str, ...]


class BarFolders(DataSource):
    """Options: ``path``, and ``chunk_days`` (30)."""

    @classmethod
    def name(cls) -> str:
        return "bar_folders"

    def schema(self):
        return BARS_RAW

    def reader(self, schema) -> BarReader:
        return BarReader(self.options)


class BarReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("bar_folders needs a path")
        self.path, self.chunk_days = options["path"].rstrip("/"), int(options.get("chunk_days", "30"))
        if self.chunk_days < 1:
            raise ValueError("chunk_days must be at least 1")
        self.contracts: set[str] | None = None
        self.times: list[tuple[type, datetime]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("contract",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.contracts = wanted if self.contracts is None else self.contracts & wanted
            elif type(f) in _TIME and f.attribute == ("time",):
                self.times.append((type(f), f.value.replace(tzinfo=None)))
            else:
                yield f

    def _day_fits(self, day: date) -> bool:
        begin = datetime.combine(day, datetime.min.time())
        end = begin + timedelta(days=1)
        for kind, value in self.times:
            if kind in (GreaterThan, GreaterThanOrEqual) and end <= value:
                return False
            if kind is LessThan and begin >= value or kind is LessThanOrEqual and begin > value:
                return False
        return True

    def partitions(self) -> list[Chunk]:
        files, base = file_system(self.path)
        chunks: dict[tuple[str, int], list[str]] = {}
        for folder in files.get_file_info(afs.FileSelector(base)):
            if folder.type != afs.FileType.Directory or not folder.base_name.startswith("contract="):
                continue
            contract = unquote(folder.base_name.removeprefix("contract="))
            contract = None if contract == _NULL else contract
            if self.contracts is not None and contract not in self.contracts:
                continue
            for info in files.get_file_info(afs.FileSelector(folder.path, recursive=True)):
                if info.is_file and info.extension == "parquet":
                    name = info.path.rsplit("day=", 1)[1].split("/")[0]
                    day = None if name == _NULL else date.fromisoformat(name)
                    if not self.times if day is None else self._day_fits(day):
                        chunk = -1 if day is None else day.toordinal() // self.chunk_days
                        chunks.setdefault((contract, chunk), []).append(info.path)
        return [Chunk(c, tuple(sorted(found))) for (c, _), found in chunks.items()]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no folder fits
            return
        files, _ = file_system(self.path)
        schema = to_arrow_schema(BARS_RAW)
        wanted = None
        for kind, value in self.times:
            term = _TIME[kind](pc.field("time"), pa.scalar(value, pa.timestamp("us")))
            wanted = term if wanted is None else wanted & term
        stored = pa.schema([f for f in schema if f.name != "contract"])
        found = ads.dataset(list(partition.files), schema=stored, format="parquet", filesystem=files)
        for batch in found.to_batches(filter=wanted):
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in stored.names}
            columns["contract"] = pa.repeat(pa.scalar(partition.contract, pa.string()), batch.num_rows)
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def write_bar_folders(raw: DataFrame, out: str) -> None:
    """Source bars as ``contract=.../day=.../*.parquet``, each day in time order; a hot contract is split by time."""
    days = raw.select(*BARS_RAW.fieldNames()).withColumn("day", F.col("time").cast("date"))
    (days.repartitionByRange("contract", "day", "time").sortWithinPartitions("contract", "day", "time")
     .write.partitionBy("contract", "day").parquet(out))


def read_bar_folders(spark: SparkSession, path: str, chunk_days: int = 30) -> DataFrame:
    """The folders through the data source, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BarFolders)
    return spark.read.format("bar_folders").option("path", path).option("chunk_days", chunk_days).load()
