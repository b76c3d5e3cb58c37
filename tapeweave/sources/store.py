"""The keyed bar store: immutable Parquet files made visible by numbered commits."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.functions.time import MICROS_PER_MS, instant, micros_of
from tapeweave.operators.bars import bar_columns, with_reject_reason
from tapeweave.operators.inspect import store_summary
from tapeweave.operators.stitch import RANK_KEY, dedup_order, preference, top_one, with_expiry
from tapeweave.schema import BAR_COLUMNS, BARS, KEY, LEDGER, TIMEFRAMES, check_timeframe
from tapeweave.session import BROADCAST_ROWS, remove_path, require_utc, workspace
from tapeweave.sources import ledger as led
from tapeweave.sources.commits import ADD, FILLED, HOLE, MARK, REMOVE, STAGED, CommitLog, Conflict, File, Snapshot, moved
from tapeweave.sources.key_ranges import due, holes_of, overlapping

_LAYOUT = ["timeframe", "batch", "symbol"]
_STORED = T.StructType([f for f in BARS.fields if f.name != "symbol"]
                       + [T.StructField(c, T.StringType()) for c in _LAYOUT])
_FILES = T.StructType([T.StructField(c, T.StringType()) for c in ("table_name", "symbol", "batch", "path")]
                      + [T.StructField("streams", T.ArrayType(T.StringType()))]
                      + [T.StructField(c, T.LongType()) for c in ("low", "high", "rows", "bytes", "run")])
TRIES = 5  # of a compaction whose files others take away


class BarStore:
    """Bars keyed by (symbol, price_type, unix_ms) per timeframe.

    A merge writes its files to a folder no reader looks at and then commits
    them, with their key ranges and its ledger marks, under the next number. A
    writer that dies in between leaves nothing visible, and nothing is ever
    overwritten in place. Writers may overlap: the number decides the order,
    and so which of two bars of equal volume stays (see ``commits``). Rows the
    store may not hold go to its rejects, with the reason.

    ``fan`` keeps the number of runs small: after each merge, runs of about
    equal size are made one when there are that many (see ``compact_tiers``).
    """

    def __init__(self, spark: SparkSession, path: str, fan: int | None = None):
        require_utc(spark)
        if fan is not None and fan < 2:
            raise ValueError("fan must be at least 2")
        self.spark, self.fan = spark, fan
        self.path = path.rstrip("/")
        self._bars, self._rejects = f"{self.path}/bars", f"{self.path}/rejects"
        self.log = CommitLog(spark, f"{self.path}/log")

    def ledger(self) -> DataFrame:
        return self.log.marks()

    def live_ledger(self) -> DataFrame:
        return led.live_rows(self.ledger())

    def read(self, timeframe: str, symbol: str | None = None, start: datetime | str | None = None,
             end: datetime | str | None = None) -> DataFrame:
        """Current bars: per key the higher volume, on ties the older run.

        Only files whose key ranges overlap those of another run are ranked; the
        others are passed on as they lie. ``start`` and ``end`` (inclusive) leave
        out files by their ranges and then rows; a filter on ``unix_ms`` reaches
        the files as well, because the key is what the ranking partitions by.
        """
        snap = self.log.snapshot()
        low = micros_of(start) // MICROS_PER_MS if start is not None else None
        high = micros_of(end) // MICROS_PER_MS if end is not None else None
        files = [f for f in snap.live(check_timeframe(timeframe), symbol)
                 if (low is None or f.high >= low) and (high is None or f.low <= high)]
        rows = self._current(files, snap)
        if start is not None:
            rows = rows.filter((F.col("unix_ms") >= low) & (F.col("timestamp") >= instant(start)))
        if end is not None:
            rows = rows.filter((F.col("unix_ms") <= high) & (F.col("timestamp") <= instant(end)))
        return rows

    def _current(self, files: Iterable[File], snap: Snapshot) -> DataFrame:
        """Rows of ``files``, one per key, without what later holes have cleared."""
        state = {f.path: holes_of(f, snap.holes) for f in files}
        files = [f for f in files if not state[f.path][0]]
        meet = overlapping(files)
        plain = [f for f in files if f.path not in meet and not state[f.path][1]]
        others = [f for f in files if f.path in meet or state[f.path][1]]
        parts = [self._scan(plain).select(*BAR_COLUMNS)] if plain else []
        if others:
            rows = self._numbered(others)
            for cleared in self._cleared(others, snap):
                rows = rows.filter(~cleared)
            if meet:
                rows = top_one(rows, RANK_KEY, [F.col("volume").desc(), F.col("_run")])
            parts.append(rows.select(*BAR_COLUMNS))
        if not parts:
            return self.spark.createDataFrame([], BARS)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _scan(self, files: list[File]) -> DataFrame:
        return self.scan_paths([f.path for f in files])

    def scan_paths(self, paths: list[str]) -> DataFrame:
        """Rows of stored files as they lie there."""
        rows = self.spark.read.schema(_STORED).option("basePath", self._bars).parquet(*[f"{self._bars}/{p}" for p in paths])
        return rows.withColumn("contract", F.coalesce("contract", F.lit("")))

    def _numbered(self, files: list[File]) -> DataFrame:
        """Rows of ``files`` with the run of their file."""
        runs = {f.run for f in files}
        if len(runs) == 1:
            return self._scan(files).withColumn("_run", F.lit(runs.pop()).cast("bigint"))
        named = self.spark.createDataFrame([(f.batch, f.symbol, f.path.rsplit("/", 1)[1], f.run) for f in files],
                                           "batch string, symbol string, _file string, _run bigint")
        rows = self._scan(files).withColumn("_file", F.col("_metadata.file_name"))
        return rows.join(F.broadcast(named) if len(files) <= BROADCAST_ROWS else named, ["batch", "symbol", "_file"])

    def _cleared(self, files: list[File], snap: Snapshot) -> list[Column]:
        symbols, frames = {f.symbol for f in files}, {f.timeframe for f in files}
        first = min(f.run for f in files)
        return [(F.col("symbol") == h.symbol) & F.col("unix_ms").between(h.low, h.high) & (F.col("_run") < h.version)
                for h in snap.holes if h.symbol in symbols and h.timeframe in frames and h.version > first]

    def rejects(self, timeframe: str | None = None) -> DataFrame:
        """Rows that merges refused: their columns, ``reject_reason``, ``timeframe`` and ``batch``."""
        schema = T.StructType([*BARS.fields, T.StructField("reject_reason", T.StringType()),
                               T.StructField("timeframe", T.StringType()), T.StructField("batch", T.StringType())])
        self.spark.createDataFrame([], schema).write.partitionBy("timeframe", "batch").mode("ignore").parquet(self._rejects)
        rows = self.spark.read.schema(schema).parquet(self._rejects)
        return rows if timeframe is None else rows.filter(F.col("timeframe") == check_timeframe(timeframe))

    def has_bars(self, timeframe: str, symbol: str | None = None) -> bool:
        """Whether the store holds any bar, as the log counts them (rows in a hole included)."""
        return any(f.rows > 0 for f in self.log.snapshot().live(check_timeframe(timeframe), symbol))

    def summary(self, symbol: str | None = None) -> DataFrame:
        """Bars and time range per timeframe, symbol and stream; empty timeframes are listed with 0."""
        return store_summary({t: self.read(t, symbol) for t in TIMEFRAMES})

    def merge(self, bars: DataFrame, timeframe: str, catalog: DataFrame | None = None,
              contracts: DataFrame | None = None, frm: date | None = None, to: date | None = None,
              replace: bool = False, commit_key: str | None = None,
              completed_at: datetime | None = None, clear: tuple[datetime | str, datetime | str] | None = None,
              clear_symbols: list[str] | None = None) -> int | None:
        """Stitch ``bars`` into the store as one run; returns its number.

        ``contracts`` with ``frm``/``to`` are marked covered, those without
        bars too. ``replace`` starts a new generation of every symbol
        named, so its older bars and marks stop being read. ``clear`` drops older
        bars of the symbols named (or of ``clear_symbols``) between two instants,
        both included. A ``commit_key`` already in the log makes the call do
        nothing and return None.
        """
        check_timeframe(timeframe)
        if commit_key is not None and commit_key in self.log.snapshot().keys:
            return None
        batch = uuid.uuid4().hex
        # a commit that is tried again replaces what it refused before
        refusals = hashlib.sha256(commit_key.encode()).hexdigest()[:32] if commit_key else batch
        path = workspace(self.spark, "staged")
        staged, refused = self._stage(bars, catalog, path)
        if refused:
            (staged.filter(F.col("reject_reason").isNotNull()).drop("expiry")
             .write.mode("overwrite").parquet(f"{self._rejects}/timeframe={timeframe}/batch={refusals}"))
        kept = staged.filter(F.col("reject_reason").isNull())
        # The staged rows are one per key and contract. One shuffle by ranges of the key ranks and sorts them.
        self._put(bar_columns(top_one(kept.repartitionByRange(*KEY), KEY, preference())), timeframe, batch)
        added = self._files(timeframe, batch)
        marks = self._marks(kept, contracts)
        counts = (kept.groupBy("symbol", F.array("price_type").alias("streams")).agg(F.count(F.lit(1)).alias("rows"))
                  .select(F.lit(STAGED).alias("kind"), F.lit(timeframe).alias("table_name"), F.lit(batch).alias("batch"),
                          "symbol", "streams", "rows"))

        def build(snap: Snapshot, version: int) -> DataFrame | None:
            if commit_key is not None and commit_key in snap.keys:
                return None
            entries = self._mark_rows(marks, snap, timeframe, batch, version, frm, to, replace, commit_key, completed_at)
            entries = (entries.unionByName(self._file_rows(added, version), allowMissingColumns=True)
                       .unionByName(counts, allowMissingColumns=True))
            if replace or clear:
                named = self._named(marks, clear_symbols)
            if replace:
                gone = [f for f in snap.live(timeframe) if f.symbol in named]
                entries = entries.unionByName(self._removed(gone), allowMissingColumns=True)
            if clear:
                low, high = (micros_of(t) // MICROS_PER_MS for t in clear)
                holes = [Row(kind=HOLE, table_name=timeframe, symbol=s, low=low, high=high) for s in sorted(named)]
                if holes:
                    entries = entries.unionByName(self.spark.createDataFrame(
                        holes, "kind string, table_name string, symbol string, low long, high long"), allowMissingColumns=True)
            return entries

        number = self.log.commit("replace" if replace else "merge", build, commit_key=commit_key, timeframe=timeframe,
                                 batch=batch, refusals=refusals if refused else None)
        remove_path(self.spark, path)
        if number is None:
            remove_path(self.spark, f"{self._bars}/timeframe={timeframe}/batch={batch}")
        elif self.fan:
            self.compact_tiers(timeframe, self.fan)
        return number

    def _named(self, marks: DataFrame, symbols: list[str] | None) -> set[str]:
        """Symbols that a replacement is about: a row per root symbol."""
        return set(symbols) if symbols is not None else {r["symbol"] for r in marks.select("symbol").distinct().collect()}

    def _stage(self, bars: DataFrame, catalog: DataFrame | None, path: str) -> tuple[DataFrame, int]:
        """The input, read once: validated, one bar per key within a contract, every refused row; and how many those are.

        What is merged, counted and refused is taken from these files, so it
        is the same rows whatever happens to the source meanwhile.
        """
        tagged = with_reject_reason(with_expiry(bars, catalog))
        # refused rows have a key of their own and are never each other's duplicates
        own = F.when(F.col("reject_reason").isNotNull(), F.monotonically_increasing_id())
        rows = top_one(tagged.withColumn("_own", own), [*RANK_KEY, "contract", "_own"], dedup_order())
        seen = Observation()
        rows = rows.select(*BAR_COLUMNS, "expiry", "reject_reason")
        rows.observe(seen, F.count("reject_reason").alias("refused")).write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), seen.get["refused"]

    def staged(self, numbers: list[int]) -> DataFrame:
        """Bars per symbol and stream that the commits of these numbers have staged (one per key within a contract)."""
        batches = [c["batch"] for c in self.log.snapshot().commits if c["version"] in set(numbers)]
        rows = self.log.entries().filter((F.col("kind") == STAGED) & F.col("batch").isin(batches))
        return (rows.groupBy("symbol", F.col("streams")[0].alias("price_type"))
                .agg(F.sum("rows").alias("staged_rows")))

    def refused(self, timeframe: str, numbers: list[int]) -> DataFrame:
        """Rows that the commits of these numbers have refused."""
        names = [c["refusals"] for c in self.log.snapshot().commits if c["version"] in set(numbers) and c.get("refusals")]
        return self.rejects(timeframe).filter(F.col("batch").isin(names))

    def replace(self, bars: DataFrame, timeframe: str, **request) -> int | None:
        """``merge`` that drops what the named symbols had in this timeframe."""
        return self.merge(bars, timeframe, replace=True, **request)

    def replace_range(self, bars: DataFrame, timeframe: str, start: datetime | str, end: datetime | str,
                      symbols: list[str] | None = None, **request) -> int | None:
        """``merge`` that first clears the symbols' bars from ``start`` to ``end``, both included.

        The commit records the cleared range; no file is rewritten. Readers leave
        out files that lie inside it and filter those that reach into it, until a
        ``compact`` fills the range for good. Bars outside the range are merged as
        ever. Without ``symbols`` those named by the bars and contracts are cleared.
        """
        if micros_of(end) < micros_of(start):
            raise ValueError("the end must not be before the start")
        return self.merge(bars, timeframe, clear=(start, end), clear_symbols=symbols, **request)

    def compact(self, timeframe: str, symbol: str | None = None) -> int:
        """Rewrite the current bars as one run of a new generation; marks are carried over, holes are filled.

        Merges may go on meanwhile: their runs stay as they are. If another writer
        removes a file that was read here, the work starts again.
        """
        check_timeframe(timeframe)
        for _ in range(TRIES):
            snap = self.log.snapshot()
            files = snap.live(timeframe, symbol)
            if not files:
                return snap.version
            batch = uuid.uuid4().hex
            self._write(self._current(files, snap), timeframe, batch)
            added = self._files(timeframe, batch)
            run = min(f.run for f in files)
            filled = [h for h in snap.holes if h.timeframe == timeframe and symbol in (None, h.symbol)]

            def build(now: Snapshot, version: int) -> DataFrame | None:
                if any(now.files.get(f.path) != f for f in files):
                    return None
                marks = led.live_rows(self.log.marks(now).filter(F.col("table_name") == timeframe))
                if symbol is not None:
                    marks = marks.filter(F.col("symbol") == symbol)
                marks = (marks.withColumn("generation", F.col("generation") + 1).withColumn("batch", F.lit(batch))
                         .withColumn("batch_id", F.lit(version).cast("bigint")).withColumn("kind", F.lit(MARK)))
                rows = (marks.unionByName(self._removed(files), allowMissingColumns=True)
                        .unionByName(self._file_rows(added, run), allowMissingColumns=True))
                return rows.unionByName(self._filled(filled), allowMissingColumns=True)

            number = self.log.commit("compact", build, timeframe=timeframe)
            if number is not None:
                return number
            remove_path(self.spark, f"{self._bars}/timeframe={timeframe}/batch={batch}")
        raise Conflict(f"files of {timeframe} were taken away {TRIES} times")

    def compact_tiers(self, timeframe: str, fan: int = 4) -> int:
        """Make the youngest runs of about one size one run, if there are ``fan``; returns how many rows were rewritten.

        Files that overlap no other of those runs are only renumbered. Each row
        rewritten climbs a size class, so n rows that come in small merges are
        rewritten n log n times in all. Marks are not touched.
        """
        check_timeframe(timeframe)
        rewritten = 0
        for _ in range(TRIES):
            snap = self.log.snapshot()
            files = due(snap.live(timeframe), [h for h in snap.holes if h.timeframe == timeframe], fan)
            if not files:
                return rewritten
            run, batch = min(f.run for f in files), uuid.uuid4().hex
            meet = overlapping(files)
            again = [f for f in files if f.path in meet]
            kept = [moved(f, run) for f in files if f.path not in meet]
            if again:
                self._write(self._current(again, snap), timeframe, batch)
            added = self._files(timeframe, batch) if again else self.spark.createDataFrame([], _FILES)

            def build(now: Snapshot, version: int) -> DataFrame | None:
                if any(now.files.get(f.path) != f for f in files):
                    return None
                return (self._removed(again).unionByName(self._file_rows(added, run), allowMissingColumns=True)
                        .unionByName(self._renumbered(kept), allowMissingColumns=True))

            if self.log.commit("tier", build, timeframe=timeframe) is not None:
                rewritten += sum(f.rows for f in again)
            elif again:
                remove_path(self.spark, f"{self._bars}/timeframe={timeframe}/batch={batch}")
        return rewritten

    def adopt(self, timeframe: str, batch: str, contracts: DataFrame | None = None,
              frm: date | None = None, to: date | None = None) -> int:
        """Commit files that lie in ``bars/timeframe=/batch=/symbol=`` already, as older versions have left them.

        They need not have the ``contract`` column; keys must be unique in the batch.
        """
        added = self._files(check_timeframe(timeframe), batch)
        rows = (self.spark.read.schema(_STORED).option("basePath", self._bars)
                .parquet(f"{self._bars}/timeframe={timeframe}/batch={batch}"))
        marks = self._marks(rows.withColumn("contract", F.coalesce("contract", F.lit(""))), contracts)
        return self.log.commit("merge", lambda snap, version: self._mark_rows(
            marks, snap, timeframe, batch, version, frm, to, False, None, None)
            .unionByName(self._file_rows(added, version), allowMissingColumns=True), timeframe=timeframe)

    def compact_ledger(self) -> None:
        """Write the log's state as one folder; readers start from it."""
        self.log.checkpoint()

    def vacuum(self) -> int:
        """Delete files that commits have removed; returns how many batches lost files.

        Files the log does not name may belong to a merge that is still
        running and are left alone. Reads planned before may lose their files.
        """
        snap = self.log.snapshot()
        alive = {(f.timeframe, f.batch) for f in snap.files.values()}
        dead: dict[tuple[str, str], list[File]] = {}
        for f in snap.removed.values():
            dead.setdefault((f.timeframe, f.batch), []).append(f)
        gone = 0
        for (timeframe, batch), files in dead.items():
            if (timeframe, batch) in alive:
                gone += max([remove_path(self.spark, f"{self._bars}/{f.path}") for f in files])
            else:
                gone += remove_path(self.spark, f"{self._bars}/timeframe={timeframe}/batch={batch}")
        if snap.removed:
            self.log.checkpoint(forget=frozenset(snap.removed))
        return gone

    def pending(self, contracts: DataFrame, timeframe: str, frm: date, to: date) -> DataFrame:
        return led.pending(contracts, self.live_ledger(), timeframe, frm, to)

    def _write(self, rows: DataFrame, timeframe: str, batch: str) -> None:
        # Ranges over the whole key split a dominant symbol evenly and give
        # files that do not overlap in time, so row-group statistics prune.
        self._put(rows.repartitionByRange(*KEY), timeframe, batch)

    def _put(self, ranged: DataFrame, timeframe: str, batch: str) -> None:
        (ranged.sortWithinPartitions(*KEY)
         .write.partitionBy("symbol").parquet(f"{self._bars}/timeframe={timeframe}/batch={batch}"))

    def _files(self, timeframe: str, batch: str) -> DataFrame:
        """Files of a batch with their symbol, streams, key range, rows and size, as they lie there."""
        folder = f"{self._bars}/timeframe={timeframe}/batch={batch}"
        rows = self.spark.read.schema(_STORED).option("basePath", self._bars).parquet(folder)
        path = F.regexp_extract(F.col("_metadata.file_path"), "(timeframe=[^/]*/batch=[^/]*/symbol=[^/]*/[^/]+)$", 1)
        return (rows.groupBy(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))).alias("path"), "symbol")
                .agg(F.collect_set("price_type").alias("streams"), F.min("unix_ms").alias("low"), F.max("unix_ms").alias("high"),
                     F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"))
                .withColumn("table_name", F.lit(timeframe)).withColumn("batch", F.lit(batch)))

    def _file_rows(self, files: DataFrame, run: int) -> DataFrame:
        return files.withColumn("kind", F.lit(ADD)).withColumn("run", F.lit(run).cast("bigint"))

    def _renumbered(self, files: list[File]) -> DataFrame:
        return self._rows_of(files).withColumn("kind", F.lit(ADD))

    def _removed(self, files: list[File]) -> DataFrame:
        return self._rows_of(files).withColumn("kind", F.lit(REMOVE))

    def _rows_of(self, files: list[File]) -> DataFrame:
        return self.spark.createDataFrame([(f.timeframe, f.symbol, f.batch, f.path, list(f.streams), f.low, f.high, f.rows,
                                            f.bytes, f.run) for f in files], _FILES)

    def _filled(self, holes) -> DataFrame:
        return self.spark.createDataFrame([(FILLED, h.timeframe, h.symbol, h.version) for h in holes],
                                          "kind string, table_name string, symbol string, run long")

    def _marks(self, bars: DataFrame, contracts: DataFrame | None) -> DataFrame:
        """Bars per contract; ``bars`` hold no duplicates within one."""
        counted = bars.groupBy("symbol", "contract").agg(F.count(F.lit(1)).alias("bars_count"))
        if contracts is None:
            return counted
        return (contracts.select("symbol", "contract").distinct()
                .join(counted, ["symbol", "contract"], "full")
                .withColumn("bars_count", F.coalesce("bars_count", F.lit(0).cast("bigint"))))

    def _mark_rows(self, marks: DataFrame, snap: Snapshot, timeframe: str, batch: str, batch_id: int,
                   frm: date | None, to: date | None, replace: bool, commit_key: str | None,
                   completed_at: datetime | None) -> DataFrame:
        # Ledger-sized on both sides: Spark measures and chooses this join itself.
        generations = (self.log.marks(snap).filter(F.col("table_name") == timeframe).groupBy("symbol")
                       .agg(F.max("generation").alias("generation")))
        step = 1 if replace else 0
        done = completed_at or datetime.now(timezone.utc)
        return (marks.join(generations, "symbol", "left")
                .withColumn("generation", F.coalesce(F.col("generation") + step, F.lit(1).cast("bigint")))
                .withColumn("table_name", F.lit(timeframe))
                .withColumn("from_date", F.lit(frm.isoformat() if frm else None).cast("date"))
                .withColumn("to_date", F.lit(to.isoformat() if to else None).cast("date"))
                .withColumn("completed_at", instant(done))
                .withColumn("batch", F.lit(batch)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                .withColumn("commit_key", F.lit(commit_key).cast("string"))
                .select(*LEDGER.fieldNames()).withColumn("kind", F.lit(MARK)))
