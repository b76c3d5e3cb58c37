"""The export request: prune, skip covered, merge, mark, write the series."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.functions.time import naive_utc
from tapeweave.operators.bars import in_range, normalize
from tapeweave.operators.catalog import bars_of_contracts, for_root, prune_contracts
from tapeweave.operators.inspect import contract_steps, with_final
from tapeweave.operators.ranges import resolve_range
from tapeweave.schema import TIMEFRAMES, check_timeframe
from tapeweave.session import remove_path, workspace, written
from tapeweave.sources.ledger import unfinished
from tapeweave.sources.sinks import Written, export_csv, export_parquet
from tapeweave.sources.store import BarStore


@dataclass
class ExportResult:
    """What a run did. Every frame is lazy."""

    batch_id: int | None
    contracts: DataFrame
    steps: DataFrame
    rejected: DataFrame
    summary: DataFrame
    series: DataFrame
    outputs: dict[str, str]
    written: dict[str, Written]


def export_series(store: BarStore, catalog: DataFrame, raw: DataFrame, symbol: str | None, timeframe: str,
                  now: datetime, frm: date | None = None, to: date | None = None, tz: str = "UTC",
                  formats: tuple[str, ...] = (), out: str | None = None, replace: bool = False,
                  range_only: bool = False, group_size: int | None = None) -> ExportResult:
    """Bring a root symbol up to date in the store and export its series; None takes all roots at once.

    ``raw`` are source bars in ``tz`` wall-clock time. Contracts whose expiry
    cannot overlap the request are left out, contracts the ledger covers are
    skipped. An open-ended request skips contracts that expired within what is
    covered and loads the days after it of the others. Exports hold the whole
    stored series unless ``range_only``. A run that fails marks nothing; with
    ``group_size`` contracts are merged and marked that many at a time, in
    order of expiry, and a failure keeps the groups before it. ``now`` is an
    instant; without a zone it is UTC.
    """
    symbol = symbol.strip().upper() if symbol is not None else None
    check_timeframe(timeframe)
    unknown = set(formats) - {"csv", "parquet"}
    if symbol == "" or unknown or (formats and not out):
        raise ValueError("the symbol may not be blank, formats are csv or parquet, and exports need a folder")
    request = resolve_range(frm, to, now, tz)
    contracts = prune_contracts(catalog.filter(for_root(symbol)), request.from_date, request.to_date)
    if replace:
        todo = contracts.withColumn("covered_end", F.lit(None).cast("date"))
    elif request.open_ended:
        todo = unfinished(contracts, store.live_ledger(), timeframe, request.from_date)
    else:
        todo = (store.pending(contracts, timeframe, request.from_date, request.to_date)
                .withColumn("covered_end", F.lit(None).cast("date")))
    # Fixed before the merge changes the ledger it was read from.
    todo = written(todo, "todo")
    steps = contract_steps(contracts, todo)

    source = raw if symbol is None else raw.filter(F.col("symbol") == symbol)

    def bars_of(group: DataFrame) -> DataFrame:
        dim = group.groupBy("symbol", "contract").agg(F.min("expiry").alias("expiry"),
                                                      F.min("covered_end").alias("covered_end"))
        scanned = bars_of_contracts(in_range(source, request), dim)
        fresh = F.col("covered_end").isNull() | (F.col("time").cast("date") > F.col("covered_end"))
        return normalize(scanned.filter(fresh), tz, keep=("expiry",))

    numbers: list[int] = []
    for n, group in enumerate(_groups(todo, group_size)):
        # a replaced symbol starts anew once, with its first group
        numbers.append(store.merge(bars_of(group), timeframe, contracts=group, frm=request.from_date, to=request.covered_to,
                                   replace=replace and n == 0, completed_at=naive_utc(now)))
    series = store.read(timeframe, symbol)
    outputs, done = {}, {}
    exported = store.read(timeframe, symbol, *request.instants(tz)) if range_only else series
    wanted = [f for f in ("csv", "parquet") if f in formats]
    if wanted and store.has_bars(timeframe, symbol):
        # several formats are written from one evaluation of the series
        work = workspace(store.spark, "series") if len(wanted) > 1 else None
        if work:
            exported.write.parquet(work)
            exported = store.spark.read.schema(exported.schema).parquet(work)
        for fmt in wanted:
            sink = export_csv if fmt == "csv" else export_parquet
            outputs[fmt] = f"{out.rstrip('/')}/{fmt}/timeframe={timeframe}/run={naive_utc(now):%Y%m%d_%H%M%S}"
            done[fmt] = sink(exported, outputs[fmt])
        if work:
            remove_path(store.spark, work)
    # counted and refused is what was merged, not what the source would say now
    return ExportResult(numbers[-1] if numbers else None, todo, steps, store.refused(timeframe, numbers),
                        with_final(store.staged(numbers), series), series, outputs, done)


def _groups(todo: DataFrame, size: int | None) -> list[DataFrame]:
    """The contracts in groups of ``size`` by expiry; one group of all without a size."""
    if todo.isEmpty():
        return []
    if size is None:
        return [todo]
    names = [tuple(r) for r in todo.groupBy("symbol", "contract").agg(F.min("expiry").alias("e"))
             .orderBy(F.col("e").asc_nulls_last(), "symbol", "contract").select("symbol", "contract").collect()]
    parts = [names[i:i + size] for i in range(0, len(names), size)]
    spark = todo.sparkSession
    return [todo.join(spark.createDataFrame(p, "symbol string, contract string"), ["symbol", "contract"], "left_semi")
            for p in parts]


def export_timeframes(store: BarStore, catalog: DataFrame, sources: dict[str, DataFrame], symbol: str | None,
                      now: datetime, **request) -> tuple[dict[str, ExportResult], dict[str, Exception]]:
    """``export_series`` for ticks, minutes and days in turn, as far as ``sources`` has them.

    A timeframe that fails is reported and does not keep the next from running.
    """
    for name in sources:
        check_timeframe(name)
    done, failed = {}, {}
    for name in TIMEFRAMES:
        if name in sources:
            try:
                done[name] = export_series(store, catalog, sources[name], symbol, name, now, **request)
            except Exception as error:
                failed[name] = error
    return done, failed
