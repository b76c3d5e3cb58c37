"""What several operators share: tables, written intermediates, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.session import workspace

# ASCII white space: x20 and x09 to x0D.
WS = " \t\n\x0b\x0c\r"
ROWS = 1000  # that a task makes a column for in one step
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def give_back() -> None:
    """Return freed memory to the machine: a Python worker lives on after its task and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``rows`` rows; memory is given back behind the last one."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    give_back()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and go on from the files: later
    steps read them whichever executors are lost, and the plan stays short."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_counted(rows: DataFrame, dim: DataFrame, keys: list[str], n: str, total: int, hot: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``dim``, one row per key, whose ``n`` says how many of the ``total`` rows have it.

    Keys of more than a ``hot``-th of all rows, fewer than ``hot``, are joined by broadcast, the others
    by a shuffle in which no key holds more. Column ``n`` is dropped.
    """
    often = F.broadcast(dim.where(F.col(n) * hot > total).drop(n))
    seldom = dim.where(F.col(n) * hot <= total).drop(n)
    return rows.join(often, keys).unionByName(rows.join(often.select(*keys), keys, "left_anti").join(seldom, keys))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` (bigint columns ``a`` and ``b``).

    Returns ``node`` and ``component`` (smallest node reachable), one row per
    node that has an edge to another one. Each round hooks every node to its
    smallest neighbour, follows the pointers once and contracts the edges, so
    the edge table shrinks; hubs are met by partial aggregates and by joins
    that adaptive execution can split. Nulls and self loops are ignored; an
    empty table gives an empty result.
    """
    spark = edges.sparkSession
    live = saved(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                 .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .distinct(), "edges")
    labels: DataFrame | None = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hook = saved(hook.select("node", F.least("node", "low").alias("up")), "hooks")
        top = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hook = saved(hook.join(top, "up", "left")
                     .select("node", F.coalesce("top", "up").alias("up")), "hooks")
        if labels is None:
            labels = hook.select("node", F.col("up").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "up")
            labels = saved(labels.join(step, "component", "left")
                           .select("node", F.coalesce("up", "component").alias("component")), "labels")
        ends = hook.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        live = live.join(ends, "a").join(ends.select(F.col("a").alias("b"), F.col("ua").alias("ub")), "b")
        live = saved(live.where("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
                     .distinct(), "edges")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    return labels


def with_column(df: DataFrame, source: str, out: str, kind: T.DataType, run: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with ``run`` over ``source`` as its last column ``out``."""
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, kind)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = run(batch.column(batch.schema.get_field_index(source)))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), made],
                                             [*keep, out])

    return df.mapInArrow(each, schema)
