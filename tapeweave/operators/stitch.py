"""One row per key: within a contract, across contracts, and by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeweave.schema import OHLC
from tapeweave.session import join_dim

FAR_EXPIRY = "9999-12-31"
# The key with its most varied part first: the ranking sort then compares
# 64-bit prefixes that seldom tie, instead of a few repeated symbols.
RANK_KEY = ["unix_ms", "symbol", "price_type"]


def top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key.

    A ranking window with a limit of one: every map task first reduces its own
    rows to one per key, so a key that holds a large share of all rows puts at
    most one row per map task on the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_order() -> list[Column]:
    """Higher volume first; equal volumes are settled by price, then by the finer time.

    Plain columns only: an expression here would travel through the shuffle
    as a column of its own.
    """
    return [*[F.col(c).desc() for c in ("volume", "close", "high", "low", "open")], F.col("timestamp").asc()]


def preference() -> list[Column]:
    """Order in which bars of one key win: volume, then earlier expiry.

    Expiry order is the order contracts are loaded in, so this is the strictly
    higher volume replacing the bar already there. What follows makes the
    order total.
    """
    volume, *rest = dedup_order()
    return [volume, F.col("expiry").asc_nulls_last(), F.col("contract").asc(), *rest]


def dedup(bars: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One bar per key within each contract."""
    return top_one(bars, keys or [*RANK_KEY, "contract"], dedup_order())


def with_expiry(bars: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Add ``expiry`` from the catalog unless the bars already carry it.

    Futures only, and of a contract that is listed twice the earliest expiry,
    whatever the order of the rows.
    """
    if "expiry" in bars.columns:
        return bars
    if catalog is None:
        return bars.withColumn("expiry", F.lit(None).cast("date"))
    dim = one_expiry(catalog)
    return join_dim(bars, dim, ["symbol", "contract"], "left", spread=["price_type", "unix_ms"])


def one_expiry(catalog: DataFrame) -> DataFrame:
    """(symbol, contract, expiry) with one row per future."""
    if "instrument_type" in catalog.columns:
        catalog = catalog.filter(F.col("instrument_type") == "Future")
    return catalog.groupBy("symbol", "contract").agg(F.min("expiry").alias("expiry"))


def stitch(bars: DataFrame, catalog: DataFrame | None = None, keep_all_ticks: bool = False) -> DataFrame:
    """The continuous series: per (symbol, price_type, unix_ms) the bar that wins.

    Streams are settled separately, instants only one contract has survive,
    and ``contract`` names the winner. Ticks of one millisecond collapse to
    one unless ``keep_all_ticks`` adds ``seq`` to the key.
    """
    keys = [*RANK_KEY, "seq"] if keep_all_ticks else list(RANK_KEY)
    return top_one(with_expiry(bars, catalog), keys, preference())


def latest_wins(rows: DataFrame, sequence: list[Column],
                keys: tuple[str, ...] = ("ts_event", "symbol", "price_type")) -> DataFrame:
    """Keyed upsert by arrival: the highest ``sequence`` per key stays.

    An interchange file holds one contract, so its key (price_type, ts_event)
    gains ``symbol`` here, where one table holds many.
    """
    return top_one(rows, list(keys), [c.desc() for c in sequence])


def winner() -> Column:
    """The same choice as ``stitch`` as one aggregate, for streaming state.

    A minimum over a struct in the order of ``preference``, descending fields
    negated. One contract sending one instant twice with equal volume and a
    NaN price is the only case where it may pick the other of the two.
    """
    return F.min(F.struct(
        (-F.col("volume")).alias("volume"),
        F.coalesce(F.col("expiry"), F.lit(FAR_EXPIRY).cast("date")).alias("expiry"), F.col("contract"),
        *[(-F.col(c)).alias(c) for c in ("close", "high", "low", "open")], F.col("timestamp")))


def unpack_winner(df: DataFrame, name: str = "w") -> DataFrame:
    """Columns of a ``winner`` aggregate, negations undone."""
    w = F.col(name)
    return df.select(*[c for c in df.columns if c != name],
                     w["contract"].alias("contract"), w["timestamp"].alias("timestamp"),
                     *[(-w[c]).alias(c) for c in OHLC], (-w["volume"]).alias("volume"))
