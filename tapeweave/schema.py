"""Table schemas and the fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# They name columns, files and messages other tools rely on.
TIMEFRAMES = ("ticks", "minutes", "days")
STREAMS = ("last", "bid", "ask")
PERIOD_TYPES = ("Tick", "Second", "Minute", "Day")
MARKET_DATA_TYPES = ("Last", "Bid", "Ask")
FUTURE = "Future"
DEFAULT_SOURCE = "nt"
EARLIEST = "1990-01-01"

# One bar as a source delivers it: local wall-clock time, fractional volume.
BARS_RAW = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("price_type", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# One bar as the store keeps it; key (symbol, price_type, unix_ms).
BARS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("price_type", T.StringType()),
    T.StructField("unix_ms", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

INSTRUMENTS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("instrument_type", T.StringType()),
    T.StructField("expiry", T.DateType()),
    T.StructField("exchange", T.StringType()),
])

# The progress ledger. The last four columns make it the store's commit log
# as well; from_date / to_date are NULL on commits that claim no coverage.
LEDGER = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("from_date", T.DateType()),
    T.StructField("to_date", T.DateType()),
    T.StructField("bars_count", T.LongType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("batch", T.StringType()),
    T.StructField("generation", T.LongType()),
    T.StructField("commit_key", T.StringType()),
])

KEY = ["symbol", "price_type", "unix_ms"]
SERIES = ["symbol", "contract", "price_type"]
LEDGER_KEY = ["symbol", "contract", "table_name", "from_date", "to_date"]
OHLC = ["open", "high", "low", "close"]
BAR_COLUMNS = BARS.fieldNames()
CSV_COLUMNS = ["unix_ms", *OHLC, "volume", "contract"]
INTERCHANGE_COLUMNS = ["ts_event", "symbol", "price_type", "source", *OHLC, "volume"]


def check_timeframe(name: str) -> str:
    if name not in TIMEFRAMES:
        raise ValueError(f"timeframe must be one of {TIMEFRAMES}, got {name!r}")
    return name


def check_period(period_type: str, value: int = 1) -> None:
    """Period names are case-sensitive; hourly bars are ('Minute', 60)."""
    if period_type not in PERIOD_TYPES:
        raise ValueError(f"period type must be one of {PERIOD_TYPES}, got {period_type!r}")
    if value < 1:
        raise ValueError(f"period value must be at least 1, got {value}")


def check_market_data_type(name: str) -> str:
    """Case-sensitive ``Last``/``Bid``/``Ask`` to the stored stream name."""
    if name not in MARKET_DATA_TYPES:
        raise ValueError(f"market data type must be one of {MARKET_DATA_TYPES}, got {name!r}")
    return name.lower()


def resolve_streams(which: str | None = "all") -> list[str]:
    """``all`` (or None) or one stream name, any case, blanks around it ignored."""
    name = ("all" if which is None else which).strip().lower()
    if name == "all":
        return list(STREAMS)
    if name not in STREAMS:
        raise ValueError(f"stream must be all, last, bid or ask, got {which!r}")
    return [name]


def timeframe_of(period_type: str) -> str:
    """The store table a period type belongs to."""
    check_period(period_type)
    return {"Tick": "ticks", "Day": "days"}.get(period_type, "minutes")
