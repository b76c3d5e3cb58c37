"""Trading sessions in exchange time: calendars, their instants in UTC, and bars by session.

A session begins at a wall-clock time of its exchange, so its UTC instant moves
with daylight saving; it lasts until the next session of the calendar begins, so
weekends and holidays belong to the session before them and no tick is lost.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.functions.time import epoch_ms
from tapeweave.operators.resample import ohlcv, order_key
from tapeweave.schema import OHLC, SERIES
from tapeweave.session import join_dim, require_utc

# Opening time on the exchange's clock, and how many days before the trading day that is.
CALENDARS = T.StructType([
    T.StructField("calendar", T.StringType()), T.StructField("zone", T.StringType()),
    T.StructField("opens", T.StringType()), T.StructField("opens_before", T.IntegerType())])
HOLIDAYS = T.StructType([T.StructField("calendar", T.StringType()), T.StructField("day", T.DateType())])
WEEKDAYS = (2, 3, 4, 5, 6)  # Monday to Friday, as dayofweek counts
MARGIN_DAYS = 31  # a session may begin so long before the first instant asked for


def sessions(calendars: DataFrame, holidays: DataFrame, first: date, last: date,
             weekdays: tuple[int, ...] = WEEKDAYS) -> DataFrame:
    """``calendar``, ``session_date``, ``opens_at`` and ``next_at`` (UTC) of the trading days around [first, last].

    A trading day is one of ``weekdays`` that is no holiday of the calendar; a
    holiday without a calendar is one of all. Where the clock skips the opening
    time, the session opens as much later; where it shows it twice, at the first.
    """
    require_utc(calendars.sparkSession)
    days = F.sequence(F.lit((first - timedelta(days=MARGIN_DAYS)).isoformat()).cast("date"),
                      F.lit((last + timedelta(days=MARGIN_DAYS)).isoformat()).cast("date"))
    listed = (calendars.select("*", F.explode(days).alias("session_date"))
              .filter(F.dayofweek("session_date").isin(*weekdays)))
    general = holidays.filter(F.col("calendar").isNull()).select(F.col("day").alias("session_date")).distinct()
    own = holidays.filter(F.col("calendar").isNotNull()).select("calendar", F.col("day").alias("session_date")).distinct()
    open_days = listed.join(general, "session_date", "left_anti").join(own, ["calendar", "session_date"], "left_anti")
    local = F.expr("cast(concat(cast(date_sub(session_date, opens_before) as string), ' ', opens) as timestamp)")
    opens_at = F.to_utc_timestamp(local, F.col("zone"))
    following = Window.partitionBy("calendar").orderBy("session_date")
    return (open_days.select("calendar", "session_date", opens_at.alias("opens_at"))
            .withColumn("next_at", F.lead("opens_at").over(following))
            .filter(F.col("next_at").isNotNull()))


def with_session(bars: DataFrame, listed: DataFrame, of_symbol: DataFrame) -> DataFrame:
    """``bars`` with ``session_date`` and ``opens_at`` of the session that each instant lies in.

    ``of_symbol`` names the ``calendar`` of each symbol. The interval join goes by
    UTC days: a day of a calendar lists the few sessions that touch it, so each
    bar meets one row of at most a few sessions and picks its own. Bars without a
    calendar, or outside the sessions listed, get nulls.
    """
    day = F.explode(F.sequence(F.to_date("opens_at"), F.to_date(F.expr("next_at - interval 1 microsecond"))))
    by_day = (listed.select("calendar", F.struct("opens_at", "next_at", "session_date").alias("s"), day.alias("_day"))
              .groupBy("calendar", "_day").agg(F.sort_array(F.collect_list("s")).alias("_sessions")))
    spread = ["price_type", "unix_ms"]
    named = join_dim(bars.drop("calendar"), of_symbol.select("symbol", "calendar").distinct(), ["symbol"], "left", spread=spread)
    found = join_dim(named.withColumn("_day", F.to_date("timestamp")), by_day, ["calendar", "_day"], "left", spread=spread)
    own = F.expr("get(filter(_sessions, x -> x.opens_at <= timestamp and timestamp < x.next_at), 0)")
    return (found.withColumn("_own", own)
            .select(*[c for c in bars.columns if c not in ("session_date", "opens_at", "calendar")],
                    F.col("_own.session_date").alias("session_date"), F.col("_own.opens_at").alias("opens_at")))


def session_bars(bars: DataFrame, listed: DataFrame, of_symbol: DataFrame, series: list[str] = SERIES) -> DataFrame:
    """One bar per series and trading session, labelled by the session's opening in UTC and its ``session_date``.

    Bars outside every session form one bar per series and UTC day, with a null
    ``session_date``. Order inside a bar is as in ``resample``.
    """
    placed = with_session(bars, listed, of_symbol)
    start = F.coalesce("opens_at", F.date_trunc("DAY", "timestamp"))
    out = (placed.withColumn("_start", start).withColumn("_order", order_key(placed))
           .groupBy(*series, "session_date", "_start").agg(*ohlcv(F.col("_order"))))
    return out.select(*series, "session_date", epoch_ms(F.col("_start")).alias("unix_ms"), F.col("_start").alias("timestamp"),
                      *OHLC, "volume", "n")
