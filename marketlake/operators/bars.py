"""Price bars."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The intervals of a multi-timeframe view, in seconds.
INTERVALS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3_600, "1d": 86_400}


def kline_resample(
    ticks: DataFrame,
    every: str = "1h",
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    qty: str = "qty",
    tiebreak: str = "event_id",
    keep_time: str | None = None,
) -> DataFrame:
    """One bar per symbol and interval that has a tick.

    ``event_id`` is the id of the closing tick and ``endtime`` the end of the
    interval. One hash aggregation with partial results before the shuffle: a hot
    symbol costs no more than its number of bars, and no tick is sorted. Ticks without
    a price open and close no bar. ``keep_time`` names a last column for the event time of a bar
    of a stream, which further operators with state need.
    """
    # a column of its own: three of the sums below look at it
    ordered = ticks.withColumn("_at", F.when(F.col(price).isNotNull(), _order(ts, tiebreak)))
    grouped, start = _by_interval(ordered, symbol, ts, every)
    return grouped.agg(
        F.max_by(tiebreak, "_at").alias("event_id"),
        F.min_by(price, "_at").alias("open"),
        F.max_by(price, "_at").alias("close"),
        F.max(price).alias("highest"),
        F.min(price).alias("lowest"),
        F.sum(qty).alias("volume"),
        F.sum(F.col(price) * F.col(qty)).alias("quotevolume"),
    ).select(
        "event_id",
        "symbol",
        F.lit(every).alias("interval"),
        start.alias("starttime"),
        (start + _length(every)).alias("endtime"),
        "open",
        "highest",
        "lowest",
        "close",
        "volume",
        "quotevolume",
        *([F.window_time("window").alias(keep_time)] if keep_time else []),
    )


def _order(ts: str, tiebreak: str) -> Column:
    """Instant and id as one number, which a hash aggregation can hold; a struct it cannot."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(19,0)")
    id = F.col(tiebreak).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))  # 0 or more, below 2 * 10^19
    return (micros * F.lit(Decimal(2 * 10**19)) + id).cast("decimal(38,0)")


def _length(every: str) -> Column:
    return F.make_dt_interval(secs=F.lit(INTERVALS[every]))


def _by_interval(df: DataFrame, symbol: str, ts: str, every: str):
    """Rows grouped by symbol and interval, and the column with the start of the interval.

    Streams must group by the window itself, which carries the watermark. Batches
    group by its start alone, a plain number to hash and sort.
    """
    window = F.window(ts, f"{INTERVALS[every]} seconds")
    named = F.col(symbol).alias("symbol")
    if df.isStreaming:
        return df.groupBy(named, window), F.col("window.start")
    started = df.withColumn("_start", window.start)
    return started.groupBy(named, "_start"), F.col("_start")


def kline_rollup(bars: DataFrame, every: str) -> DataFrame:
    """Longer bars from shorter ones of :func:`kline_resample`; equal to bars from the ticks."""
    grouped, start = _by_interval(bars, "symbol", "starttime", every)
    return grouped.agg(
        F.max_by("event_id", "starttime").alias("event_id"),
        F.min_by("open", "starttime").alias("open"),
        F.max("highest").alias("highest"),
        F.min("lowest").alias("lowest"),
        F.max_by("close", "starttime").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("quotevolume").alias("quotevolume"),
    ).select(
        "event_id",
        "symbol",
        F.lit(every).alias("interval"),
        start.alias("starttime"),
        (start + _length(every)).alias("endtime"),
        "open",
        "highest",
        "lowest",
        "close",
        "volume",
        "quotevolume",
    )
