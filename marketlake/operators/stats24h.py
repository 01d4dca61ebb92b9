"""24-hour price change, decaying maximum and rolling maximum."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import join_summary
from .slices import CANDLES, DAY_SECONDS, Series
from .topk import latest_per_symbol

# Newest candles shown per symbol, and the age at which a maximum expires.
SHOWN = 350
DAY_MICROS = DAY_SECONDS * 1_000_000


def price_change_24h(
    df: DataFrame, series: Series = CANDLES, close: str = "close", shown: int = SHOWN
) -> DataFrame:
    """The newest candles of every symbol against the close exactly 24 hours before the newest.

    No candle at that instant gives NULL, several give one row each, and a
    reference price of 0 gives a NULL percentage. ``place`` counts from the newest.
    """
    symbol, ts = series.symbol, series.ts
    rows = df.select(symbol, ts, series.tiebreak, close)
    newest = rows.groupBy(symbol).agg((F.max(ts) - F.expr("INTERVAL 24 HOURS")).alias(ts))
    # One row per symbol. Should it be too large to broadcast: joined on symbol and
    # instant, no symbol is hot.
    reference = join_summary(rows, newest, [symbol, ts]).select(symbol, F.col(close).alias("_then"))
    shown_rows = latest_per_symbol(rows, shown, symbol, ts, series.tiebreak)
    place = F.row_number().over(Window.partitionBy(symbol).orderBy(*series.descending()))
    diff = F.col(close) - F.col("_then")
    return (
        shown_rows.withColumn("place", place)
        .join(reference, symbol, "left")
        .select(
            symbol,
            "place",
            ts,
            close,
            F.round(diff, 2).alias("price_diff"),
            F.round(F.try_divide(diff, F.col("_then")) * 100, 2).alias("percent_change"),
        )
    )


# --- decaying maximum ---------------------------------------------------------
# A symbol holds one candle as its maximum. A later candle takes over when its
# close is higher, or when it is 24 hours younger or more. So the candle that
# takes over from a given holder does not depend on anything before the holder,
# and a slice of the history can be summed up on its own: for each candle that
# might be the first of the slice to take over, which candle holds at its end.
# Only candles of the first 24 hours of a slice and the one after them can be
# first, and neighbours with the same end holder are kept as one run.

SUMMARY = (
    "symbol string, slice long, run int, run_max double, run_last long,"
    " exit_value double, exit_ts long"
)


def _end_holders(ts: np.ndarray, close: np.ndarray) -> np.ndarray:
    """For every candle of a slice: the holder at the end if this candle takes over."""
    n = len(ts)
    expires = np.searchsorted(ts, ts + DAY_MICROS, side="left")
    end = np.arange(n)
    higher: list[int] = []  # candles to the right with ever higher closes
    for i in range(n - 1, -1, -1):
        while higher and close[higher[-1]] <= close[i]:
            higher.pop()
        successor = min(higher[-1] if higher else n, expires[i])
        if successor < n:
            end[i] = end[successor]
        higher.append(i)
    return end


def summarise_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    """Runs of possible first holders of one slice with the holder they end in."""
    pdf = pdf.sort_values(["ts", "tiebreak"], kind="stable")
    ts, close = pdf["ts"].to_numpy(), pdf["close"].to_numpy()
    end = _end_holders(ts, close)
    first = min(int(np.searchsorted(ts, ts[0] + DAY_MICROS, side="left")) + 1, len(ts))
    starts = np.flatnonzero(np.r_[True, end[1:first] != end[: first - 1]])
    stops = np.r_[starts[1:], first]
    exits = end[starts]
    return pd.DataFrame(
        {
            "symbol": pdf["symbol"].iloc[0],
            "slice": pdf["slice"].iloc[0],
            "run": np.arange(len(starts), dtype="int32"),
            "run_max": np.maximum.reduceat(close[:first], starts),
            "run_last": ts[stops - 1],
            "exit_value": close[exits],
            "exit_ts": ts[exits],
        }
    )


def follow(state: tuple[float, int] | None, runs: Iterable) -> tuple[float, int] | None:
    """Carry the holder through the runs of a symbol, in order of slice and run."""
    taken = None
    for run in runs:
        if run.slice == taken:
            continue
        if state is None or run.run_max > state[0] or run.run_last - state[1] >= DAY_MICROS:
            state = (float(run.exit_value), int(run.exit_ts))
            taken = run.slice
    return state


def slice_summaries(df: DataFrame, series: Series, close: str = "close") -> DataFrame:
    """One group per symbol and slice; works on batches and on micro-batches."""
    return (
        df.where(F.col(close).isNotNull())
        .select(
            F.col(series.symbol).alias("symbol"),
            series.slice_number().alias("slice"),
            F.unix_micros(F.col(series.ts).cast("timestamp")).alias("ts"),
            F.col(series.tiebreak).alias("tiebreak"),
            F.col(close).cast("double").alias("close"),
        )
        .groupBy("symbol", "slice")
        .applyInPandas(summarise_slice, SUMMARY)
    )


def max_24h_cache(
    df: DataFrame,
    state: DataFrame | None = None,
    series: Series = Series(slice_seconds=16 * DAY_SECONDS),
    close: str = "close",
) -> DataFrame:
    """The held maximum of every symbol after all candles, and when it was reached.

    This is the maximum that is replaced by a higher close and dropped once a
    candle comes 24 hours or more after it; it is not the maximum of the last 24
    hours. ``state`` holds the maxima before these candles.

    Slices are worked on side by side; per symbol only their runs, a few per
    slice, are gone through in order.
    """
    runs = slice_summaries(df, series, close)
    if state is not None:
        held = state.select(
            F.col("symbol"),
            F.lit(-(2**62)).cast("long").alias("slice"),
            F.lit(0).cast("int").alias("run"),
            F.col("max_value").cast("double").alias("run_max"),
            F.unix_micros(F.col("max_timestamp").cast("timestamp")).alias("run_last"),
            F.col("max_value").cast("double").alias("exit_value"),
            F.unix_micros(F.col("max_timestamp").cast("timestamp")).alias("exit_ts"),
        )
        runs = runs.unionByName(held)

    def last_holder(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(["slice", "run"])
        value, ts = follow(None, ordered.itertuples(index=False))
        return pd.DataFrame({"symbol": [pdf["symbol"].iloc[0]], "max_value": [value], "ts": [ts]})

    held = runs.groupBy("symbol").applyInPandas(
        last_holder, "symbol string, max_value double, ts long"
    )
    return held.select("symbol", "max_value", F.timestamp_micros("ts").alias("max_timestamp"))


def max_cache_upsert(
    cache: DataFrame, newest: DataFrame, close: str = "close", ts: str = "endtime"
) -> DataFrame:
    """The cache after one newest candle per symbol: insert, keep, replace or reset.

    One full outer join; the parquet cache is then overwritten as a whole.
    """
    old = cache.select("symbol", "max_value", "max_timestamp")
    new = newest.select("symbol", F.col(close).alias("_close"), F.col(ts).alias("_ts"))
    joined = old.join(new, "symbol", "full")
    expired = F.unix_micros(F.col("_ts").cast("timestamp")) - F.unix_micros(
        F.col("max_timestamp").cast("timestamp")
    ) >= F.lit(DAY_MICROS)
    takes_over = F.col("max_timestamp").isNull() | expired | (F.col("_close") > F.col("max_value"))
    return joined.select(
        "symbol",
        F.when(takes_over, F.col("_close")).otherwise(F.col("max_value")).alias("max_value"),
        F.when(takes_over, F.col("_ts")).otherwise(F.col("max_timestamp")).alias("max_timestamp"),
    )


def not_exists_anti(newest: DataFrame, cache: DataFrame, key: str = "symbol") -> DataFrame:
    """Newest rows whose key the cache does not hold yet: the ones to insert."""
    return newest.join(cache.select(key), key, "left_anti")


def update_from_join(
    cache: DataFrame, newest: DataFrame, close: str = "close", ts: str = "endtime"
) -> DataFrame:
    """Cached rows that have a newest candle, after the update."""
    known = newest.join(cache.select("symbol"), "symbol", "left_semi")
    touched = cache.join(newest.select("symbol"), "symbol", "left_semi")
    return max_cache_upsert(touched, known, close, ts)


def rolling_max_24h(df: DataFrame, series: Series = CANDLES, close: str = "close") -> DataFrame:
    """Highest close of the 24 hours up to and including every candle, both ends included.

    A frame of 24 hours holds up to 86,400 candles, too many to go through for
    every row. Instead each candle looks at two running maxima: of its own day up
    to itself, and of the day before from the same time of day on. For the second
    one every candle is also sent to the next day, as an elder. The work is two
    sorts per symbol and day, however dense the candles are.
    """
    symbol, ts = series.symbol, series.ts
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    day = F.floor(micros / F.lit(DAY_MICROS)).cast("long")
    twice = df.withColumns({"_time": micros - day * DAY_MICROS, "_own": day}).select(
        "*", F.explode(F.array(F.col("_own"), F.col("_own") + 1)).alias("_day")
    )
    elder = F.col("_day") > F.col("_own")
    # Frames without bounds but the current row include all rows of the same time.
    by_day = Window.partitionBy(symbol, "_day")
    earlier = by_day.orderBy(F.col("_time").asc())
    later = by_day.orderBy(F.col("_time").desc())
    today = F.max(F.when(~elder, F.col(close))).over(earlier)
    yesterday = F.max(F.when(elder, F.col(close))).over(later)
    return (
        twice.withColumn("_today", today)
        .withColumn("_yesterday", yesterday)
        .where(~elder)
        .withColumn("max_24h", F.greatest("_today", "_yesterday"))
        .select(*df.columns, "max_24h")
    )
