"""Volume by price: equal-width price bins, point of control and value area."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import join_summary

# Bins, value-area shares, relative widening of the price range,
# decimals of bin borders.
BINS = 24
HIGH_SHARE = 0.7
LOW_SHARE = 0.3
WIDEN = 0.001
DECIMALS = 3
MOST_DECIMALS = 19


def bin_edges(lowest: Column, highest: Column, bins: int = BINS) -> Column:
    """The ``bins + 1`` borders of right-closed bins over a price range.

    The first border lies a thousandth of the range below the lowest price; a
    range without width is widened on both sides instead.
    """
    flat = lowest == highest
    pad = F.when(lowest != 0, F.lit(WIDEN) * F.abs(lowest)).otherwise(F.lit(WIDEN))
    start = F.when(flat, lowest - pad).otherwise(lowest)
    stop = F.when(flat, highest + pad).otherwise(highest)
    step = (stop - start) / F.lit(float(bins))
    first = F.when(flat, start).otherwise(start - F.lit(WIDEN) * (highest - lowest))
    return F.transform(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda i: F.when(i == 0, first).when(i == bins, stop).otherwise(i * step + start),
    )


def bin_number(price: Column, edges: Column, bins: int = BINS) -> Column:
    """Bin of a price, from 1. A division gives a bin that is off by one at most,
    the comparison with its two borders puts it right."""
    low, high = F.element_at(edges, 2), F.element_at(edges, -1)
    # Borders 1 and `bins` of the grid are free of the widened first one.
    width = (high - low) / F.lit(float(bins - 1))
    guess = F.greatest(
        F.lit(1), F.least(F.lit(bins), F.ceil((price - low) / width).cast("int") + 1)
    )
    above = (price > F.get(edges, guess)) & (guess < bins)
    below = (price <= F.get(edges, guess - 1)) & (guess > 1)
    return guess + F.when(above, 1).when(below, -1).otherwise(0)


def _rounded(x: Column, decimals: Column) -> Column:
    """Round half to even; below 1 the decimals count from the first digit that is not 0."""
    small = -F.floor(F.log10(F.abs(x))).cast("int") - 1 + decimals
    scale = F.pow(F.lit(10.0), F.when(F.abs(x) < 1, small).otherwise(decimals))
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def edge_decimals(edges: Column) -> Column:
    """Fewest decimals, from three, that keep all borders apart."""

    def apart(decimals: Column) -> Column:
        shown = F.transform(edges, lambda e: _rounded(e, decimals))
        return F.size(F.array_distinct(shown)) == F.size(edges)

    # One decimal count nearly always fits, so the others are tried only when it fails.
    others = F.filter(F.sequence(F.lit(DECIMALS + 1), F.lit(MOST_DECIMALS)), apart)
    return F.when(apart(F.lit(DECIMALS)), F.lit(DECIMALS)).otherwise(
        F.coalesce(F.get(others, F.lit(0)), F.lit(DECIMALS))
    )


def bin_mid(number: Column, edges: Column, decimals: Column) -> Column:
    """Middle of a bin between its rounded borders; NULL bin gives NULL."""
    low = _rounded(F.get(edges, number - 1), decimals)
    return F.lit(0.5) * (low + _rounded(F.get(edges, number), decimals))


def _binned(df: DataFrame, symbol: str, close: str, volume: str, bins: int) -> DataFrame:
    """Volume per symbol and occupied bin, with the borders of the symbol.

    Price range and bin sums are both combined before their shuffle, and the
    range of a symbol is brought to its rows by a join that needs no shuffle of the rows while symbols are few.
    """
    rows = df.select(
        symbol,
        F.col(close).cast("double").alias("_close"),
        F.col(volume).cast("double").alias("_volume"),
    ).where(F.col("_close").isNotNull())
    ranges = rows.groupBy(symbol).agg(F.min("_close").alias("_lo"), F.max("_close").alias("_hi"))
    # Borders are worked out once per symbol before the join and once per bin after
    # the sum, so the sum itself keeps plain numbers only.
    edges = ranges.withColumn("edges", bin_edges(F.col("_lo"), F.col("_hi"), bins))
    return (
        join_summary(rows, edges, [symbol])
        .withColumn("bin", bin_number(F.col("_close"), F.col("edges"), bins))
        .groupBy(symbol, "bin")
        .agg(F.sum("_volume").alias("volume"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        .withColumn("edges", bin_edges(F.col("_lo"), F.col("_hi"), bins))
        .drop("_lo", "_hi")
    )


def volume_by_price_bin(
    df: DataFrame,
    symbol: str = "symbol",
    close: str = "close",
    volume: str = "volume",
    bins: int = BINS,
) -> DataFrame:
    """Volume per occupied price bin of every symbol, with the rounded borders."""
    found = _binned(df, symbol, close, volume, bins).withColumn("_p", edge_decimals(F.col("edges")))
    return found.select(
        symbol,
        "bin",
        _rounded(F.get("edges", F.col("bin") - 1), F.col("_p")).alias("bin_low"),
        _rounded(F.get("edges", F.col("bin")), F.col("_p")).alias("bin_high"),
        "volume",
    )


def cumulative_share(
    binned: DataFrame, symbol: str = "symbol", bin: str = "bin", volume: str = "volume"
) -> DataFrame:
    """Running volume of the bins from the largest down, and its share of the total.

    The window is over the bins of a symbol, never over its rows.
    """
    down = Window.partitionBy(symbol).orderBy(F.col(volume).desc(), F.col(bin).asc())
    running = F.sum(volume).over(down.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(volume).over(Window.partitionBy(symbol))
    return binned.withColumns(
        {
            "rank": F.row_number().over(down),
            "cumulative": running,
            "share": F.try_divide(running, total),
        }
    )


def poc_top1(
    binned: DataFrame, symbol: str = "symbol", bin: str = "bin", volume: str = "volume"
) -> DataFrame:
    """The bin with the largest volume of every symbol; the lower bin wins a tie."""
    return binned.groupBy(symbol).agg(
        F.max_by(bin, F.struct(F.col(volume), -F.col(bin))).alias("poc_bin"),
        F.max(volume).alias("poc_volume"),
    )


def volume_profile(
    df: DataFrame,
    symbol: str = "symbol",
    close: str = "close",
    volume: str = "volume",
    bins: int = BINS,
    hi: float = HIGH_SHARE,
    lo: float = LOW_SHARE,
) -> DataFrame:
    """Point of control and value area over all rows of every symbol."""
    ranked = cumulative_share(_binned(df, symbol, close, volume, bins), symbol)
    chosen = ranked.groupBy(symbol).agg(
        F.first("edges").alias("edges"),
        F.min(F.when(F.col("rank") == 1, F.col("bin"))).alias("_poc"),
        F.max(F.when(F.col("share") <= hi, F.col("bin"))).alias("_high"),
        F.min(F.when(F.col("share") <= lo, F.col("bin"))).alias("_low"),
    )
    return _mids(chosen.withColumn("_p", edge_decimals(F.col("edges")))).select(
        symbol, "va_high", "va_low", "poc"
    )


def _mids(df: DataFrame) -> DataFrame:
    edges, decimals = F.col("edges"), F.col("_p")
    return df.withColumns(
        {
            name: F.coalesce(bin_mid(F.col(number), edges, decimals), F.lit(0.0))
            for name, number in (("va_high", "_high"), ("va_low", "_low"), ("poc", "_poc"))
        }
    )


def _rounded_rows(x: np.ndarray, decimals: int) -> np.ndarray:
    """The rounding of :func:`_rounded` on arrays."""
    with np.errstate(divide="ignore"):
        digits = -np.floor(np.log10(np.abs(x))) - 1 + decimals
    scale = np.power(10.0, np.where((np.abs(x) < 1) & (x != 0), digits, decimals))
    return np.rint(x * scale) / scale


def window_profiles(
    closes: list[np.ndarray], volumes: list[np.ndarray], bins: int, hi: float, lo: float
) -> pd.DataFrame:
    """Point of control and value area of many short windows at once."""
    n = len(closes)
    sizes = np.array([len(c) for c in closes])
    price, amount = np.concatenate(closes), np.nan_to_num(np.concatenate(volumes))
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    row = np.repeat(np.arange(n), sizes)
    low, high = np.minimum.reduceat(price, starts), np.maximum.reduceat(price, starts)

    flat = low == high
    pad = np.where(flat, np.where(low != 0, WIDEN * np.abs(low), WIDEN), 0.0)
    start, stop = low - pad, high + pad
    edges = np.arange(bins + 1) * ((stop - start) / bins)[:, None] + start[:, None]
    edges[:, bins] = stop
    edges[:, 0] = np.where(flat, start, start - WIDEN * (high - low))

    # Volume per window and bin, then the bins of each window from the largest volume down.
    cell = row * bins + (edges[row] < price[:, None]).sum(axis=1) - 1
    held = np.bincount(cell, minlength=n * bins).reshape(n, bins) > 0
    volume = np.bincount(cell, weights=amount, minlength=n * bins).reshape(n, bins)
    ranked = np.argsort(np.where(held, -volume, np.inf), axis=1, kind="stable")
    running = np.cumsum(np.take_along_axis(volume, ranked, axis=1), axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = running / running[:, -1:]
    occupied = np.take_along_axis(held, ranked, axis=1)
    highest = np.where(occupied & (share <= hi), ranked, -1).max(axis=1)
    lowest = np.where(occupied & (share <= lo), ranked, bins).min(axis=1)

    shown = _rounded_rows(edges, DECIMALS)
    alike = np.flatnonzero((np.diff(np.sort(shown, axis=1), axis=1) == 0).any(axis=1))
    for decimals in range(DECIMALS + 1, MOST_DECIMALS + 1):
        if len(alike) == 0:
            break
        finer = _rounded_rows(edges[alike], decimals)
        apart = (np.diff(np.sort(finer, axis=1), axis=1) > 0).all(axis=1)
        shown[alike[apart]] = finer[apart]
        alike = alike[~apart]

    def mid(bin: np.ndarray, known: np.ndarray) -> np.ndarray:
        at = np.arange(n), np.where(known, bin, 0)
        return np.where(known, 0.5 * (shown[at] + shown[at[0], at[1] + 1]), 0.0)

    return pd.DataFrame(
        {
            "va_high": mid(highest, highest >= 0),
            "va_low": mid(lowest, lowest < bins),
            "poc": mid(ranked[:, 0], np.ones(n, dtype=bool)),
        }
    )


def profile_of_window(
    df: DataFrame, window: str, bins: int = BINS, hi: float = HIGH_SHARE, lo: float = LOW_SHARE
) -> DataFrame:
    """Adds ``va_high``, ``va_low`` and ``poc`` of a short array of (close, volume) structs.

    Every row carries its own window, so there is no shuffle. Array functions can
    say this too, but run it value by value: they took about 600 microseconds a
    row where whole Arrow batches take a few.
    """

    @F.pandas_udf("va_high double, va_low double, poc double")
    def profiles(closes: pd.Series, volumes: pd.Series) -> pd.DataFrame:
        return window_profiles(closes.tolist(), volumes.tolist(), bins, hi, lo)

    keep = df.columns
    area = profiles(F.col(f"{window}.close"), F.col(f"{window}.volume"))
    return df.withColumn("_area", area).select(*keep, "_area.va_high", "_area.va_low", "_area.poc")
