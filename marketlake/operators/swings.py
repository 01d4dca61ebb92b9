"""Divergence between confirmed swing points of the price and an indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .indicators import EMA_FAST, EMA_SLOW, RSI, WINDOW, _add_delta, _add_macd, _add_rsi, _price
from .slices import CANDLES, HALO, SLICE, Series, with_row_halo, without_halo

WING = 3  # candles at each side that a swing point stands out from
VALUES = ("rsi", "macd")


def swing_points(df: DataFrame, wing: int = WING, series: Series = CANDLES) -> DataFrame:
    """One row per confirmed peak or trough: symbol, time and id of the candle that confirms it, ``swing``,
    ``swing_at``, ``price``, ``rsi`` and ``macd`` at the point.

    A peak closes above the ``wing`` candles before it and not below the ``wing`` after it, so the first candle of
    a plateau is the peak; a trough is the same downwards. It is known only once the last of those
    candles has closed, and that is where its row stands: nothing looks ahead. Indicators are
    compared at six decimals.
    """
    halo = with_row_halo(df, series, 2 * wing + WINDOW)
    halo = _add_rsi(_add_delta(halo, series), series, RSI, "_rsi").drop("price_delta")
    halo = _add_macd(halo, series, EMA_FAST, EMA_SLOW, WINDOW).drop("_fast")
    halo = halo.withColumn("_close", _price("close"))
    ordered = series.window()
    early, late = ordered.rowsBetween(-2 * wing, -wing - 1), ordered.rowsBetween(1 - wing, 0)
    there = lambda c: F.lag(c, wing).over(ordered)
    complete = F.count("_close").over(ordered.rowsBetween(-2 * wing, 0)) == 2 * wing + 1
    halo = halo.withColumns(
        {
            "swing_at": there(series.ts), "price": there("_close"), "rsi": F.round(there("_rsi"), 6), "_macd": F.round(there("macd"), 6),
            "_peak": complete & (there("_close") > F.max("_close").over(early)) & (there("_close") >= F.max("_close").over(late)),
            "_trough": complete & (there("_close") < F.min("_close").over(early)) & (there("_close") <= F.min("_close").over(late)),
        }
    )
    swing = F.when(F.col("_peak"), "peak").when(F.col("_trough"), "trough")
    found = without_halo(halo.withColumn("swing", swing).where("swing IS NOT NULL"))
    return found.select(series.symbol, series.ts, series.tiebreak, "swing", "swing_at", "price", "rsi", F.col("_macd").alias("macd"))


def swing_divergence(df: DataFrame, wing: int = WING, series: Series = CANDLES) -> DataFrame:
    """Every confirmed swing point with ``price_before``, that of the swing point of its kind before it, and
    ``rsi_divergence`` and ``macd_divergence``: ``bearish`` where a peak is higher than the one before while the
    indicator is not, ``bullish`` where a trough is lower while it is not, else ``none``.

    The point before may lie in any earlier slice; it is handed over slices as a halo of the points, which
    are far fewer than candles.
    """
    points = swing_points(df, wing, series)
    # the last peak and the last trough before a slice: its halo holds one of each kind
    marked = points.withColumn("_kind", F.concat_ws("|", series.symbol, "swing"))
    kinds = Series("_kind", series.ts, series.tiebreak, series.slice_seconds * 64)
    halo = with_row_halo(marked, kinds, 1)
    ordered = Window.partitionBy("_kind", SLICE).orderBy(*kinds.ascending())
    before = {c: F.lag(c).over(ordered) for c in ("price", *VALUES)}
    halo = halo.withColumns({f"_{c}": v for c, v in before.items()})
    higher = (F.col("swing") == "peak") & (F.col("price") > F.col("_price"))
    lower = (F.col("swing") == "trough") & (F.col("price") < F.col("_price"))
    marks = {
        f"{v}_divergence": F.when(higher & (F.col(v) <= F.col(f"_{v}")), "bearish").when(lower & (F.col(v) >= F.col(f"_{v}")), "bullish").otherwise("none")
        for v in VALUES
    }
    told = halo.where(~F.col(HALO)).withColumns(marks)
    return told.select(*points.columns, F.col("_price").alias("price_before"), *marks)
