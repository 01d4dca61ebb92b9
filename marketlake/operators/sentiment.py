"""Sentiment labels of indicators, and the regime over several intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label
from .indicators import EMA_FAST, EMA_SLOW, WINDOW, fold_ema
from .topk import latest_per_symbol

# Label column, rule set, indicator it reads.
LABELS = (
    ("rsi_sen", "rsi", "rsi10"),
    ("macd_sen", "macd", "macd"),
    ("ema_sen", "ema", "ema12"),
    ("bb_sen", "bb", "bb"),
    ("sma_sen", "sma", "sma20"),
    ("atr_sen", "atr", "atr"),
)


def sentiment_labels(indicators: DataFrame) -> DataFrame:
    """Six labels per row, from the indicator values as they are."""
    return indicators.withColumns({name: label(kind, value) for name, kind, value in LABELS})


def market_regime(bars: dict[str, DataFrame]) -> DataFrame:
    """Trend of every interval and the regime they add up to.

    The trend of an interval is the sign of the fast less the slow exponential
    mean over its newest 26 bars. All up: bullish; all down: bearish; no
    direction anywhere: neutral; anything mixed: transitional.
    """
    trends = []
    for interval, df in bars.items():
        newest = latest_per_symbol(df.select("symbol", "endtime", "event_id", "close"), WINDOW)
        closes = F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct("endtime", "event_id", F.col("close").cast("double").alias("close"))
                )
            ),
            lambda r: r["close"],
        )
        held = newest.groupBy("symbol").agg(closes.alias("_closes"))
        fast, slow = (fold_ema(F.col("_closes"), span, WINDOW) for span in (EMA_FAST, EMA_SLOW))
        trends.append(
            held.select(
                "symbol",
                F.lit(interval).alias("interval"),
                F.signum(F.round(fast - slow, 9)).cast("int").alias("trend"),
            )
        )
    # One row per symbol and interval, so the last shuffle is tiny.
    voted = reduce(DataFrame.unionByName, trends).groupBy("symbol").agg(
        *[F.max(F.when(F.col("interval") == i, F.col("trend"))).alias(f"trend_{i}") for i in bars],
        F.min("trend").alias("_min"),
        F.max("trend").alias("_max"),
    )
    return voted.withColumn(
        "regime",
        F.when(F.col("_min") == 1, "bullish")
        .when(F.col("_max") == -1, "bearish")
        .when((F.col("_min") == 0) & (F.col("_max") == 0), "neutral")
        .otherwise("transitional"),
    ).drop("_min", "_max")
