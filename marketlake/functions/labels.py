"""Categorical sentiment of indicator values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import column

# Thresholds and texts per indicator; the first rule that holds
# gives the label, the last entry is what remains.
LABEL_RULES = {
    "rsi": (
        (">", 80, "Extremely overbought"),
        (">", 70, "Overbought"),
        (">=", 40, "Neutral"),
        (">=", 20, "Oversold"),
        (None, None, "Extremely oversold"),
    ),
    "macd": (
        (">", 2, "Strong bullish crossover"),
        (">", 0, "Mild bullish crossover"),
        ("=", 0, "Neutral"),
        (">=", -2, "Mild bearish crossover"),
        (None, None, "Strong bearish crossover"),
    ),
    "ema": (
        (">", 2, "Sharp upward momentum"),
        (">", 0, "Upward momentum"),
        ("=", 0, "Neutral momentum"),
        (">=", -2, "Downward momentum"),
        (None, None, "Sharp downward momentum"),
    ),
    "bb": (
        (">", 2, "Above upper band"),
        (">", 1, "Near upper band"),
        (">=", -1, "Mid-band"),
        (">=", -2, "Near lower band"),
        (None, None, "Below lower band"),
    ),
    "sma": (
        (">", 2, "Strongly above SMA"),
        (">", 0, "Moderately above SMA"),
        ("=", 0, "Around SMA"),
        (">=", -2, "Moderately below SMA"),
        (None, None, "Strongly below SMA"),
    ),
    "atr": (
        (">", 5, "Very high volatility"),
        (">", 3, "High volatility"),
        (">", 1, "Moderate volatility"),
        (">", 0, "Low volatility"),
        (None, None, "Very low volatility"),
    ),
}

_COMPARE = {
    ">": lambda v, bound: v > bound,
    ">=": lambda v, bound: v >= bound,
    "=": lambda v, bound: v == bound,
}


def label(kind: str, value: Column | str) -> Column:
    """The label of one indicator value; NULL stays NULL."""
    v = column(value)
    chain = F.when(v.isNull(), F.lit(None).cast("string"))
    for sign, bound, text in LABEL_RULES[kind]:
        chain = chain.otherwise(text) if sign is None else chain.when(_COMPARE[sign](v, bound), text)
    return chain
