"""Technical indicators over candles.

All windows are short and look back only, so a history is cut in slices that
carry the rows before them (see ``slices``). ``indicator_series`` gives every
candle the values that the newest-26 snapshot would have shown at that candle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slices import CANDLES, Series, with_row_halo, without_halo
from .topk import latest_per_symbol
from .volume import profile_of_window

# Window lengths and band width.
WINDOW = 26
SMA = 20
ATR = 14
RSI = 10
EMA_FAST = 12
EMA_SLOW = 26
SIGNAL = 9
BAND = 2
STOCHASTIC = 14
STOCHASTIC_MEAN = 3
NO_LOSS = 1e-10

INDICATORS = ["sma20", "ema12", "rsi10", "macd", "bb", "atr", "va_high", "va_low", "poc"]


def _price(name: str) -> Column:
    return F.col(name).cast("double")


def _add_true_range(df: DataFrame, series: Series) -> DataFrame:
    high, low = _price("highest"), _price("lowest")
    before = F.lag(_price("close")).over(series.window())
    # greatest skips NULL, so the first candle has high - low.
    return df.withColumn(
        "true_range", F.greatest(high - low, F.abs(high - before), F.abs(low - before))
    )


def _add_atr(df: DataFrame, series: Series, n: int, name: str) -> DataFrame:
    return df.withColumn(name, F.avg("true_range").over(series.last(n)))


def _add_delta(df: DataFrame, series: Series) -> DataFrame:
    close = _price("close")
    return df.withColumn("price_delta", close - F.lag(close).over(series.window()))


def _add_rsi(df: DataFrame, series: Series, n: int, name: str) -> DataFrame:
    delta = F.coalesce(F.col("price_delta"), F.lit(0.0))
    frame = series.last(n)
    gain = F.avg(F.greatest(delta, F.lit(0.0))).over(frame)
    loss = F.avg(F.greatest(-delta, F.lit(0.0))).over(frame)
    strength = gain / F.when(loss == 0, F.lit(NO_LOSS)).otherwise(loss)
    return df.withColumn(name, 100 - 100 / (1 + strength))


def fold_ema(values: Column, span: int, window: int) -> Column:
    """Exponential mean of an ordered array, seeded with its first value."""
    alpha = 2.0 / (span + 1)
    return F.aggregate(
        F.slice(values, 2, window),
        F.get(values, F.lit(0)),
        lambda acc, x: F.lit(alpha) * x + F.lit(1 - alpha) * acc,
    )


def _add_ema(df: DataFrame, series: Series, value: Column, spans: dict[str, int], window: int):
    held = df.withColumn("_held", F.collect_list(value).over(series.last(window)))
    folds = {name: fold_ema(F.col("_held"), span, window) for name, span in spans.items()}
    return held.withColumns(folds).drop("_held")


def _add_bands(df: DataFrame, series: Series, n: int, k: float) -> DataFrame:
    close = _price("close")
    frame = series.last(n)
    df = df.withColumns(
        {"bb_middle": F.avg(close).over(frame), "_std": F.stddev_samp(close).over(frame)}
    )
    upper = F.col("bb_middle") + F.lit(float(k)) * F.col("_std")
    lower = F.col("bb_middle") - F.lit(float(k)) * F.col("_std")
    return df.withColumns({"bb_upper": upper, "bb_lower": lower}).withColumn(
        "bb", F.try_divide(F.col("bb_upper") - F.col("bb_lower"), F.col("bb_middle")) * 100
    )


def sma20(df: DataFrame, n: int = SMA, series: Series = CANDLES) -> DataFrame:
    """Mean of the last ``n`` closes, of fewer at the start."""
    halo = with_row_halo(df, series, n - 1)
    return without_halo(halo.withColumn(f"sma{n}", F.avg(_price("close")).over(series.last(n))))


def rolling_std20(df: DataFrame, n: int = SMA, series: Series = CANDLES) -> DataFrame:
    """Sample deviation of the last ``n`` closes; 0 for the first candle, which has none."""
    deviation = F.stddev_samp(_price("close")).over(series.last(n))
    halo = with_row_halo(df, series, n - 1)
    return without_halo(halo.withColumn(f"std{n}", F.coalesce(deviation, F.lit(0.0))))


def true_range(df: DataFrame, series: Series = CANDLES) -> DataFrame:
    return without_halo(_add_true_range(with_row_halo(df, series, 1), series))


def atr14(df: DataFrame, n: int = ATR, series: Series = CANDLES) -> DataFrame:
    """Mean of the last ``n`` true ranges."""
    halo = _add_true_range(with_row_halo(df, series, n), series)
    return without_halo(_add_atr(halo, series, n, f"atr{n}").drop("true_range"))


def price_delta(df: DataFrame, series: Series = CANDLES) -> DataFrame:
    """Close less the close before; NULL for the first candle."""
    return without_halo(_add_delta(with_row_halo(df, series, 1), series))


def rsi10(df: DataFrame, n: int = RSI, series: Series = CANDLES) -> DataFrame:
    """Relative strength from plain means over ``n`` candles.

    Flat prices give 0 and only rising ones nearly 100: a mean loss of 0 is
    replaced by a tiny one.
    """
    halo = _add_delta(with_row_halo(df, series, n), series)
    return without_halo(_add_rsi(halo, series, n, f"rsi{n}").drop("price_delta"))


def ema(df: DataFrame, span: int = EMA_FAST, window: int = WINDOW, series: Series = CANDLES):
    """Exponential mean within the last ``window`` candles, seeded with the oldest of them."""
    halo = with_row_halo(df, series, window - 1)
    return without_halo(_add_ema(halo, series, _price("close"), {f"ema{span}": span}, window))


def _add_macd(df: DataFrame, series: Series, fast: int, slow: int, window: int) -> DataFrame:
    spans = {"_fast": fast, "_slow": slow}
    df = _add_ema(df, series, _price("close"), spans, window)
    return df.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_slow")


def macd_line(
    df: DataFrame,
    fast: int = EMA_FAST,
    slow: int = EMA_SLOW,
    window: int = WINDOW,
    series: Series = CANDLES,
) -> DataFrame:
    halo = with_row_halo(df, series, window - 1)
    return without_halo(_add_macd(halo, series, fast, slow, window).drop("_fast"))


def macd_signal_hist(
    df: DataFrame, signal: int = SIGNAL, window: int = WINDOW, series: Series = CANDLES
) -> DataFrame:
    """Signal line (exponential mean of the last ``window`` MACD values) and histogram."""
    halo = with_row_halo(df, series, 2 * (window - 1))
    halo = _add_macd(halo, series, EMA_FAST, EMA_SLOW, window).drop("_fast")
    halo = _add_ema(halo, series, F.col("macd"), {"macd_signal": signal}, window)
    return without_halo(halo.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")))


def bollinger(df: DataFrame, n: int = SMA, k: float = BAND, series: Series = CANDLES) -> DataFrame:
    """Bands around the mean and their width in per cent of it; NULL for the first candle."""
    halo = with_row_halo(df, series, n - 1)
    return without_halo(_add_bands(halo, series, n, k).drop("_std"))


def stochastic(
    df: DataFrame, n: int = STOCHASTIC, d: int = STOCHASTIC_MEAN, series: Series = CANDLES
) -> DataFrame:
    """%K: place of the close in the range of the last ``n`` candles; %D: mean of the last ``d`` %K."""
    halo = with_row_halo(df, series, n + d - 2)
    low = F.min(_price("lowest")).over(series.last(n))
    high = F.max(_price("highest")).over(series.last(n))
    halo = halo.withColumn("stoch_k", F.try_divide(_price("close") - low, high - low) * 100)
    return without_halo(halo.withColumn("stoch_d", F.avg("stoch_k").over(series.last(d))))


def divergence(df: DataFrame, lookback: int = 14, series: Series = CANDLES) -> DataFrame:
    """``bearish`` where the close exceeds its last ``lookback`` peaks while RSI or MACD does not.

    ``bullish`` is the same for lows. The look-back is our parameter: the
    definition only asks for a period long enough to see a pattern. Indicators
    are compared at six decimals, so that rounding noise makes no peak.
    """
    halo = with_row_halo(df, series, lookback + WINDOW - 1)
    halo = _add_rsi(_add_delta(halo, series), series, RSI, "rsi10").drop("price_delta")
    halo = _add_macd(halo, series, EMA_FAST, EMA_SLOW, WINDOW).drop("_fast")
    before = series.window().rowsBetween(-lookback, -1)
    close = _price("close")
    marks = {}
    for name, value in (("rsi", F.round("rsi10", 6)), ("macd", F.round("macd", 6))):
        peak = (close > F.max(close).over(before)) & (value <= F.max(value).over(before))
        trough = (close < F.min(close).over(before)) & (value >= F.min(value).over(before))
        marks[f"{name}_divergence"] = (
            F.when(peak, "bearish").when(trough, "bullish").otherwise("none")
        )
    return without_halo(halo.withColumns(marks))


def _add_all(df: DataFrame, series: Series) -> DataFrame:
    df = _add_atr(_add_true_range(df, series), series, ATR, "atr")
    df = _add_rsi(_add_delta(df, series), series, RSI, "rsi10")
    df = _add_bands(df, series, SMA, BAND).withColumnRenamed("bb_middle", "sma20")
    held = F.struct(_price("close").alias("close"), _price("volume").alias("volume"))
    return df.withColumn("_window", F.collect_list(held).over(series.last(WINDOW)))


def _finish(df: DataFrame, series: Series) -> DataFrame:
    closes = F.transform("_window", lambda r: r["close"])
    df = df.withColumn("_closes", closes).withColumns(
        {
            "ema12": fold_ema(F.col("_closes"), EMA_FAST, WINDOW),
            "_slow": fold_ema(F.col("_closes"), EMA_SLOW, WINDOW),
        }
    )
    df = df.withColumn("macd", F.col("ema12") - F.col("_slow"))
    named = profile_of_window(df.drop("_closes", "_slow"), "_window")
    filled = {n: F.coalesce(F.nanvl(F.col(n), F.lit(None)), F.lit(0.0)) for n in INDICATORS}
    return named.withColumns(filled).select(
        series.tiebreak, series.ts, series.symbol, *INDICATORS
    )


def indicator_series(df: DataFrame, series: Series = CANDLES) -> DataFrame:
    """All indicators at every candle, each over the last 26 candles; NULL becomes 0."""
    needed = [series.tiebreak, series.ts, series.symbol, "highest", "lowest", "close", "volume"]
    halo = with_row_halo(df.select(*needed), series, WINDOW - 1)
    # Halo rows are dropped before the array work, they only feed the windows.
    return _finish(without_halo(_add_all(halo, series)), series)


def indicator_snapshot(df: DataFrame, window: int = WINDOW, series: Series = CANDLES) -> DataFrame:
    """All indicators at the newest candle of every symbol."""
    needed = [series.tiebreak, series.ts, series.symbol, "highest", "lowest", "close", "volume"]
    newest = latest_per_symbol(df.select(*needed), window, series.symbol, series.ts, series.tiebreak)
    # Some 26 rows per symbol are left, one slice holds them.
    one_slice = newest.withColumn("_slice", F.lit(0).cast("long"))
    computed = _add_all(one_slice, series).withColumn(
        "_newest", F.lead(series.ts).over(series.window()).isNull()
    )
    return _finish(computed.where("_newest"), series)


def price_axis_domain(
    df: DataFrame, symbol: str = "symbol", close: str = "close", pad: float = 10
) -> DataFrame:
    """Chart range per symbol: lowest close less, highest close plus the padding."""
    return df.groupBy(symbol).agg(
        (F.min(close) - F.lit(pad)).alias("min_price"),
        (F.max(close) + F.lit(pad)).alias("max_price"),
    )
