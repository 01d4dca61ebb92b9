"""Indicators against plain Python, on histories that are short, flat, rising or random."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.functions.labels import label
from marketlake.operators import indicators as ind
from marketlake.operators import volume
from marketlake.operators.bars import kline_resample, kline_rollup
from marketlake.operators.sentiment import market_regime
from marketlake.operators.slices import Series

rng = random.Random(7)
HISTORIES = {
    "one": [100.0],
    "five": [100.0, 101.5, 99.0, 100.25, 102.0],
    "thirteen": [50 + rng.gauss(0, 2) for _ in range(13)],
    "n25": [50 + rng.gauss(0, 2) for _ in range(25)],
    "n26": [50 + rng.gauss(0, 2) for _ in range(26)],
    "n27": [0.5 + rng.random() for _ in range(27)],
    "flat": [42.0] * 30,
    "rising": [10.0 + i for i in range(40)],
    "tiny": [1e-4 * (1 + rng.random()) for _ in range(30)],
    "long": [100 + rng.gauss(0, 5) for _ in range(90)],
}


def rows_of(histories, step=1):
    rows = []
    for symbol, closes in histories.items():
        amounts = random.Random(symbol)
        for i, c in enumerate(closes):
            spread = amounts.random()
            rows.append((symbol, i * step, c, c + spread, c - spread / 2, amounts.randint(1, 99)))
    return rows


def mean(values):
    return sum(values) / len(values)


def ema(values, span):
    alpha, out = 2 / (span + 1), values[0]
    for v in values[1:]:
        out = alpha * v + (1 - alpha) * out
    return out


def value_area(closes, volumes):
    """Profile from the intervals that pandas cuts."""
    bins = pd.cut(pd.Series(closes), 24)
    held = {}
    for interval, v in zip(bins, volumes):
        held[interval] = held.get(interval, 0) + v
    order = sorted(held, key=lambda i: (-held[i], i.left))
    total, running, high, low = sum(held.values()), 0, [], []
    for interval in order:
        running += held[interval]
        high += [interval.mid] if running / total <= 0.7 else []
        low += [interval.mid] if running / total <= 0.3 else []
    return max(high, default=0), min(low, default=0), order[0].mid


def expected_last(rows):
    """All indicators at the last of at most 26 candles."""
    rows = rows[-26:]
    close = [r[2] for r in rows]
    ranges = []
    for i, (_, _, _, high, low, _) in enumerate(rows):
        terms = [high - low]
        if i:
            terms += [abs(high - close[i - 1]), abs(low - close[i - 1])]
        ranges.append(max(terms))
    moves = [0.0] + [b - a for a, b in zip(close, close[1:])]
    gain = mean([max(m, 0) for m in moves[-10:]])
    loss = mean([max(-m, 0) for m in moves[-10:]]) or 1e-10
    recent = close[-20:]
    deviation = float(np.std(recent, ddof=1)) if len(recent) > 1 else 0.0
    va_high, va_low, poc = value_area(close, [r[5] for r in rows])
    return {
        "sma20": mean(recent),
        "ema12": ema(close, 12),
        "rsi10": 100 - 100 / (1 + gain / loss),
        "macd": ema(close, 12) - ema(close, 26),
        "bb": 4 * deviation / mean(recent) * 100,
        "atr": mean(ranges[-14:]),
        "va_high": va_high,
        "va_low": va_low,
        "poc": poc,
    }


def close_to(found, expected):
    for name, value in expected.items():
        assert math.isclose(found[name], value, rel_tol=1e-9, abs_tol=1e-9), (name, found[name], value)


def test_snapshot_of_all_histories(candles):
    rows = rows_of(HISTORIES)
    found = {r.symbol: r.asDict() for r in ind.indicator_snapshot(candles(rows)).collect()}
    assert set(found) == set(HISTORIES)
    for symbol in HISTORIES:
        close_to(found[symbol], expected_last([r for r in rows if r[0] == symbol]))


def test_flat_and_rising_prices(candles):
    found = {r.symbol: r for r in ind.indicator_snapshot(candles(rows_of(HISTORIES))).collect()}
    assert found["flat"].rsi10 == 0 and found["flat"].va_high == 0 and found["flat"].va_low == 0
    assert found["rising"].rsi10 > 99.99
    one = found["one"]
    assert (one.macd, one.bb, one.rsi10) == (0, 0, 0) and one.sma20 == one.ema12 == 100


def test_series_is_the_snapshot_at_every_candle(candles):
    rows = rows_of({"long": HISTORIES["long"], "n27": HISTORIES["n27"]}, step=7)
    series = Series(slice_seconds=3_600)
    found = {r.event_id: r.asDict() for r in ind.indicator_series(candles(rows), series).collect()}
    assert len(found) == len(rows)
    for i, row in enumerate(rows):
        history = [r for r in rows[: i + 1] if r[0] == row[0]]
        close_to(found[i], expected_last(history))


@pytest.mark.parametrize("slice_seconds", [60, 600, 86_400])
def test_slices_do_not_change_windows(candles, slice_seconds):
    """Gaps of many slices, single-row slices and equal times give what one window gives."""
    gaps = random.Random(3)
    rows, minute = [], 0
    for _ in range(300):
        minute += gaps.choice([0, 1, 1, 1, 2, 400])
        rows.append(("hot" if gaps.random() < 0.8 else "cold", minute, 100 + gaps.random()))
    df = candles(rows)
    whole = Window.partitionBy("symbol").orderBy("endtime", "event_id")
    expected = df.select(
        "event_id",
        F.avg("close").over(whole.rowsBetween(-19, 0)).alias("sma"),
        (F.col("close") - F.lag("close").over(whole)).alias("delta"),
    )
    series = Series(slice_seconds=slice_seconds)
    found = ind.price_delta(ind.sma20(df, series=series), series)
    assert found.count() == len(rows)
    joined = found.join(expected, "event_id")
    off = joined.where(
        (F.abs(F.col("sma20") - F.col("sma")) > 1e-9)
        | ~F.round("price_delta", 9).eqNullSafe(F.round("delta", 9))
    )
    assert off.count() == 0


def test_profile_of_whole_history_agrees_with_windows(candles):
    """The joined form and the per-window form share their definition."""
    rows = rows_of({k: v for k, v in HISTORIES.items() if len(v) <= 26})
    found = {r.symbol: r for r in volume.volume_profile(candles(rows)).collect()}
    for symbol in found:
        own = [r for r in rows if r[0] == symbol]
        area = value_area([r[2] for r in own], [r[5] for r in own])
        got = (found[symbol].va_high, found[symbol].va_low, found[symbol].poc)
        assert np.allclose(got, area, rtol=1e-12), symbol


def test_price_on_a_border_belongs_to_the_lower_bin(candles):
    rows = [("a", i, float(c)) for i, c in enumerate([0, 24, 1, 2, 12])]
    bins = {r.bin for r in volume.volume_by_price_bin(candles(rows)).collect()}
    assert bins == {1, 2, 12, 24}


def test_equal_volumes_put_the_lower_bin_first(candles):
    rows = [("a", 0, 0.0), ("a", 1, 24.0)]
    profile = volume.poc_top1(volume.volume_by_price_bin(candles(rows))).first()
    assert profile.poc_bin == 1


@pytest.mark.parametrize(
    "kind, value, text",
    [
        ("rsi", 80.0, "Overbought"), ("rsi", 70.0, "Neutral"), ("rsi", 40.0, "Neutral"),
        ("rsi", 20.0, "Oversold"), ("rsi", 19.9, "Extremely oversold"),
        ("macd", 2.0, "Mild bullish crossover"), ("macd", 0.0, "Neutral"),
        ("macd", -2.0, "Mild bearish crossover"), ("macd", -2.1, "Strong bearish crossover"),
        ("ema", 2.1, "Sharp upward momentum"), ("ema", 0.0, "Neutral momentum"),
        ("bb", 1.0, "Mid-band"), ("bb", -1.0, "Mid-band"), ("bb", -2.0, "Near lower band"),
        ("sma", 0.0, "Around SMA"), ("sma", -3.0, "Strongly below SMA"),
        ("atr", 5.0, "High volatility"), ("atr", 3.0, "Moderate volatility"),
        ("atr", 1.0, "Low volatility"), ("atr", 0.0, "Very low volatility"),
    ],
)
def test_label_bounds(spark, kind, value, text):
    assert spark.range(1).select(label(kind, F.lit(value)).alias("l")).first().l == text


def test_regime_votes(candles):
    def bars(closes):
        return candles([(s, i, c) for s, cs in closes.items() for i, c in enumerate(cs)])

    up, down, flat = [1.0, 2.0, 3.0], [3.0, 2.0, 1.0], [2.0, 2.0, 2.0]
    short = bars({"bull": up, "bear": down, "calm": flat, "mix": up})
    long = bars({"bull": up, "bear": down, "calm": flat, "mix": down})
    found = {r.symbol: r.regime for r in market_regime({"1m": short, "1h": long}).collect()}
    assert found == {"bull": "bullish", "bear": "bearish", "calm": "neutral", "mix": "transitional"}


def test_rollup_equals_bars_from_ticks(spark):
    from marketlake.queries.base import ticks

    from .conftest import SMALL

    rows = ticks(spark, SMALL)
    direct = kline_resample(rows, "1d")
    rolled = kline_rollup(kline_resample(rows, "1m"), "1d")
    assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0


def test_first_and_last_tick_of_equal_times(spark):
    rows = [("a", "2024-01-01 00:00:10", 2, 5.0), ("a", "2024-01-01 00:00:10", 1, 7.0)]
    ticks = spark.createDataFrame(rows, "symbol string, t string, event_id long, price double")
    ticks = ticks.withColumns({"ts": F.col("t").cast("timestamp"), "qty": F.lit(1.0)})
    bar = kline_resample(ticks, "1m").first()
    assert (bar.open, bar.close, bar.event_id, bar.highest) == (7.0, 5.0, 2, 7.0)


def test_no_window_holds_a_whole_symbol(candles):
    """Windows over candles run per slice, and the halo is cut before its shuffle."""
    df = ind.indicator_series(candles(rows_of({"long": HISTORIES["long"]})), Series(slice_seconds=3_600))
    plan = df._jdf.queryExecution().executedPlan().toString()
    frames = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    over_candles = [line for line in frames if "collect_list(_tail" not in line]
    assert over_candles and all("_slice" in line for line in over_candles)
    assert "WindowGroupLimit" in plan and "Partial" in plan
