"""Queries: bars, indicators, labels and 24-hour statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import LABEL_RULES
from ..operators import indicators as ind
from ..operators import recursive, regimes, stats24h, swings, topk, volume
from ..operators.bars import INTERVALS, kline_resample, kline_rollup
from ..operators.sentiment import LABELS, market_regime, sentiment_labels
from ..runtime import durable
from .base import (
    HOURS,
    MINUTES,
    bars,
    bars_sql,
    candles_sql,
    load,
    query,
    r6,
    sql_r6,
    ticks,
)

ORDER = "PARTITION BY symbol ORDER BY endtime, event_id"
KEY = "event_id, symbol, endtime"


def last(n: int) -> str:
    return f"({ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def ema_sql(values: str, span: int) -> str:
    """Fold of a list in order, seeded with its first value."""
    alpha = 2.0 / (span + 1)
    return (
        f"list_reduce({values}, lambda acc, x: CAST({alpha!r} AS DOUBLE) * x"
        f" + CAST({1 - alpha!r} AS DOUBLE) * acc)"
    )


C = candles_sql()
DELTA = f"SELECT *, close - lag(close) OVER ({ORDER}) AS price_delta FROM ({C})"
TRUE_RANGE = f"""
  SELECT *, greatest(highest - lowest, abs(highest - before), abs(lowest - before)) AS true_range
  FROM (SELECT *, lag(close) OVER ({ORDER}) AS before FROM ({C}))
"""


def rsi_sql(n: int, name: str, source: str = DELTA) -> str:
    return f"""
  SELECT * EXCLUDE (gain, loss),
         100 - 100 / (1 + gain / CASE WHEN loss < 1e-9 THEN 1e-10 ELSE loss END) AS {name}
  FROM (SELECT *, avg(greatest(coalesce(price_delta, 0), 0)) OVER {last(n)} AS gain,
               avg(greatest(-coalesce(price_delta, 0), 0)) OVER {last(n)} AS loss
        FROM ({source}))
"""


def macd_sql(source: str = C) -> str:
    return f"""
  SELECT * EXCLUDE (held), {ema_sql("held", 12)} - {ema_sql("held", 26)} AS macd,
         {ema_sql("held", 12)} AS ema12
  FROM (SELECT *, list(close) OVER {last(26)} AS held FROM ({source}))
"""


@query("kline_resample", f"""
  SELECT event_id, symbol, "interval", starttime, endtime, open, highest, lowest, close,
         {sql_r6("volume", "quotevolume")}
  FROM ({candles_sql("1h")})""")
def _(spark, sf):
    return r6(_doubles(bars(spark, sf, "1h")), "volume", "quotevolume")


def _doubles(df):
    names = ("open", "highest", "lowest", "close", "volume", "quotevolume")
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _key(df, *names):
    return r6(df.select("event_id", "symbol", "endtime", *names), *names)


@query("sma20", f"""
  SELECT {KEY}, {sql_r6("sma20")}
  FROM (SELECT *, avg(close) OVER {last(20)} AS sma20 FROM ({C}))""")
def _(spark, sf):
    return _key(ind.sma20(bars(spark, sf), series=MINUTES), "sma20")


@query("rolling_std20", f"""
  SELECT {KEY}, {sql_r6("std20")}
  FROM (SELECT *, coalesce(stddev_samp(close) OVER {last(20)}, 0) AS std20 FROM ({C}))""")
def _(spark, sf):
    return _key(ind.rolling_std20(bars(spark, sf), series=MINUTES), "std20")


@query("true_range", f"SELECT {KEY}, {sql_r6('true_range')} FROM ({TRUE_RANGE})")
def _(spark, sf):
    return _key(ind.true_range(bars(spark, sf), series=MINUTES), "true_range")


@query("atr14", f"""
  SELECT {KEY}, {sql_r6("atr14")}
  FROM (SELECT *, avg(true_range) OVER {last(14)} AS atr14 FROM ({TRUE_RANGE}))""")
def _(spark, sf):
    return _key(ind.atr14(bars(spark, sf), series=MINUTES), "atr14")


@query("price_delta", f"SELECT {KEY}, {sql_r6('price_delta')} FROM ({DELTA})")
def _(spark, sf):
    return _key(ind.price_delta(bars(spark, sf), series=MINUTES), "price_delta")


@query("rsi10", f"SELECT {KEY}, {sql_r6('rsi10')} FROM ({rsi_sql(10, 'rsi10')})")
def _(spark, sf):
    return _key(ind.rsi10(bars(spark, sf), series=MINUTES), "rsi10")


@query("rsi14", f"SELECT {KEY}, {sql_r6('rsi14')} FROM ({rsi_sql(14, 'rsi14')})")
def _(spark, sf):
    return _key(ind.rsi10(bars(spark, sf), n=14, series=MINUTES), "rsi14")


@query("ema", f"SELECT {KEY}, {sql_r6('ema12')} FROM ({macd_sql()})")
def _(spark, sf):
    return _key(ind.ema(bars(spark, sf), series=MINUTES), "ema12")


@query("macd_line", f"SELECT {KEY}, {sql_r6('macd')} FROM ({macd_sql()})")
def _(spark, sf):
    return _key(ind.macd_line(bars(spark, sf), series=MINUTES), "macd")


@query("macd_signal_hist", f"""
  SELECT {KEY}, {sql_r6("macd", "macd_signal", "macd_hist")}
  FROM (SELECT *, macd - macd_signal AS macd_hist
        FROM (SELECT *, {ema_sql("held9", 9)} AS macd_signal
              FROM (SELECT *, list(macd) OVER {last(26)} AS held9 FROM ({macd_sql()}))))""")
def _(spark, sf):
    df = ind.macd_signal_hist(bars(spark, sf), series=MINUTES)
    return _key(df, "macd", "macd_signal", "macd_hist")


@query("macd_history", f"""
  WITH RECURSIVE c AS MATERIALIZED (
    SELECT event_id, symbol, endtime, close, row_number() OVER (PARTITION BY symbol ORDER BY endtime, event_id) AS k FROM ({C})),
  e AS (
    SELECT *, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS s9 FROM c WHERE k = 1
    UNION ALL
    SELECT n.event_id, n.symbol, n.endtime, n.close, n.k, n.e12, n.e26, p_s9 * 0.8 + (n.e12 - n.e26) * 0.2 AS s9
    FROM (SELECT c.*, c.close * 2 / 13 + e.e12 * 11 / 13 AS e12, c.close * 2 / 27 + e.e26 * 25 / 27 AS e26, e.s9 AS p_s9
          FROM e JOIN c ON c.symbol = e.symbol AND c.k = e.k + 1) n)
  SELECT {KEY}, {sql_r6("macd", "macd_signal", "macd_hist")}
  FROM (SELECT *, e12 - e26 AS macd, s9 AS macd_signal, e12 - e26 - s9 AS macd_hist FROM e)""")
def _(spark, sf):
    """MACD, signal and histogram whose means go back to the first candle."""
    return _key(recursive.macd_history(bars(spark, sf), MINUTES), "macd", "macd_signal", "macd_hist")


BANDS = f"""
  SELECT *, middle + 2 * std AS bb_upper, middle - 2 * std AS bb_lower, middle AS bb_middle,
         ((middle + 2 * std) - (middle - 2 * std)) / middle * 100 AS bb
  FROM (SELECT *, avg(close) OVER {last(20)} AS middle, stddev_samp(close) OVER {last(20)} AS std
        FROM ({C}))
"""


@query("bollinger", f"""
  SELECT {KEY}, {sql_r6("bb_upper", "bb_lower", "bb_middle", "bb")} FROM ({BANDS})""")
def _(spark, sf):
    df = ind.bollinger(bars(spark, sf), series=MINUTES)
    return _key(df, "bb_upper", "bb_lower", "bb_middle", "bb")


@query("stochastic", f"""
  SELECT {KEY}, {sql_r6("stoch_k", "stoch_d")}
  FROM (SELECT *, avg(stoch_k) OVER {last(3)} AS stoch_d
        FROM (SELECT *, (close - lo) / nullif(hi - lo, 0) * 100 AS stoch_k
              FROM (SELECT *, min(lowest) OVER {last(14)} AS lo, max(highest) OVER {last(14)} AS hi
                    FROM ({C}))))""")
def _(spark, sf):
    return _key(ind.stochastic(bars(spark, sf), series=MINUTES), "stoch_k", "stoch_d")


def _mark(value: str) -> str:
    before = f"OVER ({ORDER} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"
    return f"""CASE WHEN close > max(close) {before} AND {value} <= max({value}) {before} THEN 'bearish'
                    WHEN close < min(close) {before} AND {value} >= min({value}) {before} THEN 'bullish'
                    ELSE 'none' END"""


@query("divergence", f"""
  SELECT {KEY}, {_mark("rsi10")} AS rsi_divergence, {_mark("macd")} AS macd_divergence
  FROM (SELECT * REPLACE (round(rsi10, 6) AS rsi10, round(macd, 6) AS macd)
        FROM ({macd_sql(rsi_sql(10, "rsi10"))}))""")
def _(spark, sf):
    df = ind.divergence(bars(spark, sf), series=MINUTES)
    return df.select("event_id", "symbol", "endtime", "rsi_divergence", "macd_divergence")


WING = swings.WING
SWUNG = f"""
  SELECT *, CASE WHEN n = {2 * WING + 1} AND price > high_before AND price >= high_after THEN 'peak'
              WHEN n = {2 * WING + 1} AND price < low_before AND price <= low_after THEN 'trough' END AS swing
  FROM (SELECT {KEY}, lag(endtime, {WING}) OVER o AS swing_at, lag(close, {WING}) OVER o AS price,
          round(lag(rsi10, {WING}) OVER o, 6) AS rsi, round(lag(macd, {WING}) OVER o, 6) AS macd,
          max(close) OVER early AS high_before, max(close) OVER late AS high_after,
          min(close) OVER early AS low_before, min(close) OVER late AS low_after,
          count(*) OVER ({ORDER} ROWS BETWEEN {2 * WING} PRECEDING AND CURRENT ROW) AS n
        FROM ({macd_sql(rsi_sql(10, "rsi10"))})
        WINDOW o AS ({ORDER}), early AS ({ORDER} ROWS BETWEEN {2 * WING} PRECEDING AND {WING + 1} PRECEDING),
          late AS ({ORDER} ROWS BETWEEN {WING - 1} PRECEDING AND CURRENT ROW))
"""


@query("swing_divergence", f"""
  SELECT {KEY}, swing, swing_at, price, price_before,
    {", ".join(f"""CASE WHEN swing = 'peak' AND price > price_before AND {v} <= {v}_before THEN 'bearish'
      WHEN swing = 'trough' AND price < price_before AND {v} >= {v}_before THEN 'bullish' ELSE 'none' END AS {v}_divergence"""
      for v in swings.VALUES)}
  FROM (SELECT *, lag(price) OVER k AS price_before, lag(rsi) OVER k AS rsi_before, lag(macd) OVER k AS macd_before
        FROM ({SWUNG}) WHERE swing IS NOT NULL WINDOW k AS (PARTITION BY symbol, swing ORDER BY endtime, event_id))""")
def _(spark, sf):
    """Confirmed peaks and troughs of the minute bars against those before them."""
    return swings.swing_divergence(bars(spark, sf), series=MINUTES).drop("rsi", "macd")


# --- volume profile ---------------------------------------------------------------
EDGES = """
  CASE WHEN lo = hi
       THEN list_transform(range(0, 25), lambda i: CASE WHEN i = 24 THEN hi + pad
                           ELSE i * ((hi + pad - (lo - pad)) / 24.0::DOUBLE) + (lo - pad) END)
       ELSE list_transform(range(0, 25), lambda i: CASE WHEN i = 0 THEN lo - 0.001::DOUBLE * (hi - lo)
                           WHEN i = 24 THEN hi ELSE i * ((hi - lo) / 24.0::DOUBLE) + lo END) END
"""
PAD = "CASE WHEN lo <> 0 THEN 0.001::DOUBLE * abs(lo) ELSE 0.001::DOUBLE END"


def shown(edge: str, p: str) -> str:
    """Rounded border: below 1 the decimals count from the first digit that is not 0."""
    scale = (
        f"pow(10.0::DOUBLE, CASE WHEN abs({edge}) < 1 AND {edge} <> 0"
        f" THEN -floor(log10(abs({edge}))) - 1 + {p} ELSE {p} END)"
    )
    return f"CASE WHEN {edge} = 0 THEN {edge} ELSE round_even({edge} * {scale}, 0) / {scale} END"


DECIMALS = f"""
  coalesce(list_filter(range(3, 20), lambda p: len(list_distinct(
    list_transform(edges, lambda e: {shown("e", "p")}))) = 25)[1], 3)
"""
BINNED = f"""
  SELECT c.symbol, c.bin, sum(c.volume) AS volume, any_value(edges) AS edges
  FROM (SELECT s.symbol, s.volume, e.edges,
               CAST(len(list_filter(e.edges, lambda x: x < s.close)) AS INTEGER) AS bin
        FROM ({C}) s
        JOIN (SELECT symbol, {EDGES} AS edges
              FROM (SELECT *, {PAD} AS pad
                    FROM (SELECT symbol, min(close) AS lo, max(close) AS hi FROM ({C}) GROUP BY symbol)))
             e USING (symbol)) c
  GROUP BY c.symbol, c.bin
"""


def mid(number: str) -> str:
    low, high = f"edges[{number}]", f"edges[{number} + 1]"
    return f"coalesce(0.5::DOUBLE * ({shown(low, 'p')} + {shown(high, 'p')}), 0.0)"


@query("volume_by_price_bin", f"""
  SELECT symbol, bin, {shown("edges[bin]", "p")} AS bin_low,
         {shown("edges[bin + 1]", "p")} AS bin_high, round(volume, 6) AS volume
  FROM (SELECT *, {DECIMALS} AS p FROM ({BINNED}))""")
def _(spark, sf):
    return r6(volume.volume_by_price_bin(bars(spark, sf)), "volume")


SHARES = f"""
  SELECT symbol, bin, volume, edges,
         row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, bin) AS rank,
         sum(volume) OVER (PARTITION BY symbol ORDER BY volume DESC, bin
                           ROWS UNBOUNDED PRECEDING) AS cumulative,
         sum(volume) OVER (PARTITION BY symbol) AS total
  FROM ({BINNED})
"""


@query("cumulative_share", f"""
  SELECT symbol, bin, round(volume, 6) AS volume, CAST(rank AS INTEGER) AS rank,
         round(cumulative, 6) AS cumulative, round(cumulative / total, 6) AS share
  FROM ({SHARES})""")
def _(spark, sf):
    binned = volume.volume_by_price_bin(bars(spark, sf)).drop("bin_low", "bin_high")
    return r6(volume.cumulative_share(binned), "volume", "cumulative", "share")


@query("poc_top1", f"""
  SELECT symbol, bin AS poc_bin, round(volume, 6) AS poc_volume FROM ({SHARES}) WHERE rank = 1""")
def _(spark, sf):
    return r6(volume.poc_top1(volume.volume_by_price_bin(bars(spark, sf))), "poc_volume")


@query("volume_profile", f"""
  SELECT symbol, {mid("high")} AS va_high, {mid("low")} AS va_low, {mid("poc")} AS poc
  FROM (SELECT *, {DECIMALS} AS p
        FROM (SELECT symbol, any_value(edges) AS edges,
                     min(CASE WHEN rank = 1 THEN bin END) AS poc,
                     max(CASE WHEN cumulative / total <= 0.7 THEN bin END) AS high,
                     min(CASE WHEN cumulative / total <= 0.3 THEN bin END) AS low
              FROM ({SHARES}) GROUP BY symbol))""")
def _(spark, sf):
    return volume.volume_profile(bars(spark, sf))


# --- all indicators ---------------------------------------------------------------
def profile_sql(source: str) -> str:
    """Volume profile of the list ``held`` of (close, volume) structs of every row."""
    ranked = """list_sort(list_transform(list_distinct(list_transform(binned, lambda b: b.bin)),
      lambda n: {'minus': -list_reduce(list_transform(list_filter(binned, lambda b: b.bin = n),
                            lambda b: b.volume), lambda acc, x: acc + x, 0.0::DOUBLE),
                 'bin': n}))"""
    running = """list_transform(range(1, len(ranked) + 1), lambda k: {
      'bin': ranked[k].bin,
      'cumulative': list_reduce(list_transform(ranked[1:k], lambda r: -r.minus),
                                lambda acc, x: acc + x, 0.0::DOUBLE)})"""

    def within(share: float) -> str:
        return (
            f"list_transform(list_filter(running, lambda r: r.cumulative / "
            f"running[len(running)].cumulative <= {share}), lambda r: r.bin)"
        )

    return f"""
  SELECT * EXCLUDE (held, lo, hi, pad, edges, binned, ranked, running, high, low, pocbin, p),
         {mid("high")} AS va_high, {mid("low")} AS va_low, {mid("pocbin")} AS poc
  FROM (SELECT *, {DECIMALS} AS p, list_max({within(0.7)}) AS high, list_min({within(0.3)}) AS low,
               ranked[1].bin AS pocbin
  FROM (SELECT *, {running} AS running
  FROM (SELECT *, {ranked} AS ranked
  FROM (SELECT *, list_transform(held, lambda h: {{
                    'bin': CAST(len(list_filter(edges, lambda x: x < h.close)) AS INTEGER),
                    'volume': h.volume}}) AS binned
  FROM (SELECT *, {EDGES} AS edges
  FROM (SELECT *, {PAD} AS pad
  FROM (SELECT *, list_min(list_transform(held, lambda h: h.close)) AS lo,
               list_max(list_transform(held, lambda h: h.close)) AS hi
        FROM ({source}))))))))
"""


SERIES_BASE = f"""
  SELECT event_id, symbol, endtime,
         avg(close) OVER {last(20)} AS sma20, stddev_samp(close) OVER {last(20)} AS std,
         avg(true_range) OVER {last(14)} AS atr, rsi10, ema12, macd,
         list({{'close': close, 'volume': volume}}) OVER {last(26)} AS held
  FROM (SELECT *, greatest(highest - lowest, abs(highest - before), abs(lowest - before)) AS true_range
        FROM (SELECT *, lag(close) OVER ({ORDER}) AS before
              FROM ({macd_sql(rsi_sql(10, "rsi10"))})))
"""
SERIES = f"""
  SELECT event_id, endtime, symbol, sma20, ema12, rsi10, macd,
         coalesce(((sma20 + 2 * std) - (sma20 - 2 * std)) / sma20 * 100, 0.0) AS bb, atr,
         va_high, va_low, poc
  FROM ({profile_sql(SERIES_BASE)})
"""
NUMBERS = ("sma20", "ema12", "rsi10", "macd", "bb", "atr", "va_high", "va_low", "poc")


@query("indicator_series", f"SELECT {KEY}, {sql_r6(*NUMBERS)} FROM ({SERIES})")
def _(spark, sf):
    return r6(ind.indicator_series(bars(spark, sf), MINUTES), *NUMBERS)


NEWEST = f"SELECT * FROM ({SERIES}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY endtime DESC, event_id DESC) = 1"


@query("indicator_snapshot", f"SELECT {KEY}, {sql_r6(*NUMBERS)} FROM ({NEWEST})")
def _(spark, sf):
    return r6(ind.indicator_snapshot(bars(spark, sf)), *NUMBERS)


def label_sql(kind: str, value: str) -> str:
    cases = [
        f"WHEN {value} {sign} {bound} THEN '{text}'"
        for sign, bound, text in LABEL_RULES[kind]
        if sign
    ]
    return f"CASE {' '.join(cases)} ELSE '{LABEL_RULES[kind][-1][2]}' END"


LABELED = f"""SELECT *, {", ".join(f"{label_sql(kind, v)} AS {name}" for name, kind, v in LABELS)}
  FROM ({SERIES})"""


@query("sentiment_labels", f"""
  SELECT {KEY}, {", ".join(name for name, _, _ in LABELS)} FROM ({LABELED})""")
def _(spark, sf):
    labeled = sentiment_labels(ind.indicator_series(bars(spark, sf), MINUTES))
    return labeled.select("event_id", "symbol", "endtime", *[name for name, _, _ in LABELS])


def _trend(every: str) -> str:
    return f"""
    SELECT symbol, '{every}' AS every,
           CAST(sign(round({ema_sql("held", 12)} - {ema_sql("held", 26)}, 9)) AS INTEGER) AS trend
    FROM (SELECT symbol, list(close ORDER BY endtime) AS held
          FROM (SELECT * FROM ({candles_sql(every)})
                QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY endtime DESC) <= 26)
          GROUP BY symbol)"""


@query("market_regime", f"""
  SELECT symbol, {", ".join(f"max(CASE WHEN every = '{i}' THEN trend END) AS trend_{i}" for i in INTERVALS)},
         CASE WHEN min(trend) = 1 THEN 'bullish' WHEN max(trend) = -1 THEN 'bearish'
              WHEN min(trend) = 0 AND max(trend) = 0 THEN 'neutral' ELSE 'transitional' END AS regime
  FROM ({" UNION ALL ".join(_trend(i) for i in INTERVALS)}) GROUP BY symbol""")
def _(spark, sf):
    minutes = bars(spark, sf, "1m")
    longer = {i: kline_rollup(minutes, i) for i in INTERVALS if i != "1m"}
    return market_regime({"1m": minutes, **longer})


TREND_SQL = "CAST(sign(round(macd, 9)) AS INTEGER)"


@query("regime_series", f"""
  SELECT {", ".join(f"c.{k} AS {k}" for k in ("event_id", "symbol", "endtime"))},
         {", ".join(f"t{i}.trend AS trend_{i}" for i in INTERVALS)},
         CASE WHEN least({", ".join(f"t{i}.trend" for i in INTERVALS)}) = 1 THEN 'bullish'
              WHEN greatest({", ".join(f"t{i}.trend" for i in INTERVALS)}) = -1 THEN 'bearish'
              WHEN least({", ".join(f"t{i}.trend" for i in INTERVALS)}) = 0
                AND greatest({", ".join(f"t{i}.trend" for i in INTERVALS)}) = 0 THEN 'neutral' ELSE 'transitional' END AS regime
  FROM ({C}) c {" ".join(f"""
  ASOF LEFT JOIN (SELECT symbol, endtime, {TREND_SQL} AS trend FROM ({macd_sql(candles_sql(i))})) t{i}
    ON c.symbol = t{i}.symbol AND c.endtime >= t{i}.endtime""" for i in INTERVALS)}""")
def _(spark, sf):
    """The regime at every minute bar, each interval as it had last closed by then."""
    minutes = durable(bars(spark, sf, "1m"))
    longer = {i: kline_rollup(minutes, i) for i in INTERVALS if i != "1m"}
    found = regimes.regime_series({"1m": minutes, **longer})
    return found.select("event_id", "symbol", "endtime", *[f"trend_{i}" for i in INTERVALS], "regime")


# --- newest rows -------------------------------------------------------------------
def newest_sql(k: int, source: str = C) -> str:
    return f"""SELECT * FROM ({source})
      QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY endtime DESC, event_id DESC) <= {k}"""


for _name, _k in (("latest_350_per_symbol", 350), ("latest_26_per_symbol", 26), ("latest_per_symbol", 1)):

    @query(_name, f"SELECT {KEY}, close FROM ({newest_sql(_k)})")
    def _(spark, sf, k=_k):
        return topk.latest_per_symbol(bars(spark, sf), k).select("event_id", "symbol", "endtime", "close")


@query("symbol_filter", f"SELECT {KEY}, close FROM ({C}) WHERE symbol = 'click'")
def _(spark, sf):
    """One symbol, as a filter that reaches the scan; the per-symbol loop itself is not needed."""
    only = ticks(spark, sf).where(F.col("symbol") == "click")
    return kline_resample(only, "1m").select("event_id", "symbol", "endtime", "close")


@query("sort_asc", f"SELECT {KEY}, close FROM ({C}) ORDER BY endtime, event_id")
def _(spark, sf):
    return bars(spark, sf).orderBy("endtime", "event_id").select("event_id", "symbol", "endtime", "close")


@query("preview_rows", "SELECT * FROM events ORDER BY ts, event_id LIMIT 20")
def _(spark, sf):
    return topk.preview_rows(load(spark, sf, "events"), [F.col("ts"), F.col("event_id")], 20)


@query("price_axis_domain", f"""
  SELECT symbol, round(min(close) - 10, 6) AS min_price, round(max(close) + 10, 6) AS max_price
  FROM ({newest_sql(350)}) GROUP BY symbol""")
def _(spark, sf):
    domain = ind.price_axis_domain(topk.latest_per_symbol(bars(spark, sf), 350))
    return r6(domain, "min_price", "max_price")


# --- 24 hours ----------------------------------------------------------------------
H = bars_sql("1h")


@query("price_change_24h", f"""
  SELECT l.symbol, CAST(l.place AS INTEGER) AS place, l.endtime, CAST(l.close AS DOUBLE) AS close,
         CAST(round(l.close - p.close, 2) AS DOUBLE) AS price_diff,
         round(CAST(l.close - p.close AS DOUBLE) / CAST(p.close AS DOUBLE) * 100, 2) AS percent_change
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY endtime DESC, event_id DESC) AS place
        FROM ({H}) QUALIFY place <= 350) l
  LEFT JOIN (SELECT b.symbol, b.close FROM ({H}) b
             JOIN (SELECT symbol, max(endtime) AS newest FROM ({H}) GROUP BY symbol) n
               ON b.symbol = n.symbol AND b.endtime = n.newest - INTERVAL 24 HOURS) p
    ON l.symbol = p.symbol""")
def _(spark, sf):
    return stats24h.price_change_24h(bars(spark, sf, "1h"))


@query("max_24h_cache", f"""
  SELECT symbol, state.v AS max_value, state.t AS max_timestamp
  FROM (SELECT symbol, list_reduce(list({{'v': close, 't': endtime}} ORDER BY endtime, event_id),
                 lambda acc, x: CASE WHEN x.t - acc.t >= INTERVAL 24 HOURS OR x.v > acc.v
                                     THEN x ELSE acc END) AS state
        FROM ({C}) GROUP BY symbol)""")
def _(spark, sf):
    return stats24h.max_24h_cache(bars(spark, sf))


@query("rolling_max_24h", f"""
  SELECT {KEY}, max(close) OVER (PARTITION BY symbol ORDER BY endtime
                 RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS max_24h
  FROM ({C})""")
def _(spark, sf):
    df = stats24h.rolling_max_24h(bars(spark, sf))
    return df.select("event_id", "symbol", "endtime", "max_24h")
