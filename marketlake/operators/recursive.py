"""Exponential means over the whole history, worked on in slices side by side.

e = a x + (1 - a) e' is an affine map of the mean before. A slice of the history is such a map as
well: its own mean begun at 0, and a decay. So slices are gone through side by side, only their maps, two
numbers each, in order of time, and what comes into a slice is added to its rows with their decay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import durable
from .indicators import EMA_FAST, EMA_SLOW, SIGNAL
from .slices import CANDLES, SLICE, Series


def begun_at_zero(values: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean after each value when there was 0 before, and what is left of what was there.

    Null values change nothing.
    """
    a = 2.0 / (span + 1.0)
    there = ~np.isnan(values)
    mean, out = 0.0, np.zeros(len(values))
    for i, x in enumerate(np.where(there, values, 0.0).tolist()):
        if there[i]:
            mean += a * (x - mean)
        out[i] = mean
    return out, (1.0 - a) ** np.cumsum(there)


def ema_history(df: DataFrame, column: str, spans: dict[str, int], series: Series = CANDLES) -> DataFrame:
    """``df`` with an exponential mean of ``column`` per entry of ``spans`` (name and span), each begun with the first
    value of the symbol and carried on through its whole history.

    One shuffle by symbol and slice for all means; a task holds one slice. Per symbol only one row a
    slice is brought in order. Rows with null values keep the mean before them, null before the first. Names
    in ``spans`` must not be columns of ``df``.
    """
    names, lengths = list(spans), list(spans.values())
    order = [series.ts, series.tiebreak]
    kinds = df.schema.simpleString()[len("struct<") : -1]
    added = ", ".join(f"`{n}` double, `_left_{n}` double" for n in names)
    sliced = df.withColumn(SLICE, series.slice_number())

    def own(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        values = rows[column].astype("float64").to_numpy()
        more = {}
        for name, span in spans.items():
            more[name], more[f"_left_{name}"] = begun_at_zero(values, span)
        there = ~np.isnan(values)
        first = values[there][0] if there.any() else None
        yield rows.assign(**more, _first=first, _seen=there.cumsum())

    local = durable(
        sliced.groupBy(series.symbol, SLICE).applyInPandas(own, f"{kinds}, {SLICE} bigint, {added}, _first double, _seen bigint")
    )
    # the last row of a slice has its map: one row a slice
    ends = [F.max_by(c, "_seen").alias(c) for n in names for c in (n, f"_left_{n}")]
    maps = local.groupBy(series.symbol, SLICE).agg(F.max("_first").alias("_first"), *ends)
    symbol_kind = dict(df.dtypes)[series.symbol]
    into = ", ".join(f"_in_{k} double" for k in range(len(names)))

    def carried(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(SLICE)
        held: list[float | None] = [None] * len(names)
        out = []
        for r in rows.to_dict("records"):
            if held[0] is None and not pd.isna(r["_first"]):
                held = [r["_first"]] * len(names)  # as if it had been there before
            out.append((key[0], r[SLICE], *held))
            if held[0] is not None:
                held = [r[n] + r[f"_left_{n}"] * h for n, h in zip(names, held, strict=True)]
        yield pd.DataFrame(out, columns=["_symbol", "_at", *[f"_in_{k}" for k in range(len(lengths))]])

    carry = durable(maps.groupBy(series.symbol).applyInPandas(carried, f"_symbol {symbol_kind}, _at bigint, {into}"))
    joined = local.join(carry, F.col(series.symbol).eqNullSafe(F.col("_symbol")) & (F.col(SLICE) == F.col("_at")))
    means = {
        n: F.when((F.col("_seen") > 0) | (F.col(SLICE) > F.col("_started")), F.col(n) + F.col(f"_left_{n}") * F.col(f"_in_{k}")) for k, n in enumerate(names)
    }
    begun = maps.where("_first IS NOT NULL").groupBy(F.col(series.symbol).alias("_name")).agg(F.min(SLICE).alias("_started"))
    joined = joined.join(durable(begun), F.col(series.symbol).eqNullSafe(F.col("_name")), "left")
    return joined.withColumns(means).select(*df.columns, *names)


def macd_history(df: DataFrame, series: Series = CANDLES, close: str = "close") -> DataFrame:
    """MACD, signal line and histogram with means that go back to the first candle of the symbol."""
    fast = ema_history(df, close, {"_fast": EMA_FAST, "_slow": EMA_SLOW}, series)
    line = fast.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    signal = ema_history(line, "macd", {"macd_signal": SIGNAL}, series)
    return signal.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
