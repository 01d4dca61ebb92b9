"""Streaming forms of dedup, bars and the decaying maximum."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.bars import kline_resample
from ..operators.filters import RECENT_HOURS
from ..operators.slices import CANDLES, Series
from ..operators.stats24h import follow, slice_summaries

DELAY = f"{RECENT_HOURS} hours"


def stream_dedup(stream: DataFrame, key: Sequence[str], ts: str, delay: str = DELAY) -> DataFrame:
    """One row per key while repeats come within the delay; state is dropped after it.

    A key is remembered once, at its own place, so the result does not depend on how
    files fall on tasks.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def stream_bars(
    stream: DataFrame,
    every: str = "1h",
    delay: str = DELAY,
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    qty: str = "qty",
    tiebreak: str = "event_id",
) -> DataFrame:
    """Bars of a tick stream, each given out once when the watermark has passed its end."""
    return kline_resample(
        stream.withWatermark(ts, delay), every, symbol, ts, price, qty, tiebreak
    )


HOLDER = "symbol string, max_value double, max_timestamp timestamp"
HOLDER_STATE = "max_value double, max_ts long"


def _carry(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    runs = pd.concat(list(frames)).sort_values(["slice", "run"])
    held = follow(state.get if state.exists else None, runs.itertuples(index=False))
    state.update(held)
    yield pd.DataFrame(
        {
            "symbol": [key[0]],
            "max_value": [held[0]],
            "max_timestamp": [pd.Timestamp(held[1], unit="us", tz="UTC")],
        }
    )


def stream_max_24h(stream: DataFrame, series: Series = CANDLES, close: str = "close") -> DataFrame:
    """The decaying 24-hour maximum of every symbol, one row per symbol and micro-batch.

    Use output mode ``update``. The candles of a micro-batch are first summed up
    per time slice, on as many tasks as there are slices; the state of a symbol
    then only goes through a few runs per slice. Candles are expected in order
    of time from one micro-batch to the next.
    """
    return (
        slice_summaries(stream, series, close)
        .groupBy("symbol")
        .applyInPandasWithState(
            _carry, HOLDER, HOLDER_STATE, "update", GroupStateTimeout.NoTimeout
        )
        .select("symbol", "max_value", F.col("max_timestamp"))
    )
