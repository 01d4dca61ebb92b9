"""Streaming operators with typed state, event-time timers and an initial state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.bars import INTERVALS, kline_resample
from ..operators.slices import DAY_SECONDS
from ..operators.stats24h import SUMMARY, follow, summarise_slice
from .operators import DELAY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOLDER = "symbol string, max_value double, max_timestamp timestamp"
BARS = "`interval` string, starttime timestamp, endtime timestamp"


@contextmanager
def typed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which typed state needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class Holder(StatefulProcessor):
    """The held maximum of a symbol through closed slices, in order of time.

    A holder gives way to any candle that is 24 hours younger. So once the watermark is 24 hours and a slice
    behind it, no candle to come depends on it any more: a timer then drops the state, and nothing
    is lost.
    """

    def __init__(self, slice_seconds: int):
        self.expiry = (DAY_SECONDS + slice_seconds) * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "max_value double, max_ts long")

    def _keep(self, held: tuple[float, int]) -> None:
        self.held.update((float(held[0]), int(held[1])))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(-(-int(held[1]) // 1000) + self.expiry)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self._keep((row["max_value"], pd.Timestamp(row["max_timestamp"]).value // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        runs = pd.concat(list(rows)).sort_values(["slice", "run"])
        before = self.held.get() if self.held.exists() else None
        held = follow(before, runs.itertuples(index=False))
        if held is not None:
            self._keep(held)
            at = pd.Timestamp(held[1], unit="us", tz="UTC")
            yield pd.DataFrame({"symbol": [key[0]], "max_value": [held[0]], "max_timestamp": [at]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_max_24h(
    stream: DataFrame,
    slice_seconds: int = 6 * 3_600,
    delay: str = DELAY,
    initial: DataFrame | None = None,
    symbol: str = "symbol",
    ts: str = "endtime",
    tiebreak: str = "event_id",
    close: str = "close",
) -> DataFrame:
    """The decaying 24-hour maximum of every symbol, one row per symbol and closed slices.

    Candles may come in any order within the delay: they are gathered by symbol and slice of time until
    the watermark has passed the end of the slice, then summed up slice by slice, and only the few
    runs of a slice reach the state of the symbol. Append mode; start it under :func:`typed_state`.
    ``initial`` holds the maxima before these candles (symbol, max_value, max_timestamp). Candles without a close
    or symbol count for nothing. Slices must start at multiples of their length, as windows do.
    """
    length = F.window(ts, f"{slice_seconds} seconds")
    candle = F.struct(
        F.unix_micros(ts).alias("ts"), F.col(tiebreak).cast("long").alias("tiebreak"), F.col(close).cast("double").alias("close")
    )
    # no filter before the watermark: rows that count for nothing still tell the time
    counts = F.col(close).isNotNull() & F.col(symbol).isNotNull()
    closed = (
        stream.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .groupBy(F.col(symbol).alias("symbol"), length)
        .agg(F.collect_list(F.when(counts, candle)).alias("candles"))
        .where(F.size("candles") > 0)
        .select("symbol", F.window_time("window").alias("at"), F.unix_seconds("window.start").alias("slice"), "candles")
    )
    fields = [f for f in SUMMARY.split(", ") if not f.startswith(("symbol ", "slice "))]

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                candles = pd.DataFrame([(c["ts"], c["tiebreak"], c["close"]) for c in row.candles], columns=["ts", "tiebreak", "close"])
                runs = summarise_slice(candles.assign(symbol=row.symbol, slice=row.slice))
                yield runs.assign(at=row.at)

    runs = closed.mapInPandas(summed, f"symbol string, slice long, {', '.join(fields)}, at timestamp")
    state = None if initial is None else initial.select("symbol", "max_value", "max_timestamp").groupBy("symbol")
    return runs.groupBy("symbol").transformWithStateInPandas(Holder(slice_seconds), HOLDER, "append", "eventTime", state)


class Rollup(StatefulProcessor):
    """Longer bars of one symbol and day from its shortest ones, given out at their ends.

    All open bars of a symbol and day are one list, read and written once a batch, with one timer at the
    end of the first of them: what a call to the state costs does not come once a bar.
    """

    NUMBERS = ("open", "highest", "lowest", "close", "volume", "quotevolume")

    def __init__(self, lengths: Sequence[tuple[str, int]], number: str):
        self.lengths = [(n, s * 1000) for n, s in lengths]
        self.number = number

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        numbers = ", ".join(f"{n} {self.number}" for n in self.NUMBERS)
        bar = f"first long, last long, event_id string, {numbers}"
        self.open = handle.getListState("open", f"name string, start long, {bar}")

    def _held(self) -> dict[tuple, tuple]:
        rows = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        return {r[:2]: r[2:] for r in rows}

    def _ends(self, bars: dict[tuple, tuple]) -> list[int]:
        of = dict(self.lengths)
        return [start + of[name] for name, start in bars]

    def _keep(self, bars: dict[tuple, tuple]) -> None:
        if bars:
            self.open.put([(*place, *own) for place, own in bars.items()])
        else:
            self.open.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        before, found = min(self._ends(held), default=None), dict(held)
        for frame in rows:
            yield _told(frame[["event_id", "symbol", "interval", "starttime", "endtime", *self.NUMBERS]])
            for r in frame.sort_values("starttime").itertuples(index=False):
                at = r.starttime.value // 1_000_000
                for name, length in self.lengths:
                    place = (name, at - at % length)
                    # a bar whose ticks have no price has volume only
                    ends = (None, None, None) if r.event_id is None else (at, at, r.event_id)
                    own = (*ends, r.open, r.highest, r.lowest, r.close, r.volume, r.quotevolume)
                    found[place] = merged(found[place], own) if place in found else own
        first = min(self._ends(found), default=None)
        if first != before:
            self.handle.registerTimer(first)
        self._keep(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held, of = self._held(), dict(self.lengths)
        over = {place: own for place, own in held.items() if place[1] + of[place[0]] <= now}
        if over:  # else an earlier timer gave them out
            out = []
            for (name, start), (_, _, event_id, *numbers) in over.items():
                begin = datetime.fromtimestamp(start / 1000, UTC)
                out.append((event_id, key[0], name, begin, begin + timedelta(milliseconds=of[name]), *numbers))
            left = {place: own for place, own in held.items() if place not in over}
            self._keep(left)
            if left:
                self.handle.registerTimer(min(self._ends(left)))
            yield _told(pd.DataFrame(out, columns=["event_id", "symbol", "interval", "starttime", "endtime", *self.NUMBERS]))

    def close(self) -> None:
        pass


def _told(bars: pd.DataFrame) -> pd.DataFrame:
    """Bars with ids as numbers again: as floats, which pandas takes for numbers with nulls, long ids
    would lose digits."""
    return bars.assign(event_id=pd.array([None if x is None else int(x) for x in bars["event_id"]], "Int64"))


def merged(a: tuple, b: tuple) -> tuple:
    """Two parts of a bar (first and last start, id, open, highest, lowest, close, sums) as one."""
    plus = lambda x, y: y if x is None else x if y is None else x + y
    sums = (plus(a[7], b[7]), plus(a[8], b[8]))
    if a[0] is None or b[0] is None:
        return (*(b if a[0] is None else a)[:7], *sums)
    early, last = (a if a[0] <= b[0] else b), (a if a[1] >= b[1] else b)
    return (early[0], last[1], last[2], early[3], max(a[4], b[4]), min(a[5], b[5]), last[6], *sums)


def stream_bars_of_all(
    stream: DataFrame, intervals: Sequence[str] = tuple(INTERVALS), delay: str = DELAY, number: str = "decimal(38,4)", **columns: str
) -> DataFrame:
    """Bars of several intervals from one reading of a tick stream, under one watermark.

    Ticks become bars of the shortest interval in a hash aggregation that is combined before the
    shuffle. Those are given out as they close, and are all that the longer bars are made of: of
    each symbol and day one state holds the open bars, and a timer at the first end gives out what is over. A
    hot symbol is a day's shortest bars to a task. Append mode; start it under
    :func:`typed_state`. Intervals must be multiples of the shortest and divide a day. ``number`` is the type of prices
    and sums. Ticks without a price open no bar; a symbol may be null.
    """
    named = sorted(((n, INTERVALS[n]) for n in intervals), key=lambda x: x[1])
    shortest = named[0][1]
    if any(s % shortest or DAY_SECONDS % s for _, s in named):
        raise ValueError("intervals must be multiples of the shortest and divide a day")
    ts = columns.get("ts", "ts")
    bars = kline_resample(stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay), named[0][0], **columns, keep_time="at")
    plain = bars.select(
        F.col("event_id").cast("string").alias("event_id"), "symbol", "interval", "starttime", "endtime",
        *[F.col(n).cast(number).alias(n) for n in Rollup.NUMBERS], "at",
        F.floor(F.unix_seconds("starttime") / DAY_SECONDS).cast("long").alias("day"),
    )
    numbers = ", ".join(f"{n} {number}" for n in Rollup.NUMBERS)
    return plain.groupBy("symbol", "day").transformWithStateInPandas(
        Rollup(named[1:], number), f"event_id long, symbol string, {BARS}, {numbers}", "append", "eventTime"
    )
