"""The regime at every candle: what each longer interval had last closed with, carried forward."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable
from .bars import INTERVALS
from .indicators import macd_line
from .slices import CANDLES, SLICE, Series


def last_known(rows: DataFrame, events: dict[str, DataFrame], series: Series = CANDLES) -> DataFrame:
    """``rows`` with a column per entry of ``events``: the value of the last event (symbol, at, value) of the
    symbol up to and including the row's own time; null before the first.

    Rows and events share one ordered list, cut in slices of time. What a slice begins with comes
    from one row a slice: the last event of each kind in it, carried over slices. So a hot symbol is
    many tasks, and no row is compared with a range of events. Events of one kind must not share symbol and time.
    """
    names = list(events)

    def listed(df: DataFrame, at: Column, kind: int, row: Column, values: dict[str, Column]) -> DataFrame:
        nothing = F.lit(None).cast(kinds["value"])
        return df.select(
            F.col(series.symbol).alias("_symbol"), at.cast("timestamp").alias("_at"), F.lit(kind).alias("_kind"), row.alias("_row"),
            *[values.get(n, nothing).alias(f"_v{k}") for k, n in enumerate(names)],
        )

    kinds = dict(next(iter(events.values())).dtypes)
    row_type = rows.schema
    parts = [listed(rows, F.col(series.ts), 1, F.struct(*rows.columns), {})]
    parts += [listed(df, F.col("at"), 0, F.lit(None).cast(row_type), {n: F.col("value")}) for n, df in events.items()]
    sliced = reduce(DataFrame.unionByName, parts).withColumn(
        SLICE, F.floor(F.unix_micros("_at") / F.lit(series.slice_seconds * 1_000_000)).cast("long")
    )
    held = [F.col(f"_v{k}") for k in range(len(names))]
    tails = sliced.groupBy("_symbol", SLICE).agg(*[F.max_by(v, F.when(v.isNotNull(), F.col("_at"))).alias(f"_l{k}") for k, v in enumerate(held)])
    before = Window.partitionBy("_symbol").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = durable(
        tails.select(F.col("_symbol").alias("_s"), F.col(SLICE).alias("_n"), *[F.last(f"_l{k}", True).over(before).alias(f"_c{k}") for k in range(len(names))])
    )
    own = Window.partitionBy("_symbol", SLICE).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = sliced.withColumns({f"_w{k}": F.last(v, True).over(own) for k, v in enumerate(held)}).where("_kind = 1")
    joined = seen.join(carried, F.col("_symbol").eqNullSafe(F.col("_s")) & (F.col(SLICE) == F.col("_n")))
    return joined.select("_row.*", *[F.coalesce(f"_w{k}", f"_c{k}").alias(n) for k, n in enumerate(names)])


def regime_series(bars: dict[str, DataFrame], rows: int = 16_384) -> DataFrame:
    """Every bar of the first entry of ``bars`` with ``trend_<interval>`` of each entry and their ``regime``.

    The trend of an interval is the sign of the fast less the slow exponential mean at its last
    bar that had closed by then, over its newest 26 bars; no bar is used before its end. All up: bullish; all
    down: bearish; no direction anywhere: neutral; anything mixed: transitional. Intervals without a closed bar
    have no trend and no vote.
    """
    events = {}
    for interval, df in bars.items():
        own = Series.of_interval(INTERVALS[interval], rows)
        trend = F.signum(F.round("macd", 9)).cast("int")
        events[f"trend_{interval}"] = macd_line(df, series=own).select("symbol", F.col("endtime").alias("at"), trend.alias("value"))
    first = next(iter(bars))
    told = last_known(bars[first], events, Series.of_interval(INTERVALS[first], rows))
    low, high = F.least(*events), F.greatest(*events)
    return told.withColumn(
        "regime",
        F.when(low == 1, "bullish").when(high == -1, "bearish").when((low == 0) & (high == 0), "neutral").otherwise("transitional"),
    )
