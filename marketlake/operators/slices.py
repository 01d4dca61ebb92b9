"""Ordered work on long histories without one task per symbol.

A window partitioned by symbol alone puts the whole history of a symbol in one
task. Here every history is cut in time slices, and each slice is led by the
rows before it that its frames look back at (its halo). Windows then run per
(symbol, slice) and give the same values as windows over the whole history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

SLICE = "_slice"
HALO = "_halo"
DAY_SECONDS = 86_400


@dataclass(frozen=True)
class Series:
    """Column names of an ordered history, and how long its slices are.

    A slice should hold a few thousand to a few hundred thousand rows: a day for
    one-second candles, :meth:`of_interval` for others.
    """

    symbol: str = "symbol"
    ts: str = "endtime"
    tiebreak: str = "event_id"
    slice_seconds: int = DAY_SECONDS

    @staticmethod
    def of_interval(seconds: int, rows: int = 16_384, **names: str) -> Series:
        """Slices of at most ``rows`` candles of the given length."""
        return Series(slice_seconds=seconds * rows, **names)

    def slice_number(self) -> Column:
        micros = F.unix_micros(F.col(self.ts).cast("timestamp"))
        return F.floor(micros / F.lit(self.slice_seconds * 1_000_000)).cast("long")

    def ascending(self) -> list[Column]:
        return [F.col(self.ts).asc(), F.col(self.tiebreak).asc()]

    def descending(self) -> list[Column]:
        return [F.col(self.ts).desc(), F.col(self.tiebreak).desc()]

    def window(self) -> WindowSpec:
        """Ordered window of a slice; only valid on a frame that carries slices."""
        return Window.partitionBy(self.symbol, SLICE).orderBy(*self.ascending())

    def last(self, rows: int) -> WindowSpec:
        return self.window().rowsBetween(1 - rows, 0)


CANDLES = Series()


def with_row_halo(df: DataFrame, series: Series, rows: int) -> DataFrame:
    """Slices of the history, each with the ``rows`` rows before it marked as halo.

    The last rows of every slice are few, so they are found by a limit that runs
    before the shuffle and handed on over the list of slices, however wide the
    gaps between slices are.
    """
    sliced = df.withColumn(SLICE, series.slice_number())
    newest = Window.partitionBy(series.symbol, SLICE).orderBy(*series.descending())
    order = [c for c in (series.ts, series.tiebreak)]
    others = [c for c in df.columns if c not in order]
    tails = (
        sliced.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= rows)
        .groupBy(series.symbol, SLICE)
        .agg(F.array_sort(F.collect_list(F.struct(*order, *others))).alias("_tail"))
    )
    # A slice that exists holds a row at least, so `rows` slices reach back far enough.
    before = Window.partitionBy(series.symbol).orderBy(SLICE).rowsBetween(-rows, -1)
    carried = tails.withColumn("_all", F.flatten(F.collect_list("_tail").over(before)))
    halo = carried.select(
        SLICE,
        F.inline(
            F.when(F.size("_all") > rows, F.slice("_all", -rows, rows)).otherwise(F.col("_all"))
        ),
    )
    return sliced.withColumn(HALO, F.lit(False)).unionByName(
        halo.select(*df.columns, SLICE, F.lit(True).alias(HALO))
    )


def without_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(HALO)).drop(SLICE, HALO)
