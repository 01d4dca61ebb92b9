"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Map tasks are dealt to this many heaps. Survivors of the map-side limit of one
# hot group are merged per heap, by many tasks, before they meet.
HEAPS = 64


def top_k(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, heaps: int = HEAPS
) -> DataFrame:
    """The first ``k`` rows of every group; ``order`` should be total.

    Spark limits every window to ``k`` rows before it shuffles, so a map task
    sends at most ``k`` rows of a group. All rows of a task share a heap: the
    heaps add no rows to the shuffle, and only ``heaps * k`` rows of a group
    reach the task that decides.
    """
    by = list(by)
    ranked = df.withColumn("_heap", F.pmod(F.spark_partition_id(), F.lit(heaps)))
    for keys in ([*by, "_heap"], by):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ranked = ranked.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return ranked.drop("_rank", "_heap")


def latest_per_symbol(
    df: DataFrame, k: int, symbol: str = "symbol", ts: str = "endtime", tiebreak: str = "event_id"
) -> DataFrame:
    """The newest ``k`` rows of every symbol."""
    order = [F.col(ts).desc(), F.col(tiebreak).desc()]
    return top_k(df, [symbol], order, k)


def preview_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in a total order."""
    return df.orderBy(*order).limit(n)
