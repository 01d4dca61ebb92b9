"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import durable

# monotonically_increasing_id holds the partition above this many bits and the
# place inside the partition below.
PLACE_BITS = 33


def max_surrogate_id(df: DataFrame, id: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(id), F.lit(0)).cast("long").alias("max_id"))


def fetch_max_id(df: DataFrame, id: str) -> int:
    return max_surrogate_id(df, id).first()["max_id"]


def surrogate_key(
    df: DataFrame,
    order: Sequence[str | Column],
    start: int = 0,
    id: str = "id",
    partitions: int | None = None,
) -> DataFrame:
    """Ids ``start + 1, start + 2, ...`` in ``order`` without a gap, on any number of tasks.

    Rows are range-partitioned by ``order`` and sorted inside their partition; a
    partition then only needs the number of rows before it. The sorted rows are
    written to the shared folder first: counts and rows must come from the same
    partitions, also when a task is repeated. ``order`` should be total.
    """
    spread = order if partitions is None else [partitions, *order]
    ranged = df.repartitionByRange(*spread).sortWithinPartitions(*order)
    placed = durable(ranged.withColumn("_spot", F.monotonically_increasing_id()))
    partition = F.shiftright("_spot", PLACE_BITS)
    place = F.col("_spot").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # One row per partition: a single-task window over them is small at any scale.
    counts = placed.groupBy(partition.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    numbered = placed.withColumn("_part", partition).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(id, place + 1 + F.col("_offset") + F.lit(start)).drop(
        "_spot", "_part", "_offset"
    )
