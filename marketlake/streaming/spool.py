"""Batches of a least size: rows wait in a spool until enough have come, or too long."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType, TimestampType

from ..sinks.marks import Mark
from ..sources.tables import parquet_or_empty
from .batches import Handler

FLUSH_AT = 5  # fixed value: records at which a batch is handed over
ARRIVED, BATCH = "spool_arrived", "spool_batch"


class Spool:
    """A handler for :func:`stream_micro_batch` that hands rows on in batches of ``least`` and more.

    Every micro-batch is written below ``path``, in the folder of the batch that was handed over
    last; so what waits is one folder, and looking at it does not grow with the history. Once it
    holds ``least`` rows, or its oldest has waited ``seconds``, ``fn`` gets all of them with the number
    of the newest micro-batch, and only after ``fn`` has returned is that number marked as handed over. If ``fn`` or the
    job fails, rows stay in the spool and come again under the same number: a sink that replaces
    the batch of a number, as :func:`keyed_append`, holds every row once. Empty micro-batches hand on nothing
    but rows that have waited too long. Rows must not have columns called as the two of the spool.
    """

    def __init__(self, path: str, schema: StructType, fn: Handler, least: int = FLUSH_AT, seconds: float | None = None, clock: Callable[[], float] = time.time):
        self.path, self.fn, self.least, self.seconds, self.clock = path.rstrip("/"), fn, least, seconds, clock
        if {ARRIVED, BATCH} & set(schema.names):
            raise ValueError(f"rows of a spool have no columns {ARRIVED} and {BATCH}")
        self.names = schema.names
        self.stored = StructType([*schema.fields]).add(ARRIVED, TimestampType()).add(BATCH, LongType())

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = Mark(spark, self.path).newest()
        if number <= last:
            return  # it was handed over, but the stream was stopped before it knew
        folder = f"{self.path}/after={last}"
        now = F.timestamp_micros(F.lit(int(self.clock() * 1_000_000)))
        batch.withColumn(ARRIVED, now).write.mode("overwrite").parquet(f"{folder}/{BATCH}={number}")
        waiting = self._waiting(spark, last).where(F.col(BATCH) <= number)
        seen = waiting.agg(F.count(F.lit(1)).alias("n"), F.unix_micros(F.min(ARRIVED)).alias("oldest")).first()
        late = self.seconds is not None and seen["n"] and self.clock() - seen["oldest"] / 1e6 >= self.seconds
        if seen["n"] >= self.least or late:
            self._hand_over(spark, waiting, number)

    def finish(self, spark: SparkSession) -> int:
        """Hands over what still waits when the input has ended; the number of rows."""
        waiting = self._waiting(spark, Mark(spark, self.path).newest())
        seen = waiting.agg(F.count(F.lit(1)).alias("n"), F.max(BATCH).alias("newest")).first()
        if seen["n"]:
            self._hand_over(spark, waiting, seen["newest"])
        return seen["n"]

    def _hand_over(self, spark: SparkSession, waiting: DataFrame, number: int) -> None:
        self.fn(waiting.select(*self.names), number)
        Mark(spark, self.path).set(number)

    def _waiting(self, spark: SparkSession, last: int) -> DataFrame:
        folder = f"{self.path}/after={last}"
        return parquet_or_empty(spark, f"{folder}/{BATCH}=*", self.stored, folder)
