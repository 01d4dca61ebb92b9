"""Which hours a table holds, and which ids each of them may use."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.tables import parquet_or_empty

ENTRY = "hour long, first_id long, n_rows long"


class Ledger:
    """One row an hour: the range of ids reserved for it.

    Kept as one small folder an hour that is replaced as a whole, so an hour that runs again finds its
    range, and the next id is the end of the furthest range, whatever the table holds. The hours of a table
    run one after the other, in any order.
    """

    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/ledger/{table}"

    def entries(self):
        return parquet_or_empty(self.spark, f"{self.path}/entry=*", ENTRY)

    def hours(self, low: int, high: int) -> list[int]:
        """Hours held between two numbers, both included."""
        return [r["hour"] for r in self.entries().where(F.col("hour").between(low, high)).select("hour").collect()]

    def reserve(self, hour: int, n: int, start: int = 0) -> int:
        """The first of ``n`` ids for an hour: of its own range if that is long enough, else behind
        all ranges and ``start``."""
        own = self.entries().where(F.col("hour") == hour).first()
        if own is not None and own["n_rows"] >= n:
            return own["first_id"]
        return self.reserve_more(hour, n, start)

    def reserve_more(self, hour: int, n: int, start: int = 0) -> int:
        """A range behind all others for an hour that keeps what it has; rows never leave a range
        that was given out, as the hour's new entry lies behind it."""
        last = self.entries().agg(F.max(F.col("first_id") + F.col("n_rows") - 1)).first()[0]
        first = max(start, 0 if last is None else last) + 1
        row = self.spark.createDataFrame([(hour, first, n)], ENTRY)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/entry={hour}")
        return first
