"""Which number of a versioned folder counts."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.tables import parquet_or_empty


class Mark:
    """The newest finished number of what is written below ``path`` under rising numbers.

    Kept in two folders in turn: one is whole whenever the other is being written, so a job that
    stops half way leaves the number as it was. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def newest(self) -> int:
        """The number marked last, -1 before the first."""
        marks = parquet_or_empty(self.spark, f"{self.path}/mark=*", "number long", self.path)
        newest = marks.agg(F.max("number")).first()[0]
        return -1 if newest is None else newest

    def set(self, number: int) -> None:
        one = self.spark.range(number, number + 1).toDF("number")
        one.write.mode("overwrite").parquet(f"{self.path}/mark={number % 2}")
