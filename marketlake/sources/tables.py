"""Scans of catalog tables, files and the row store."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import instant


def table_scan(spark: SparkSession, name: str, where: str | Column | None = None) -> DataFrame:
    """A catalog table or, when the name has a slash, a parquet folder."""
    df = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return df if where is None else df.where(where)


def parquet_or_empty(
    spark: SparkSession, paths: str | list[str], schema: StructType | str, base: str | None = None
) -> DataFrame:
    """Parquet folders, or no rows where none of them was written yet.

    ``base`` is the folder below which names like ``hour=5`` are columns; of these, those in the schema are read.
    """
    empty = spark.createDataFrame([], schema)
    if not paths:
        return empty
    reader = spark.read.schema(empty.schema)
    if base:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(*([paths] if isinstance(paths, str) else paths)).select(*empty.columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty


def jdbc_scan(spark: SparkSession, options: dict[str, str], where: str | None = None) -> DataFrame:
    """A row-store table; the filter is pushed into the store. Needs a driver jar."""
    df = spark.read.format("jdbc").options(**options).load()
    return df if where is None else df.where(where)


def hourly_extract(
    df: DataFrame, as_of: datetime | str, ts: str = "endtime", hours: int = 1
) -> DataFrame:
    """Rows of the last full span before ``as_of``: ``as_of - hours <= ts < as_of``.

    The bounds are cast to the type of the column, so the filter reaches the scan.
    """
    kind = df.schema[ts].dataType
    upper = instant(as_of)
    lower = upper - F.make_interval(hours=F.lit(hours))
    return df.where((F.col(ts) >= lower.cast(kind)) & (F.col(ts) < upper.cast(kind)))
