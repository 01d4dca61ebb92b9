"""Row filters and column changes of the quality jobs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.times import epoch_to_timestamp, instant, parse_timestamp
from ..schemas import PARTITION_COLUMNS

# Fixed value: how old news and comments may be.
RECENT_HOURS = 4


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames the columns that exist."""
    return df.withColumnsRenamed(names)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts; values that do not fit become NULL."""
    return df.withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})


def nonblank_filter(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows where all the named columns are neither NULL nor the empty string."""
    return df.where(reduce(and_, [F.col(n).isNotNull() & (F.col(n) != "") for n in names]))


def dropna_any(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def as_instant(df: DataFrame, name: str) -> Column:
    """A column of text, epoch numbers or timestamps as a timestamp; NULL if unreadable."""
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return parse_timestamp(name)
    if isinstance(kind, NumericType):
        return epoch_to_timestamp(name)
    return F.col(name).cast("timestamp")


def _bounds(df: DataFrame, name: str, lower: Column, upper: Column | None) -> Column:
    """Half-open range test that still reaches the scan for real time columns."""
    kind = df.schema[name].dataType
    if isinstance(kind, (StringType, NumericType)):
        value = as_instant(df, name)
    else:
        value, lower = F.col(name), lower.cast(kind)
        upper = None if upper is None else upper.cast(kind)
    return value >= lower if upper is None else (value >= lower) & (value < upper)


def recency_filter(
    df: DataFrame, name: str, as_of: datetime | str, hours: int = RECENT_HOURS
) -> DataFrame:
    """Rows with ``as_of - hours <= t < as_of``; unreadable and NULL times are dropped."""
    upper = instant(as_of)
    return df.where(_bounds(df, name, upper - F.make_interval(hours=F.lit(hours)), upper))


def threshold_filter(df: DataFrame, name: str, lower: datetime | str) -> DataFrame:
    """Rows strictly after a fixed instant; unreadable and NULL times are dropped."""
    bound, kind = instant(lower), df.schema[name].dataType
    if isinstance(kind, (StringType, NumericType)):
        return df.where(as_instant(df, name) > bound)
    return df.where(F.col(name) > bound.cast(kind))


def latest_partition(df: DataFrame) -> DataFrame:
    """One row: the newest (year, month, day, hour). Only these columns are read."""
    newest = F.max(F.struct(*PARTITION_COLUMNS)).alias("p")
    return df.agg(newest).where("p IS NOT NULL").select("p.*")


def latest_partition_filter(df: DataFrame) -> DataFrame:
    """Rows of the newest partition.

    Its four numbers are fetched first and put in as literals, so that the scan
    of a partitioned table lists one folder only. Fails on an empty table.
    """
    newest = latest_partition(df).first()
    if newest is None:
        raise ValueError("the table has no partition")
    return df.where(reduce(and_, [F.col(c) == F.lit(newest[c]) for c in PARTITION_COLUMNS]))
