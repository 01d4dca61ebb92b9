"""Checked records to silver rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import ingest_time, partition_parts
from ..operators.filters import as_instant
from ..schemas import SILVER

# Time columns of the entities.
TIME_COLUMNS = {
    "news": ("published",),
    "comments": ("created_utc",),
    "realtime": ("starttime", "endtime"),
    "technical": ("endtime",),
    "sentiment": ("endtime",),
}


def to_silver(df: DataFrame, entity: str, as_of: datetime | str | None = None) -> DataFrame:
    """Typed columns of a silver table, with the hour of ingest as partition.

    Without ``as_of`` the clock of the query is used, as streams need it.
    """
    times = {n: as_instant(df, n) for n in TIME_COLUMNS[entity]}
    with_parts = df.withColumns({**times, **partition_parts(ingest_time(as_of))})
    return with_parts.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER[entity]]
    )
