"""Silver, gold and row-store tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.stats24h import max_cache_upsert
from ..plans.silver import to_silver
from ..schemas import GOLD, PARTITIONED_BY, SILVER
from ..sources.raw import json_topic_decode
from ..sources.tables import parquet_or_empty
from .marks import Mark

CACHE = "symbol string, max_value double, max_timestamp timestamp"


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str) -> None:
    if partition_by:
        # One shuffle on the partition columns keeps the number of files near the
        # number of partitions; the adaptive planner splits those that are large.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def silver_append(
    df: DataFrame,
    entity: str,
    root: str,
    as_of: datetime | str | None = None,
    batch: int | None = None,
) -> str:
    """Append checked records to a silver table, partitioned by hour of ingest.

    All rows have the same hour, so they are written where they are, without a
    shuffle. A numbered ``batch`` of a stream has a folder of its own and replaces it
    when it comes again; a table takes numbered batches or plain ones, not both.
    """
    path = f"{root.rstrip('/')}/silver/{entity}"
    rows = to_silver(df, entity, as_of).write.option("compression", "zstd").partitionBy(*PARTITIONED_BY[f"silver.{entity}"])
    if batch is None:
        rows.mode("append").parquet(path)
    else:
        rows.mode("overwrite").parquet(f"{path}/batch={batch}")
    return path


def silver_handler(
    entity: str, schema: StructType, root: str, as_of: datetime | str | None = None, value: str = "value"
) -> Callable[[DataFrame, int], None]:
    """What a stream of a topic runs per micro-batch: messages decoded and appended to silver,
    broken ones to ``rejects``, both under the number of the batch."""

    def handle(messages: DataFrame, number: int) -> None:
        good, broken = json_topic_decode(messages, schema, value)
        silver_append(good, entity, root, as_of, number)
        broken.write.mode("overwrite").parquet(f"{root.rstrip('/')}/rejects/{entity}/batch={number}")

    return handle


def missing_rows(df: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet; NULL keys compare as equal."""
    taken = stored.select(*[F.col(k).alias(f"_stored_{k}") for k in key])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in key])
    return df.join(taken, same, "left_anti")


def gold_append(
    df: DataFrame, table: str, root: str, key: Sequence[str], stored: DataFrame | None = None
) -> str:
    """Append the rows of a gold table whose key it does not hold, so reruns add nothing.

    ``stored`` may be a part of the table that is known to hold all candidates,
    say the partitions of the same hour; only its key columns are read.
    """
    path = f"{root.rstrip('/')}/gold/{table}"
    if stored is not None:
        df = missing_rows(df, stored, key)
    _write(df, path, PARTITIONED_BY[f"gold.{table}"], "append")
    return path


def jdbc_append(df: DataFrame, options: dict[str, str]) -> None:
    """Append to a row-store table. Needs the driver jar of the store on the class path."""
    df.write.format("jdbc").options(**options).mode("append").save()


def max_cache_write(cache: DataFrame, newest: DataFrame, path: str) -> None:
    """The next version of the maximum cache, written beside the version it was made from."""
    max_cache_upsert(cache, newest).write.mode("overwrite").parquet(path)


def max_cache(spark: SparkSession, root: str) -> DataFrame:
    """The current version of the maximum cache below ``root``; a version that was begun and not
    finished is not looked at."""
    number = Mark(spark, root).newest()
    return parquet_or_empty(spark, f"{root.rstrip('/')}/version={number}" if number >= 0 else [], CACHE)


def max_cache_next(spark: SparkSession, root: str, newest: DataFrame) -> int:
    """Writes the next version of the cache below ``root`` and makes it the current one; returns
    its number. Readers see the old version until the new one is whole; a step that fails is
    simply done again."""
    number = Mark(spark, root).newest() + 1
    max_cache_write(max_cache(spark, root), newest, f"{root.rstrip('/')}/version={number}")
    Mark(spark, root).set(number)
    return number


def lakehouse_ddl(
    spark: SparkSession, root: str, prefix: str = "", fmt: str = "parquet"
) -> list[str]:
    """Create the five silver and eight gold tables; returns their names.

    ``fmt`` may name any table format the session knows.
    """
    names = []
    for layer, tables in (("silver", SILVER), ("gold", GOLD)):
        database = f"{prefix}{layer}"
        folder = f"{root.rstrip('/')}/{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")
        for name, schema in tables.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            parts = ", ".join(PARTITIONED_BY[f"{layer}.{name}"])
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING {fmt}"
                + (f" PARTITIONED BY ({parts})" if parts else "")
                + f" LOCATION '{folder}/{name}'"
            )
            names.append(f"{database}.{name}")
    return names
