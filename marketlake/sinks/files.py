"""JSON files and topics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.raw import hour_folder


def raw_landing_write(
    df: DataFrame, root: str, entity: str, as_of: datetime, batch: int | None = None
) -> str:
    """Append rows to the hour folder of their entity; Spark names the files uniquely.

    A numbered ``batch`` of a stream lands in a folder of its own below the hour, which it
    replaces when it comes again. Files are compressed, as every later run of the hour reads them again.
    """
    folder = hour_folder(root, entity, as_of)
    if batch is None:
        df.write.mode("append").json(folder, compression="gzip")
    else:
        df.write.mode("overwrite").json(f"{folder}/batch-{batch}", compression="gzip")
    return folder


def jsonl_write(df: DataFrame, path: str, by: str) -> None:
    """One JSON object per line, one folder per value of ``by`` (a coin, a feed group)."""
    df.write.mode("append").partitionBy(by).json(path)


def topic_messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON message without a key."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def topic_json_write(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    """Send the rows to a topic (``kafka``, where its connector is deployed) or to text files.

    The executors write; nothing passes through the driver.
    """
    writer = topic_messages(df).write.format(fmt).options(**options)
    (writer if fmt == "kafka" else writer.mode(mode)).save()
