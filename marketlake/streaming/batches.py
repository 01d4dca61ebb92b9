"""Micro-batches: files in, keyed tables out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Handler = Callable[[DataFrame, int], None]


def new_file_pickup(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the files of a folder; each file is delivered once per checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def topic_stream(
    spark: SparkSession, options: dict[str, str], messages_per_batch: int | None = None
) -> DataFrame:
    """A Kafka topic from its earliest message, where the connector is deployed.

    Consumer groups and commits are replaced by the checkpoint of the query. A batch
    takes all there is, unless ``messages_per_batch`` limits it.
    """
    settings = {"startingOffsets": "earliest", **options}
    if messages_per_batch:
        settings["maxOffsetsPerTrigger"] = str(messages_per_batch)
    return spark.readStream.format("kafka").options(**settings).load()


def stream_micro_batch(
    stream: DataFrame, fn: Handler, checkpoint: str, every: str = "5 seconds"
) -> StreamingQuery:
    """Run ``fn`` on every micro-batch until stopped.

    Offsets are committed after ``fn`` returned; if it fails, the same rows come
    again under the same batch number.
    """
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def drain_available(stream: DataFrame, fn: Handler, checkpoint: str) -> StreamingQuery:
    """Run ``fn`` on everything that is there, in batches, then stop.

    A later drain with the same checkpoint starts where this one ended.
    """
    query = (
        stream.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def keyed_append(path: str) -> Handler:
    """A handler that writes batch ``n`` to the folder ``batch=n`` and replaces it on a replay.

    A repeated batch never doubles rows, and no look at the rows already stored is needed.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows that :func:`keyed_append` has written."""
    return spark.read.schema(schema).parquet(f"{path}/batch=*")


def closing_row(rows: DataFrame, ts: str, delay: str = "400 days") -> DataFrame:
    """One row, empty but for a time far behind the last of ``rows``.

    Delivered after the end of an input it moves the watermark past everything that is open, so
    that a drain gives out the last windows. Its own window stays open.
    """
    last = rows.agg(F.max(ts).alias(ts)).where(F.col(ts).isNotNull())
    return last.select(
        *[
            (F.col(ts) + F.expr(f"INTERVAL {delay}")).cast(f.dataType).alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
            for f in rows.schema
        ]
    )
