"""Queries: streams over files made from the given tables, drained to their end."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import RECENT_HOURS
from ..operators.slices import Series
from ..runtime import durable, work_dir
from ..streaming import batches, operators, spool, stateful
from .base import HOURS, bars, bars_sql, candles_sql, landed, load, query, ticks

EVENTS = "event_id, ts, event_type, value"


def _events(spark, sf):
    return load(spark, sf, "events").select("event_id", "ts", "event_type", "value")


def drained(spark, stream, checkpoint=None):
    """All rows a stream gives, through a keyed sink."""
    out = work_dir(spark, "out")
    checkpoint = checkpoint or work_dir(spark, "checkpoint")
    batches.drain_available(stream, batches.keyed_append(out), checkpoint)
    return batches.committed(spark, out, stream.schema)


@query("stream_micro_batch", f"SELECT {EVENTS} FROM events")
def _(spark, sf):
    """A running query over all files, stopped when nothing is left."""
    rows = _events(spark, sf)
    path, files = landed(spark, rows, 4)
    stream = batches.new_file_pickup(spark, path, rows.schema, files_per_batch=files // 2)
    out = work_dir(spark, "out")
    running = batches.stream_micro_batch(
        stream, batches.keyed_append(out), work_dir(spark, "checkpoint"), "0 seconds"
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return batches.committed(spark, out, rows.schema)


@query("drain_available", f"SELECT {EVENTS} FROM events")
def _(spark, sf):
    rows = _events(spark, sf)
    path, files = landed(spark, rows, 4)
    return drained(spark, batches.new_file_pickup(spark, path, rows.schema, files_per_batch=files // 2))


SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"


def _two_drains(spark, sf):
    """Drain the first half of the month, add the second half, drain again."""
    rows = _events(spark, sf)
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    path, checkpoint = work_dir(spark, "landing"), work_dir(spark, "checkpoint")
    given = []
    for half in (early, ~early):
        rows.where(half).write.mode("append").parquet(path)
        stream = batches.new_file_pickup(spark, path, rows.schema)
        out = work_dir(spark, "out")
        batches.drain_available(stream, batches.keyed_append(out), checkpoint)
        given.append(batches.committed(spark, out, rows.schema))
    return given


@query("offset_tracking", f"SELECT {EVENTS} FROM events")
def _(spark, sf):
    """What two drains with one checkpoint gave together: every row once."""
    first, second = _two_drains(spark, sf)
    return first.unionByName(second)


@query("new_file_pickup", f"SELECT {EVENTS} FROM events WHERE ts >= {SPLIT}")
def _(spark, sf):
    """What the second drain gave: the rows of the files that were new."""
    return _two_drains(spark, sf)[1]


ARTICLE_DAYS, ARTICLE_SLICES = 30, 4


@query("stream_dedup", """
  SELECT key, count(*) > 0 AS seen FROM (SELECT md5(text) AS key FROM documents) GROUP BY key""")
def _(spark, sf):
    """Documents as a stream of articles, with equal texts given once.

    A text picks the day and hour of its article, and its copies come within the operator's own
    delay. The files come in order of time, a slice drained before the next, so no row is late and
    state expires on the way for any number of documents and any ids.
    """
    width, delay = ARTICLE_DAYS * 86_400, RECENT_HOURS * 3_600
    key = F.md5("text")
    second = F.pmod(F.xxhash64(key), F.lit(width)) + F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(delay))
    at = F.timestamp_seconds(F.lit(1_704_067_200) + second)
    rows = durable(load(spark, sf, "documents").select(key.alias("key"), at.alias("published"), second.alias("_second")))
    path, checkpoint, given = work_dir(spark, "landing"), work_dir(spark, "checkpoint"), []
    for k in range(ARTICLE_SLICES):
        place = F.least(F.floor(F.col("_second") * ARTICLE_SLICES / width), F.lit(ARTICLE_SLICES - 1))
        rows.where(place == k).drop("_second").write.mode("append").parquet(path)
        stream = batches.new_file_pickup(spark, path, rows.drop("_second").schema)
        given.append(drained(spark, operators.stream_dedup(stream, ["key"], "published"), checkpoint))
    once = reduce(DataFrame.unionByName, given)
    return once.groupBy("key").agg((F.count(F.lit(1)) == 1).alias("seen"))


@query("stream_max_24h", f"""
  SELECT symbol, state.v AS max_value, state.t AS max_timestamp
  FROM (SELECT symbol, list_reduce(list({{'v': close, 't': endtime}} ORDER BY endtime, event_id),
                 lambda acc, x: CASE WHEN x.t - acc.t >= INTERVAL 24 HOURS OR x.v > acc.v
                                     THEN x ELSE acc END) AS state
        FROM ({candles_sql("1h")}) GROUP BY symbol)""")
def _(spark, sf):
    rows = bars(spark, sf, "1h").select("event_id", "symbol", "endtime", "close")
    stream = batches.new_file_pickup(spark, landed(spark, rows, 4)[0], rows.schema)
    out = work_dir(spark, "out")
    held = operators.stream_max_24h(stream, Series(slice_seconds=HOURS.slice_seconds))
    writer = held.writeStream.outputMode("update").foreachBatch(batches.keyed_append(out))
    checkpoint = work_dir(spark, "checkpoint")
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    versions = spark.read.parquet(out)
    newest = versions.groupBy("symbol").agg(F.max_by(F.struct("max_value", "max_timestamp"), "batch").alias("s"))
    return newest.select("symbol", "s.max_value", "s.max_timestamp")


@query("stream_bars", f"""
  SELECT event_id, symbol, "interval", starttime, endtime, CAST(open AS DOUBLE) AS open,
         CAST(highest AS DOUBLE) AS highest, CAST(lowest AS DOUBLE) AS lowest, CAST(close AS DOUBLE) AS close,
         CAST(volume AS DOUBLE) AS volume, CAST(quotevolume AS DOUBLE) AS quotevolume
  FROM ({bars_sql("1h")})""")
def _(spark, sf):
    """All hour bars: the input ends, so a closing tick lets the watermark pass the last ones."""
    rows = ticks(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    path, _ = landed(spark, rows, 4)
    bars, checkpoint, given = operators.stream_bars, work_dir(spark, "checkpoint"), []
    for last in (False, True):
        if last:
            batches.closing_row(rows, "ts").write.mode("append").parquet(path)
        stream = batches.new_file_pickup(spark, path, rows.schema)
        given.append(drained(spark, bars(stream, "1h"), checkpoint))
    return given[0].unionByName(given[1])


# --- in order of time, with a disorder of up to three hours --------------------------
def in_slices(df, ts, slices=4, hours=3):
    """The rows in parts: each part's rows come before those of the next by time, give or take
    some hours that depend on the row."""
    at = F.unix_seconds(F.col(ts).cast("timestamp")) + F.pmod(F.xxhash64(*df.columns), F.lit(hours * 3_600))
    placed = durable(df.withColumn("_place", at))
    first, last = placed.agg(F.min("_place"), F.max("_place")).first()
    if first is None:
        return [df]
    part = F.floor((F.col("_place") - first) * slices / F.lit(last - first + 1))
    return [placed.where(part == k).drop("_place") for k in range(slices)]


def drained_in_slices(spark, rows, ts, make):
    """All rows that the stream ``make`` gives of the rows, part after part, and of a closing row."""
    path, checkpoint, given = work_dir(spark, "landing"), work_dir(spark, "checkpoint"), []
    with stateful.typed_state(spark):
        for part in [*in_slices(rows, ts), batches.closing_row(rows, ts)]:
            part.write.mode("append").parquet(path)
            given.append(drained(spark, make(batches.new_file_pickup(spark, path, rows.schema)), checkpoint))
    return given


@query("stream_max_24h_state", f"""
  SELECT symbol, state.v AS max_value, state.t AS max_timestamp
  FROM (SELECT symbol, list_reduce(list({{'v': close, 't': endtime}} ORDER BY endtime, event_id),
                 lambda acc, x: CASE WHEN x.t - acc.t >= INTERVAL 24 HOURS OR x.v > acc.v
                                     THEN x ELSE acc END) AS state
        FROM ({candles_sql("1m")}) GROUP BY symbol)""")
def _(spark, sf):
    """The decaying maximum from minute bars that come out of order, with state that expires."""
    rows = bars(spark, sf).select("event_id", "symbol", F.col("endtime").cast("timestamp").alias("endtime"), F.col("close").cast("double").alias("close"))
    given = drained_in_slices(spark, rows, "endtime", stateful.stream_max_24h)
    told = reduce(DataFrame.unionByName, [g.withColumn("drain", F.lit(k)) for k, g in enumerate(given)])
    # later slices of a symbol were given out later, and never hold an earlier candle
    newest = told.groupBy("symbol").agg(F.max_by(F.struct("max_value", "max_timestamp"), "max_timestamp").alias("s"))
    return newest.select("symbol", "s.max_value", "s.max_timestamp")


@query("stream_bars_of_all", " UNION ALL ".join(f"""
  SELECT event_id, symbol, "interval", starttime, endtime, CAST(open AS DOUBLE) AS open,
         CAST(highest AS DOUBLE) AS highest, CAST(lowest AS DOUBLE) AS lowest, CAST(close AS DOUBLE) AS close,
         CAST(volume AS DOUBLE) AS volume, CAST(quotevolume AS DOUBLE) AS quotevolume
  FROM ({bars_sql(every)})""" for every in ("1m", "5m", "15m", "1h", "1d")))
def _(spark, sf):
    """Bars of five intervals from one reading of the ticks, which come out of order."""
    given = drained_in_slices(spark, ticks(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), "ts", stateful.stream_bars_of_all)
    return reduce(DataFrame.unionByName, given)


@query("minimum_batch", f"SELECT {EVENTS}, 'whole' AS fate FROM events")
def _(spark, sf):
    """Files of a few rows each through a spool, with a sink that fails at its first and third
    batch: every row arrives once, and no batch but the last is below the least size."""
    rows = _events(spark, sf)
    files = 12
    least = max(5, rows.count() // 5)
    path, out, checkpoint, kept = (work_dir(spark, n) for n in ("landing", "out", "checkpoint", "spool"))
    rows.repartition(files).write.parquet(path)
    failures, sink = {1, 3}, batches.keyed_append(out)
    calls = []

    def fails(batch, number):
        calls.append(number)
        sink(batch, number)
        if len(calls) in failures:
            raise RuntimeError("the sink failed after it wrote")

    handler = spool.Spool(kept, rows.schema, fails, least)
    stream = lambda: batches.new_file_pickup(spark, path, rows.schema, files_per_batch=1)
    for _ in range(len(failures) + 1):
        try:
            batches.drain_available(stream(), handler, checkpoint)
        except StreamingQueryException:
            continue  # started again: the rows are still in the spool
        break
    handler.finish(spark)
    stored = batches.committed(spark, out, rows.schema).withColumn("_file", F.col("_metadata.file_path"))
    stored = stored.withColumn("batch", F.regexp_extract("_file", "batch=([0-9]+)", 1).cast("long"))
    sizes = stored.groupBy("batch").agg(F.count(F.lit(1)).alias("_n"))
    last = sizes.agg(F.max("batch")).first()[0]
    fate = F.when((F.col("_n") >= least) | (F.col("batch") == F.lit(last)), "whole").otherwise("short")
    told = sizes.withColumn("fate", fate).select("batch", "fate")
    return stored.join(told, "batch").select(*rows.columns, "fate")
