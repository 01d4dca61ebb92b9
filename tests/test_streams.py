"""Streams against their batch forms, replays and late rows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from marketlake.operators import stats24h
from marketlake.operators.slices import Series
from marketlake.queries.base import landed
from marketlake.runtime import work_dir
from marketlake.sources.raw import json_topic_decode
from marketlake.schemas import table
from marketlake.streaming import batches, operators

START = datetime(2024, 1, 1)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(stream, out, checkpoint, mode="append"):
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(batches.keyed_append(out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def test_landed_files_grow_in_number_not_in_size(spark):
    for tasks, files in ((1, 4), (9, 9)):
        path, n = landed(spark, spark.range(0, 900, 1, tasks), 4)
        found = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
        assert n == files == len(found) and max(r["count"] for r in found) <= 1.1 * 900 / files


def test_a_batch_delivered_twice_is_stored_once(spark):
    out = work_dir(spark, "out")
    write = batches.keyed_append(out)
    write(spark.range(10), 0)
    write(spark.range(10, 15), 1)
    write(spark.range(10, 15), 1)
    assert batches.committed(spark, out, spark.range(1).schema).count() == 15


def test_failed_batch_comes_again(spark):
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    rows = spark.range(100)
    rows.repartition(4).write.parquet(path)
    stream = lambda: batches.new_file_pickup(spark, path, rows.schema, files_per_batch=1)
    keep, seen = batches.keyed_append(out), []

    def fail_once(batch, number):
        keep(batch, number)
        seen.append(number)
        if number == 2 and seen.count(2) == 1:
            raise RuntimeError("the handler failed after it wrote")

    try:
        batches.drain_available(stream(), fail_once, checkpoint)
        raise AssertionError("the failure was lost")
    except Exception as error:
        assert "failed" in str(error).lower()
    batches.drain_available(stream(), fail_once, checkpoint)
    assert seen == [0, 1, 2, 2, 3]
    stored = batches.committed(spark, out, rows.schema)
    assert stored.count() == stored.distinct().count() == 100
    batches.drain_available(stream(), fail_once, checkpoint)
    assert seen == [0, 1, 2, 2, 3]


def test_maximum_over_batches_is_the_batch_result(spark, candles):
    r = random.Random(5)
    walks = {s: [(i * 90, 100 + r.gauss(0, 4) - i / 4) for i in range(120)] for s in ("a", "b", "c")}
    df = candles([(s, m, c) for s, rows in walks.items() for m, c in rows])
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    bounds = [START + timedelta(days=d) for d in (0, 2, 3, 9)]
    for low, high in zip(bounds, bounds[1:]):
        land(df.where((F.col("endtime") >= low) & (F.col("endtime") < high)), path)
        stream = batches.new_file_pickup(spark, path, df.schema)
        run(operators.stream_max_24h(stream, Series(slice_seconds=7_200)), out, checkpoint, "update")
        newest = spark.read.parquet(out).groupBy("symbol").agg(
            F.max_by(F.struct("max_value", "max_timestamp"), "batch").alias("s")
        )
        found = {x.symbol: (x.s.max_value, x.s.max_timestamp) for x in newest.collect()}
        so_far = stats24h.max_24h_cache(df.where(F.col("endtime") < high))
        assert found == {x.symbol: (x.max_value, x.max_timestamp) for x in so_far.collect()}


def tick(minute, price, id):
    return ("a", START + timedelta(minutes=minute), id, float(price), 1.0)


def test_bars_come_once_and_late_ticks_do_not_change_them(spark):
    schema = "symbol string, ts timestamp, event_id long, price double, qty double"
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    rows = spark.createDataFrame([], schema)
    deliveries = (
        [tick(0, 10, 1), tick(30, 12, 2), tick(70, 9, 3)],
        [tick(45, 14, 4), tick(400, 8, 5)],  # 45: late, but its bar is open
        [tick(50, 99, 6), tick(1000, 7, 7)],  # 50: the watermark has passed its bar
    )
    for ticks in deliveries:
        land(spark.createDataFrame(ticks, schema), path)
        stream = batches.new_file_pickup(spark, path, rows.schema)
        run(operators.stream_bars(stream, "1h"), out, checkpoint)
    found = spark.read.parquet(out).orderBy("starttime").collect()
    assert [(r.starttime.hour, r.open, r.highest, r.lowest, r.close, r.volume) for r in found] == [
        (0, 10, 14, 10, 14, 3), (1, 9, 9, 9, 9, 1), (6, 8, 8, 8, 8, 1)]


def test_repeats_are_dropped_over_batches(spark):
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    schema = "url string, published timestamp"
    rows = spark.createDataFrame([], schema)
    for urls in (["a", "b", "a"], ["b", "c"], ["c", "a", "d"]):
        land(spark.createDataFrame([(u, START) for u in urls], schema), path)
        stream = batches.new_file_pickup(spark, path, rows.schema)
        run(operators.stream_dedup(stream, ["url"], "published"), out, checkpoint)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]


def test_a_key_comes_again_after_its_delay_for_any_layout_of_files(spark):
    schema = "url string, published timestamp"
    at = lambda h: START + timedelta(hours=h)
    for files in (1, 3):
        path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
        for rows in ([("a", at(0))], [("a", at(3)), ("x", at(9))], [("a", at(6)), ("y", at(9))]):
            df = spark.createDataFrame(rows, schema)
            df.repartition(files).write.mode("append").parquet(path)
            run(operators.stream_dedup(batches.new_file_pickup(spark, path, df.schema), ["url"], "published"), out, checkpoint)
        found = spark.read.parquet(out).where("url = 'a'").collect()
        assert sorted(r.published.hour for r in found) == [0, 6]


def test_dedup_query_gives_every_text_for_any_ids(spark, tmp_path):
    from marketlake.queries import QUERIES

    ids = [k * step for step in (1, 25_000) for k in range(120)]
    rows = [(i, None if i % 7 == 1 else f"text {i % 90}") for i in ids]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["stream_dedup"](spark, str(tmp_path)).collect()
    assert len(found) == len({r.key for r in found}) == len({t for _, t in rows})
    assert all(r.seen for r in found)


def test_dedup_query_on_one_row(spark, tmp_path):
    from marketlake.queries import QUERIES

    spark.createDataFrame([(None, "one")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.seen for r in QUERIES["stream_dedup"](spark, str(tmp_path)).collect()] == [True]


def test_a_row_behind_the_watermark_is_dropped_and_one_within_the_delay_is_not(spark):
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    schema = "url string, published timestamp"
    at = lambda h: START + timedelta(hours=h)
    for rows in ([("a", at(0)), ("b", at(10))], [("c", at(1)), ("d", at(7)), ("b", at(7))]):
        df = spark.createDataFrame(rows, schema)
        land(df, path)
        run(operators.stream_dedup(batches.new_file_pickup(spark, path, df.schema), ["url"], "published"), out, checkpoint)
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "d"]


def test_bars_of_ticks_are_not_sorted(spark):
    from marketlake.operators.bars import kline_resample

    schema = "symbol string, ts timestamp, event_id long, price decimal(18,2), qty decimal(18,2)"
    plan = kline_resample(spark.createDataFrame([], schema), "1h")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def test_a_truncated_message_does_not_stop_the_stream(spark):
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    rows = spark.createDataFrame([('{"a":1}',), ('{"a":',), ('{"a":3}',)], "value string")
    land(rows, path)
    good, broken = json_topic_decode(batches.new_file_pickup(spark, path, rows.schema), table("a int"))
    run(good, out, checkpoint)
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == [1, 3]
    bad, other = work_dir(spark, "bad"), work_dir(spark, "checkpoint")
    run(broken, bad, other)
    assert [r.value for r in spark.read.parquet(bad).collect()] == ['{"a":']
