"""Typed state, minimum batches and counts of writing jobs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketlake.operators import rules, stats24h
from marketlake.operators.bars import kline_resample
from marketlake.operators.observed import Watch
from marketlake.plans import watched
from marketlake.runtime import work_dir
from marketlake.streaming import batches, spool, stateful

START = datetime(2024, 1, 1)


def deliver(spark, parts, make, closing=True):
    """Rows of a stream over parts that come one after the other."""
    path, out, checkpoint = (work_dir(spark, n) for n in ("landing", "out", "checkpoint"))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    ts = "endtime" if "endtime" in whole.columns else "ts"
    with stateful.typed_state(spark):
        for k, part in enumerate([*parts, *([batches.closing_row(whole, ts)] if closing else [])]):
            part.coalesce(1).write.mode("append").parquet(path)
            stream = make(batches.new_file_pickup(spark, path, whole.schema))
            query = (
                stream.writeStream.foreachBatch(batches.keyed_append(f"{out}/drain={k}"))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            )
            query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/drain=*/batch=*"), query


def held(rows):
    best = {}
    for r in rows.collect():
        if r["symbol"] not in best or r["max_timestamp"] >= best[r["symbol"]][1]:
            best[r["symbol"]] = (r["max_value"], r["max_timestamp"])
    return best


def test_maximum_of_candles_out_of_order(spark, candles):
    r = random.Random(3)
    rows = [(s, i * 90, 100 + r.gauss(0, 4) - i / 4) for s in ("a", "b", "c") for i in range(60)]
    rows = [x for x in rows if not (x[0] == "b" and 20 < x[1] / 90 < 45)]  # a gap: its state expires
    df = candles(rows)
    late = F.unix_seconds("endtime") + F.pmod(F.xxhash64("event_id"), F.lit(3 * 3_600))
    bounds = [0, 20, 45, 80, 1000]
    at = [F.lit(int(START.timestamp())) + b * 3_600 for b in bounds]
    parts = [df.where((late >= low) & (late < high)) for low, high in zip(at, at[1:])]
    given, query = deliver(spark, parts, lambda s: stateful.stream_max_24h(s, 7_200))
    assert held(given) == {x.symbol: (x.max_value, x.max_timestamp) for x in stats24h.max_24h_cache(df).collect()}
    states = query.lastProgress["stateOperators"]
    assert all(s["numRowsTotal"] == 0 for s in states if s["operatorName"] == "transformWithStateInPySparkExec"), states


def test_maximum_from_an_earlier_cache(spark, candles):
    df = candles([("a", 60, 5.0), ("b", 60, 5.0), ("d", 60, 5.0)])
    cache = spark.createDataFrame(
        [("a", 9.0, START), ("b", 9.0, START - timedelta(hours=30)), ("c", 7.0, START)], stateful.HOLDER
    )
    given, _ = deliver(spark, [df], lambda s: stateful.stream_max_24h(s, 3_600, initial=cache))
    wanted = {x.symbol: (x.max_value, x.max_timestamp) for x in stats24h.max_24h_cache(df, cache).collect()}
    found = held(given)
    assert {s: wanted[s] for s in found} == found and set(found) == {"a", "b", "d"}


TICKS = "symbol string, ts timestamp, event_id long, price decimal(18,2), qty decimal(18,2)"


def test_bars_of_all_intervals(spark):
    r = random.Random(4)
    rows = [
        (s, START + timedelta(seconds=r.randrange(0, 3 * 86_400)), i, round(r.uniform(1, 9), 2), round(r.uniform(1, 9), 2))
        for i, s in enumerate(["a", "b", None] * 150)
    ]
    rows += [("a", START + timedelta(hours=5), 1000, None, 1.0)]
    from decimal import Decimal

    rows = [(s, t, i, None if p is None else Decimal(str(p)), Decimal(str(q))) for s, t, i, p, q in sorted(rows, key=lambda x: x[1])]
    df = spark.createDataFrame(rows, TICKS)
    cut = START + timedelta(hours=30)
    back = F.col("event_id") % 7 == 0  # some come a part later, within the delay
    soon = F.col("ts") < F.lit(cut - timedelta(hours=2))
    first = soon | ((F.col("ts") < F.lit(cut)) & ~back)
    given, _ = deliver(spark, [df.where(first), df.where(~first)], stateful.stream_bars_of_all)
    key = lambda x: (str(x["symbol"]), x["interval"], x["starttime"])
    found = sorted(given.collect(), key=key)
    wanted = []
    for every in ("1m", "5m", "15m", "1h", "1d"):
        wanted += kline_resample(df, every).collect()
    show = lambda x: tuple(float(v) if isinstance(v, Decimal) else v for v in x)
    assert [show(x) for x in found] == [show(x) for x in sorted(wanted, key=key)]


def test_intervals_must_nest(spark):
    ticks = spark.createDataFrame([], TICKS)
    for wrong in (["5m", "1m", "7m"], ["15m", "1h", "40m"]):
        with pytest.raises((KeyError, ValueError)):
            stateful.stream_bars_of_all(ticks, wrong)


class Clock:
    now = 1_000.0

    def __call__(self):
        return self.now


def test_spool_waits_for_enough_rows(spark):
    path, out = work_dir(spark, "spool"), work_dir(spark, "out")
    sizes, sink, schema = [], batches.keyed_append(out), spark.range(1).schema

    def keep(batch, number):
        sink(batch, number)
        sizes.append((number, batch.count()))

    handler = spool.Spool(path, schema, keep, 5)
    for number, n in enumerate([2, 2, 0, 3, 9, 1, 1]):
        handler(spark.range(10 * number, 10 * number + n), number)
    assert sizes == [(3, 7), (4, 9)]
    handler(spark.range(40, 49), 4)  # delivered again after it was handed over
    assert sizes == [(3, 7), (4, 9)]
    assert spool.Spool(path, schema, keep, 5).finish(spark) == 2  # a new process goes on
    assert sizes[-1] == (6, 2) and spool.Spool(path, schema, keep, 5).finish(spark) == 0
    stored = batches.committed(spark, out, schema)
    assert stored.count() == stored.distinct().count() == 18


def test_spool_hands_over_what_waited_too_long(spark):
    clock, got = Clock(), []
    handler = spool.Spool(work_dir(spark, "spool"), spark.range(1).schema, lambda b, n: got.append(b.count()), 5, 60, clock)
    handler(spark.range(1), 0)
    clock.now += 59
    handler(spark.range(1), 1)
    assert got == []
    clock.now += 1
    handler(spark.range(0), 2)
    assert got == [2]


def test_spool_keeps_rows_of_a_failed_batch(spark):
    path, out, checkpoint, kept = (work_dir(spark, n) for n in ("landing", "out", "checkpoint", "spool"))
    rows = spark.range(30)
    rows.repartition(6).write.parquet(path)
    sink, tries = batches.keyed_append(out), []

    def fails(batch, number):
        sink(batch, number)
        tries.append((number, batch.count()))
        if len(tries) < 3:
            raise RuntimeError("the sink is down")

    handler = spool.Spool(kept, rows.schema, fails, 12)
    stream = lambda: batches.new_file_pickup(spark, path, rows.schema, files_per_batch=1)
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            batches.drain_available(stream(), handler, checkpoint)
    batches.drain_available(stream(), handler, checkpoint)
    handler.finish(spark)
    assert tries[0] == tries[1] == tries[2] and all(n >= 12 for _, n in tries[:-1])
    stored = batches.committed(spark, out, rows.schema)
    assert stored.count() == stored.distinct().count() == 30
    with pytest.raises(ValueError):
        spool.Spool(kept, spark.range(1).toDF("spool_batch").schema, fails)


NEWS = "domain string, title string, url string, text string, published string, author string, authors string, source string, tag string"


def article(i, **more):
    row = {"domain": "d", "title": f"t{i}", "url": f"u{i}", "text": "x", "published": "2024-01-01", "author": "a", "authors": None, "source": "s", "tag": "economy"}
    return tuple({**row, **more}.values())


def counts(report):
    return {(r["step"], r["measure"], r["column"]): r["n"] for r in report.collect()}


def test_news_are_read_once_and_counted(spark):
    rows = [article(0), article(1, text=""), article(1, text=None), article(2, tag=None), article(3, url="u0"), article(4, author=None, published="")]
    path = work_dir(spark, "raw")
    spark.createDataFrame(rows, NEWS).write.parquet(path)
    raw = spark.read.schema(NEWS).parquet(path)
    done = watched.news_quality_written(raw, work_dir(spark, "out"), [rules.not_null("author"), rules.min_row_count(9)])
    found = counts(done.report)
    assert found["raw", "n_rows", "*"] == 6 and found["raw", "n_blank", "text"] == 1 and found["raw", "n_null", "text"] == 1
    assert found["raw", "not_null", "author"] == 1 and found["raw", "min_row_count", "*"] == 3
    assert found["filled", "n_rows", "*"] == 3 and found["unique", "n_rows", "*"] == 2
    assert found["checked", "n_accepted", "*"] == 1 == done.clean.count()
    assert found["checked", "violations of tag", "*"] == 1 == done.rejected.count()
    empty = watched.news_quality_written(raw.where("false"), work_dir(spark, "out"))
    assert counts(empty.report)["checked", "n_rows", "*"] == 0 and empty.clean.count() == 0


def test_one_scan_for_rows_and_counts(spark):
    path = work_dir(spark, "raw")
    spark.createDataFrame([article(0)], NEWS).write.parquet(path)
    watch = Watch()
    df = watch.rows(spark.read.schema(NEWS).parquet(path), "raw", ["text"])
    plan = watched.checked_and_marked(df, watched.NEWS_CONTRACT, watch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("CollectMetrics") == 2
    with pytest.raises(ValueError):
        watch.rows(df, "raw")
    with pytest.raises(ValueError):
        Watch().rows(df, "x", rules=[rules.unique_column("url")])


def test_open_bars_cost_one_write_and_one_timer_a_batch():
    import pandas as pd

    calls, timers, kept = [], [], []

    class Listed:
        exists = staticmethod(lambda: bool(kept))
        get = staticmethod(lambda: iter(kept))

        def put(self, rows):
            calls.append("put")
            kept[:] = rows

        def clear(self):
            kept.clear()

    class Handle:
        getListState = staticmethod(lambda name, schema: Listed())
        registerTimer = staticmethod(timers.append)

    class At:
        getExpiryTimeInMs = getCurrentWatermarkInMs = staticmethod(lambda: 600_000)

    roll = stateful.Rollup([("5m", 300), ("1h", 3600)], "decimal(38,4)")
    roll.init(Handle())
    start = pd.to_datetime([60 * i for i in range(60)], unit="s", utc=True)
    bars = pd.DataFrame({"event_id": [str(i) for i in range(60)], "symbol": "s", "interval": "1m", "starttime": start, "endtime": start})
    told = list(roll.handleInputRows(("s", 0), iter([bars.assign(**dict.fromkeys(roll.NUMBERS, 1))]), At()))
    assert len(told[0]) == 60 and calls == ["put"] and timers == [300_000]
    over = list(roll.handleExpiredTimer(("s", 0), At(), At()))
    assert [tuple(r) for r in over[0][["event_id", "volume"]].itertuples(index=False)] == [(4, 5), (9, 5)]
    assert timers == [300_000, 900_000] and len(kept) == 11
