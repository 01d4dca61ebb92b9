"""Means over the whole history against a fold, and sketches against exact counts."""

import random

from pyspark.sql import functions as F

from marketlake.operators import profile, recursive, regimes, sketches, swings
from marketlake.operators.slices import Series


def fold(values, span):
    a, mean, out = 2 / (span + 1), None, []
    for x in values:
        if x is not None:
            mean = x if mean is None else a * x + (1 - a) * mean
        out.append(mean)
    return out


def test_means_equal_a_fold_over_the_history(spark, candles):
    r = random.Random(7)
    walks = {s: sorted(r.sample(range(3_000), 120)) for s in ("a", "b")}
    rows = [(s, m, 100 + r.gauss(0, 5)) for s, minutes in walks.items() for m in minutes]
    rows += [("one", 5, 7.0)]
    df = candles(rows).withColumn("close", F.when(F.col("event_id") % 11 != 0, F.col("close")))
    found = recursive.ema_history(df, "close", {"e3": 3, "e26": 26}, Series(slice_seconds=3_600)).collect()
    assert len(found) == len(rows)
    for symbol in ("a", "b", "one"):
        own = sorted((x for x in found if x.symbol == symbol), key=lambda x: x.endtime)
        for name, span in (("e3", 3), ("e26", 26)):
            for x, wanted in zip(own, fold([x.close for x in own], span), strict=True):
                assert (x[name] is None) == (wanted is None) and (wanted is None or abs(x[name] - wanted) < 1e-9)


def test_no_rows(spark, candles):
    assert recursive.macd_history(candles([("a", 0, 1.0)]).where("false")).collect() == []


def test_sketches_of_hours_merge(spark):
    df = spark.range(20_000).select(
        F.expr("id % 24").alias("hour"), F.expr("id % 3000").alias("n"), F.expr("CASE WHEN id % 5 > 0 THEN concat('t', id % 700) END").alias("t"),
        F.expr("CASE WHEN id % 2 = 0 THEN '' ELSE 'x' END").alias("blank"), F.expr("cast(id % 50 AS double) / 3").alias("d"),
    )
    names = ["n", "t", "blank", "d"]
    stored = sketches.distinct_sketches(df, ["hour"], names)
    assert stored.count() == 24 * 4
    exact = {r["column"]: r.n_distinct for r in profile.distinct_profile(df, names).collect()}
    for some, bound in ((stored, exact), (stored.where("hour < 0"), {})):
        found = {r["column"]: (r.n_estimate, r.n_rows) for r in sketches.distinct_estimate(some).collect()}
        assert set(found) == set(bound)
        for name, n in bound.items():
            assert abs(found[name][0] - n) <= sketches.relative_error() * n and found[name][1] == 20_000


def test_last_known_values_over_gaps_and_slices(spark, candles):
    r = random.Random(9)
    rows = [(s, m, 1.0) for s in ("a", "b") for m in r.sample(range(4_000), 80)] + [("c", 5, 1.0)]
    df = candles(rows)
    events, frames = {}, {}
    for name in ("x", "y"):
        events[name] = [(s, m, i if i % 9 else None) for s in ("a", "b") for i, m in enumerate(sorted(r.sample(range(4_000), 25)))]
        events[name] += [("a", rows[0][1], 77)] if ("a", rows[0][1]) not in {e[:2] for e in events[name]} else []
        at = candles([(s, m, 0.0) for s, m, _ in events[name]]).select("event_id", "symbol", F.col("endtime").alias("at"))
        values = spark.createDataFrame([(i, e[2]) for i, e in enumerate(events[name])], "event_id long, value int")
        frames[name] = at.join(values, "event_id").select("symbol", "at", "value")
    found = regimes.last_known(df, frames, Series(slice_seconds=7_200)).collect()
    assert len(found) == len(rows)
    minute = {x.event_id: rows[x.event_id] for x in found}
    for x in found:
        symbol, m, _ = minute[x.event_id]
        for name in events:
            past = [e for e in events[name] if e[0] == symbol and e[1] <= m and e[2] is not None]
            assert x[name] == (max(past, key=lambda e: e[1])[2] if past else None)


def test_swing_points_with_ties_plateaus_and_slices(spark, candles):
    r = random.Random(11)
    closes = [100 + r.randrange(-4, 5) for _ in range(400)] + [100] * 10 + [101] * 9 + [100] * 5
    df = candles([("a", m, c) for m, c in enumerate(closes)] + [("b", 3, 1.0), ("b", 9, 2.0)])
    whole = swings.swing_divergence(df, 3, Series(slice_seconds=10**9)).collect()
    cut = swings.swing_divergence(df, 3, Series(slice_seconds=600)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, cut))
    minute = lambda x: (x.swing_at.timestamp() - min(y.swing_at.timestamp() for y in cut)) / 60
    wanted = {}
    for i in range(3, len(closes) - 3):
        before, after = closes[i - 3 : i], closes[i + 1 : i + 4]
        if closes[i] > max(before) and closes[i] >= max(after):
            wanted[i] = "peak"
        elif closes[i] < min(before) and closes[i] <= min(after):
            wanted[i] = "trough"
    first = min(wanted)
    assert {first + minute(x): x.swing for x in cut} == wanted
    last = {}
    for x in sorted(cut, key=lambda x: x.endtime):
        assert (x.endtime - x.swing_at).total_seconds() == 180 and x.price_before == last.get(x.swing)
        last[x.swing] = x.price
    marks = {(x.swing, x.rsi_divergence) for x in cut}
    assert ("peak", "bearish") in marks and ("trough", "bullish") in marks and ("peak", "bullish") not in marks
