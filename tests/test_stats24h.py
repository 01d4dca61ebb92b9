"""24-hour statistics against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators import stats24h
from marketlake.operators.slices import Series

START = datetime(2024, 1, 1)
DAY = timedelta(hours=24)


def fold(rows, state=None):
    """The held maximum after all (time, close) in order."""
    for at, close in rows:
        if state is None or at - state[1] >= DAY or close > state[0]:
            state = (close, at)
    return state


def histories(seed):
    """Random walks, falling prices, gaps of days, equal times and equal prices."""
    r = random.Random(seed)
    out = {}
    for symbol in ("walk", "falling", "gaps", "ties"):
        minute, price, rows = 0, 500.0, []
        for _ in range(r.choice([1, 40, 300])):
            minute += {"gaps": r.choice([10, 700, 1440, 4000]), "ties": r.choice([0, 0, 300])}.get(symbol, 60)
            price += -0.5 if symbol == "falling" else r.gauss(0, 3)
            rows.append((minute, round(price) if symbol == "ties" else price))
        out[symbol] = rows
    return out


def by_symbol(df):
    return {r.symbol: (r.max_value, r.max_timestamp) for r in df.collect()}


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("slice_hours", [1, 30, 24 * 16])
def test_cache_is_the_ordered_fold(candles, seed, slice_hours):
    data = histories(seed)
    df = candles([(s, m, c) for s, rows in data.items() for m, c in rows])
    found = by_symbol(stats24h.max_24h_cache(df, series=Series(slice_seconds=3_600 * slice_hours)))
    expected = {
        s: fold([(START + timedelta(minutes=m), float(c)) for m, c in rows]) for s, rows in data.items()
    }
    assert found == expected


def test_cache_goes_on_from_a_state(candles):
    data = histories(11)["walk"]
    half = len(data) // 2
    frame = lambda rows: candles([("walk", m, c) for m, c in rows])
    series = Series(slice_seconds=7_200)
    first = stats24h.max_24h_cache(frame(data[:half]), series=series) if half else None
    both = stats24h.max_24h_cache(frame(data[half:]), first, series)
    assert by_symbol(both) == by_symbol(stats24h.max_24h_cache(frame(data), series=series))


def test_reset_at_exactly_one_day(candles):
    rows = [("a", 0, 10.0), ("a", 1440, 1.0), ("b", 0, 10.0), ("b", 1439, 1.0)]
    found = by_symbol(stats24h.max_24h_cache(candles(rows)))
    assert found["a"][0] == 1.0 and found["b"][0] == 10.0


def test_upsert_inserts_keeps_replaces_and_resets(spark):
    cache = spark.createDataFrame(
        [("keep", 9.0, START), ("higher", 9.0, START), ("old", 9.0, START), ("quiet", 9.0, START)],
        "symbol string, max_value double, max_timestamp timestamp",
    )
    newest = spark.createDataFrame(
        [
            ("keep", 8.0, START + timedelta(seconds=86_399)),
            ("higher", 9.5, START + timedelta(hours=1)),
            ("old", 1.0, START + timedelta(seconds=86_400)),
            ("new", 2.0, START),
        ],
        "symbol string, close double, endtime timestamp",
    )
    found = by_symbol(stats24h.max_cache_upsert(cache, newest))
    assert found == {
        "keep": (9.0, START),
        "higher": (9.5, START + timedelta(hours=1)),
        "old": (1.0, START + timedelta(hours=24)),
        "quiet": (9.0, START),
        "new": (2.0, START),
    }
    assert [r.symbol for r in stats24h.not_exists_anti(newest, cache).collect()] == ["new"]
    updated = by_symbol(stats24h.update_from_join(cache, newest))
    assert set(updated) == {"keep", "higher", "old"}


def test_change_without_reference_with_zero_and_with_two(candles):
    rows = [
        ("none", 0, 5.0), ("none", 60, 6.0),
        ("zero", 0, 0.0), ("zero", 1440, 3.0),
        ("two", 0, 4.0), ("two", 0, 5.0), ("two", 1440, 6.0),
    ]
    found = stats24h.price_change_24h(candles(rows)).where("place = 1").collect()
    got = sorted((r.symbol, r.price_diff, r.percent_change) for r in found if r.symbol != "none")
    assert got == [("two", 1.0, 20.0), ("two", 2.0, 50.0), ("zero", 3.0, None)]
    assert [(r.price_diff, r.percent_change) for r in found if r.symbol == "none"] == [(None, None)]


def test_rounding_of_decimal_prices(spark):
    rows = [(1, "a", START, "100.000"), (2, "a", START + DAY, "102.345"), (3, "b", START, "100.000"), (4, "b", START + DAY, "97.655")]
    df = spark.createDataFrame(rows, "event_id long, symbol string, endtime timestamp, c string")
    df = df.withColumn("close", F.col("c").cast("decimal(38,18)"))
    found = {r.symbol: r for r in stats24h.price_change_24h(df).where("place = 1").collect()}
    assert (str(found["a"].price_diff), str(found["b"].price_diff)) == ("2.35", "-2.35")


@pytest.mark.parametrize("seed", range(4))
def test_rolling_maximum(candles, seed):
    data = histories(seed)
    df = candles([(s, m, c) for s, rows in data.items() for m, c in rows])
    for r in stats24h.rolling_max_24h(df).collect():
        minute = int((r.endtime - START).total_seconds() // 60)
        seen = [c for m, c in data[r.symbol] if minute - 1440 <= m <= minute]
        assert r.max_24h == max(seen)
